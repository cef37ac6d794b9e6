"""Static three-way binary-fuse filter over 64-bit keys, built and probed with numpy.

The keys of one immutable set go into an array of bytes; a key is in it if three of them, chosen by its hash, combine
to its check byte.  Members are always found; of other keys about one in 256 is.
"""

from __future__ import annotations

import math

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
HEAD = 3                                    # words before the bytes: seed, segment length, number of segments


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        for m in (_M1, _M2):
            h = (h ^ (h >> np.uint64(33))) * m
        return h ^ (h >> np.uint64(33))


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in neighbouring segments, and its check byte."""
    h, g = _mixed(keys, seed), _mixed(keys, seed + 1)
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    inside = np.stack([h, g, g >> np.uint64(24)]) & np.uint64(length - 1)
    at = (first + np.arange(3, dtype=np.uint64)[:, None]) * np.uint64(length) + inside
    return at.astype(np.int64), (g >> np.uint64(56)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of keys (repeats are dropped)."""
    keys = np.unique(keys.astype(np.int64).view(np.uint64))
    n = max(len(keys), 2)
    length = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(room / length) - 2)
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += 1 + segments // 8
        at, check = _slots(keys, seed, length, segments)
        rounds = _peeled(at, (segments + 2) * length)
        if rounds is not None:
            table = np.zeros((segments + 2) * length, np.uint8)
            for which, slot in reversed(rounds):
                other = table[at[0, which]] ^ table[at[1, which]] ^ table[at[2, which]]
                table[slot] = check[which] ^ other ^ table[slot]
            return np.array([seed, length, segments], "<u4").tobytes() + table.tobytes()
    raise ValueError("no filter found")


def _peeled(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, their own slot): in each, keys that are alone in a slot are taken out; None if some stay."""
    count = np.bincount(at.ravel(), minlength=size)
    mark = np.zeros(size, np.int64)                     # xor of the key numbers in a slot
    for row in at:
        np.bitwise_xor.at(mark, row, np.arange(at.shape[1]))
    rounds, left, look = [], at.shape[1], np.flatnonzero(count == 1)
    while len(look):
        which, where = np.unique(mark[look], return_index=True)
        rounds.append((which, look[where]))
        left -= len(which)
        touched = at[:, which].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(mark, touched, np.tile(which, 3))
        touched = np.unique(touched)
        look = touched[count[touched] == 1]
    return rounds if not left else None


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the set."""
    seed, length, segments = (int(x) for x in np.frombuffer(blob, "<u4", HEAD))
    table = np.frombuffer(blob, np.uint8, offset=4 * HEAD)
    at, check = _slots(keys.astype(np.int64).view(np.uint64), seed, length, segments)
    return (table[at[0]] ^ table[at[1]] ^ table[at[2]]) == check
