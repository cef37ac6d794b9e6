"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most three of 64 bits differ in at most one bit of one of two 31-bit halves.  In a
half, the words of the Hamming code of length 31 are the anchors: the code is perfect, so every half is within one bit
(the covering radius) of exactly one anchor, its home.  A fingerprint is replicated to all anchors within two bits
(covering radius plus one), 16 at most.  The home of one fingerprint of a near pair is then among the anchors of the
other, and fingerprints are compared per anchor.

Equal fingerprints are one row here.  An anchor returns the links of a spanning forest of its fingerprints rather than
its pairs.  Anchors with very many fingerprints are dealt again by anchors of the Hamming code of length 15 over the
quarters of the other half, where the same argument holds.

Defined results: a null text counts as the empty one, and texts without words have fingerprint zero; repeated rows
have their fingerprint in common; a row without id gets the component of its fingerprint and never names one, and is
not dropped as there is no id to drop; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.llm.exact_dedup import digest
from loanframe.llm.common import components, bounded_groups, stored

WORDS = 3              # per shingle
SEED = 42
NEAR = 3               # bits
HOT = 20_000           # fingerprints of an anchor that are dealt again
CLASSES_PER_TASK = 20_000    # fingerprints whose anchors one task spreads
CHUNK = 1 << 15        # shingles counted at a time


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bits that are set in over half of the hashes of all shingles."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()           # bytes: only A-Z change, only ASCII white space parts
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    if len(parts) >= words:
        starts, ends = starts[:len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((2 * ones > len(starts)) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, the SHA-256 of the text, and fingerprint, a long of the same bits."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(bits)], names=["doc_id", "digest", "fingerprint"])

    return docs.select("doc_id", "text", digest("text").alias("digest")).mapInArrow(run, f"doc_id {kind}, digest binary, fingerprint bigint")


# ------------------------------------------------------------------ anchors


def anchors(value: Column, check_bits: int) -> Column:
    """Anchors within two bits of ``value``, as an array of (anchor, home).

    The code has length 2**check_bits - 1.  Bit p - 1 has the number p; the exclusive or of the numbers of the set bits
    is 0 for an anchor.  Otherwise it is s, and changing the bits p and p xor s gives an anchor for every p; p = 0
    changes the bit s alone, which is the way home.
    """
    length = (1 << check_bits) - 1
    masks = [sum(1 << (p - 1) for p in range(1, length + 1) if p >> j & 1) for j in range(check_bits)]
    s = sum((F.bit_count(value.bitwiseAND(F.lit(m))) % 2 * F.lit(1 << j) for j, m in enumerate(masks)), F.lit(0)).cast("int")

    def bit(p: Column) -> Column:
        return F.shiftright(F.call_function("shiftleft", F.lit(1).cast("bigint"), p), 1)

    def moved(p: Column) -> Column:
        return F.struct(value.bitwiseXOR(bit(p)).bitwiseXOR(bit(p.bitwiseXOR(s))).alias("anchor"), (p == 0).alias("home"))

    pairs = F.filter(F.sequence(F.lit(0), F.lit(length)), lambda p: p < p.bitwiseXOR(s))
    return F.when(s == 0, F.array(F.struct(value.alias("anchor"), F.lit(True).alias("home")))).otherwise(F.transform(pairs, moved))


def _half(number: int) -> Column:
    return F.shiftrightunsigned("fingerprint", 32 * number).bitwiseAND(F.lit((1 << 31) - 1))


def _keyed(value: Column, check_bits: int, key: Callable[[Column], Column]) -> Column:
    return F.transform(anchors(value, check_bits), lambda x: F.struct(key(x["anchor"]).alias("key"), x["home"].alias("home")))


def _covered(classes: DataFrame) -> DataFrame:
    """(key, fingerprint, home) for the anchors of both halves; bit 31 of the key tells the half."""
    each = [_keyed(_half(h), 5, lambda anchor, h=h: anchor + F.lit(h << 31)) for h in (0, 1)]
    return classes.select("fingerprint", F.explode(F.concat(*each)).alias("x")).select("x.key", "fingerprint", "x.home")


def _dealt_again(hot: DataFrame) -> DataFrame:
    """(key, fingerprint, home) for the anchors of the quarters of the half that the hot anchor does not use."""
    other = F.when(F.shiftright("key", 31) == 0, _half(1)).otherwise(_half(0))
    quarters = [F.shiftright(other, 15 * q).bitwiseAND(F.lit((1 << 15) - 1)) for q in (0, 1)]
    each = [_keyed(v, 4, lambda anchor, q=q: F.xxhash64("key", F.lit(q), anchor)) for q, v in enumerate(quarters)]
    return hot.select("fingerprint", F.explode(F.concat(*each)).alias("x")).select("x.key", "fingerprint", "x.home")


def forest(values: np.ndarray, near: int = NEAR) -> tuple[list[int], list[int]]:
    """Links (root, other) that join all values within ``near`` bits of each other: a row per value at most."""
    left, roots, others = np.arange(len(values)), [], []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        front = [root]
        while front and len(left):
            close = np.bitwise_count(values[left] ^ values[front.pop()]) <= near
            found = left[close].tolist()
            left = left[~close]
            front += found
            others += found
            roots += [root] * len(found)
    return roots, others


def _compare(batches: Iterator[pa.RecordBatch], hot: float) -> Iterator[pa.RecordBatch]:
    """Links per anchor; of an anchor with over ``hot`` fingerprints its rows instead, with their key."""
    for part, at, big in bounded_groups(batches, ["key"], hot):
        value = part.column("fingerprint").to_numpy()
        if big:                                     # never held as a whole
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(value), part.column("key").combine_chunks()], names=["a", "b", "key"])
            continue
        bits, home = value.view(np.uint64), part.column("home").to_numpy(zero_copy_only=False)
        size, homes = np.diff(at), np.add.reduceat(home.astype(np.int64), at[:-1])
        two = at[:-1][(size == 2) & (homes > 0)]
        two = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= NEAR]
        a, b, key = [value[two]], [value[two + 1]], []
        for g in np.flatnonzero((size > 2) & (homes > 0)):
            own = value[at[g]:at[g + 1]]
            if len(own) > hot:
                a.append(own)
                b.append(own)
                key.append((sum(map(len, a)) - len(own), part.column("key")[int(at[g])].as_py(), len(own)))
            else:
                roots, others = forest(own.view(np.uint64))
                a.append(own[roots])
                b.append(own[others])
        a, b = np.concatenate(a), np.concatenate(b)
        keys, dealt = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        for start, k, n in key:
            keys[start:start + n], dealt[start:start + n] = k, True
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(keys, mask=~dealt)], names=["a", "b", "key"])


def links(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) between different fingerprints; they join exactly what pairs within three bits join."""

    def compared(rows: DataFrame, most: float) -> DataFrame:
        rows = rows.repartition("key").sortWithinPartitions("key")
        return rows.mapInArrow(partial(_compare, hot=most), "a bigint, b bigint, key bigint")

    # every class has 28 anchors: dealt by their number, whatever the partitions they come in
    spread = classes.repartition(max(1, -(-classes.count() // CLASSES_PER_TASK)))
    first = stored(compared(_covered(spread), hot))
    hot_rows = first.filter("key is not null").select("key", F.col("a").alias("fingerprint"))
    again = compared(_dealt_again(hot_rows), float("inf"))
    return first.filter("key is null").select("a", "b").unionByName(again.select("a", "b"))


def _joined(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, digest, fingerprint), and per fingerprint its component (root, and its smallest doc_id)."""
    prints = stored(fingerprints(docs))
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    joined = components(links(classes.select("fingerprint"), hot))
    classes = classes.join(joined, F.col("fingerprint") == F.col("node"), "left")
    classes = classes.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("root"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, stored(classes.join(names, "root").select("fingerprint", "root", "component_id"))


def near_duplicates(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (a long) and component_id, the smallest doc_id that links reach."""
    prints, named = _joined(docs, hot)
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicate(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest doc_id, nulls last, then of the smallest digest.

    Rows are told apart by doc_id and text: rows that share their id but not their text are decided each on its own, rows
    without id like all others, and of rows equal in both one stays.
    """
    prints, named = _joined(docs, hot)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("m")
    kept = prints.join(named, "fingerprint").groupBy("root").agg(first).select("m.doc_id", "m.digest").select("digest", _id_text())
    rows = docs.select(digest("text").alias("digest"), _id_text(), F.struct("*").alias("row"))
    return rows.join(kept, ["digest", "id_text"], "left_semi").dropDuplicates(["digest", "id_text"]).select("row.*")


def _id_text() -> Column:
    """A key without nulls: '-' for none, else '+' and the id."""
    return F.coalesce(F.concat(F.lit("+"), F.col("doc_id").cast("string")), F.lit("-")).alias("id_text")
