"""Best-fit packing by hierarchical residual packing.

The pieces are dealt to tasks of about ``items`` rows.  Every task packs its own best-fit decreasing and emits the bins
that are nearly full.  The bins that are left become items themselves: they are dealt to fewer tasks and packed again,
until one task holds what is left or a round no longer saves bins.  A task never holds more than ``items`` rows at a time, so nothing meets in one place unless it
is small.

Defined results: a null text counts as the empty one and gives the end id alone; repeated rows are documents of their
own; an empty table gives no pieces; columns besides doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanframe.llm.common import stored

CAPACITY = 2048
NEARLY = 0.99          # of the capacity; fuller bins are emitted
ITEMS = 500_000        # rows a task packs at a time
FAN = 8                # tasks whose left-over bins meet in one task of the next round
WORDS_KEPT = 400_000   # encoded chunks a worker remembers
BYTES_KEPT = 16 << 20  # and their characters: a text without white space is one chunk
END = 0                # id that ends a document
TEXTS = 500            # texts a worker encodes at a time


# what the vocabulary parts a chunk without white space into, for chunks of plain Latin characters in lower case
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
SPECIAL = "<|"                          # begins the special tokens
# characters that stand for bytes inside the vocabulary: printable ones for themselves, the others from 256 on
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _SELF} | {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(_SELF)))}


class Encoder:
    """Encodes texts chunk by chunk between white space, each new chunk once, with the given vocabulary.

    The vocabulary drops white space and never joins across it.  Chunks of plain Latin characters are parted here, so
    that a word is encoded once for all the punctuation that follows it; all others go through the whole tokenizer.
    """

    # spaces for str.split() that the vocabulary does not treat as white space; such texts are encoded as they are
    ODD = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str, words_kept: int = WORDS_KEPT, bytes_kept: int = BYTES_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark has a task for every core
        from tokenizers import Tokenizer

        self.whole, self.kept, self.bytes_kept = Tokenizer.from_file(path), words_kept, bytes_kept
        self.model = self.whole.model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.size_kept = 0
        self.parts: dict[str, list[int]] = {}
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, chunk: str) -> list[int]:
        if not PLAIN.fullmatch(chunk) or SPECIAL in chunk:
            return self.whole.encode(chunk, add_special_tokens=False).ids
        ids = []
        for part in PARTS.findall(chunk.lower()):
            if part not in self.parts:
                own = part if part.isascii() else "".join(_BYTE[b] for b in part.encode())
                self.parts[part] = [token.id for token in self.model.tokenize(own)]
            ids += self.parts[part]
        return ids

    def _learn(self, chunks: list[str]) -> None:
        found = [self._ids(c) for c in chunks]
        self.size_kept += sum(map(len, chunks))
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size.sum()))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, without end id."""
        if max(len(self.number), len(self.parts)) > self.kept or self.size_kept > self.bytes_kept:
            self._forget()
        number, known, rows = self.number, len(self.number), []
        for text in texts:
            chunks = [] if not text else [text] if self.ODD.search(text) else text.split()
            rows.append(np.fromiter([number.setdefault(c, len(number)) for c in chunks], np.int64, len(chunks)))
        if len(number) > known:
            self._learn(list(itertools.islice(number, known, None)))
        for row in rows:
            size = self.size[row]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            yield self.flat[np.repeat(self.start[row] - ends + size, size) + np.arange(total)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 (and the ids)."""
    kind = docs.schema["doc_id"].dataType
    out = f"doc_id {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                row, piece, start, length, crc, held = [], [], [], [], [], []
                for i, found in enumerate(encoder.encode(part.column("text").to_pylist())):
                    whole = np.append(found, np.uint32(END)).astype("<u4")
                    for k, s in enumerate(range(0, len(whole), capacity)):
                        own = whole[s:s + capacity]
                        row.append(i), piece.append(k), start.append(s), length.append(len(own)), crc.append(zlib.crc32(own))
                        if ids:
                            held.append(own.astype(np.int32))
                columns = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    columns, names = [*columns, pa.array(held, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, out)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset of each item, and the fill of each bin.

    ``rooms`` has a bit for each amount of room that some open bin has, so the tightest bin is one bit operation away.
    """
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill, size = 0, [], lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        fitting = rooms >> size[i]
        if fitting:
            room = size[i] + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bin_of[i], offset[i] = b, capacity - room
        room -= size[i]
        fill[b] = capacity - room
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return bin_of, offset, np.array(fill, np.int64)


def _round(items: DataFrame, level: int, capacity: int, most: int, nearly: float) -> DataFrame:
    """Packs what each task holds; rows of a bin of the round before stay together as one item."""
    limit = math.ceil(nearly * capacity)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, chunk = [], 0, 0
        base = (level << 56) | (TaskContext.get().partitionId() << 32)

        def done() -> pa.RecordBatch:
            nonlocal chunk
            t = pa.Table.from_batches(held).combine_chunks()
            length, offset = t.column("length").to_numpy(), t.column("offset").to_numpy()
            if level:
                _, unit = np.unique(t.column("sequence_id").to_numpy(), return_inverse=True)
            else:
                unit = np.arange(len(length))
            sizes = np.bincount(unit, weights=length).astype(np.int64)
            bin_of, shift, fill = best_fit(sizes, capacity)
            own = bin_of[unit]
            new = {"sequence_id": base + chunk + own, "offset": offset + shift[unit], "full": fill[own] >= limit}
            chunk += len(fill)
            for name, values in new.items():
                t = t.set_column(t.schema.get_field_index(name), name, pa.array(values))
            return t.combine_chunks().to_batches()[0]

        for batch in batches:
            # in later rounds a task's rows are bounded by how they are dealt, and a bin must not be parted
            for at in range(0, batch.num_rows, most) if not level else [0]:
                part = batch.slice(at, most) if not level else batch
                if not level and rows and rows + part.num_rows > most:
                    yield done()
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield done()

    return items.mapInArrow(pack, items.schema)


def pack(items: DataFrame, capacity: int = CAPACITY, most: int = ITEMS, fan: int = FAN, nearly: float = NEARLY) -> DataFrame:
    """Rows with a ``length`` of at most ``capacity``, with their sequence_id and their offset in it.

    Other columns pass through; sequence_id, offset and full are set here, so such columns of the input are replaced.
    """
    rows = stored(items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "full": F.lit(False)}))
    parts = max(1, math.ceil(rows.count() / most))
    done, left, level, before = [], rows.repartition(parts), 0, math.inf
    while True:
        packed = stored(_round(left, level, capacity, most, nearly))
        done.append(packed.filter("full"))
        left = packed.filter("not full")
        n, bins = left.agg(F.count(F.lit(1)), F.countDistinct("sequence_id")).first()
        if not n or parts == 1 or bins > 0.998 * before:
            break
        parts = max(math.ceil(n / most), math.ceil(parts / fan))
        before, level = bins, level + 1
        left = left.repartition(parts, "sequence_id")
    result = left
    for d in done:
        result = result.unionByName(d)
    return result.drop("full")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, vocabulary, capacity), capacity)
