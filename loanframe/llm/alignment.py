"""Cross-tokenizer alignment by pointer jumping.

Two vocabularies cut the same bytes into tokens.  Every token points to its farthest-right overlapping token (the first
vocabulary's where both end together, itself at the end of a group); doubling the successors converges to the last token of
each group in as many steps as the logarithm of the longest chain, for all documents of a batch at once.

A link is a pair of tokens whose byte ranges overlap.  How many documents hold an id pair is counted over the corpus: each
task numbers the pairs of its *part* of the documents, the distinct pairs of a part ask for their counts once, and the
answers meet the stored links of that part again.  So links never travel one by one, and no table of pairs is broadcast.

Defined results: null and empty texts, and texts whose tokens do not give back their bytes, have no tokens (all zeros, empty
digest); special tokens' strings are plain text; repeated rows are documents of their own, also where they share a doc_id;
an empty table gives no rows; columns besides doc_id and text are not read, whatever their names; a text of any length is
one document, its arrays take about 60 times its bytes while it is aligned.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe.llm.common import new_folder
from loanframe.llm.packing import _BYTE

PART_BYTES = 24 << 20      # text that shares one numbering of its pairs
PART_PAIRS = 500_000       # pairs after which a part ends, whatever its text
BATCH_BYTES = 1 << 20      # text aligned at a time
# how the byte-level vocabulary parts a text before merging: a fixed value of its format
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# beyond these characters two libraries may know different editions of Unicode
BEYOND_LATIN = re.compile("[^\x00-ɏ]")


class Vocabularies:
    """Both tokenizers, the bytes of every token and their lengths."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark has a task for every core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(byte_path)
        self.whole.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as f:
            stored = json.load(f)["model"]["vocab"]
        back = {c: b for b, c in _BYTE.items()}
        self.bytes_a = [b""] * (1 + max(stored.values()))
        for token, number in stored.items():
            if all(c in back for c in token):
                self.bytes_a[number] = bytes(back[c] for c in token)
        special = {t.content for t in self.whole.get_added_tokens_decoder().values() if t.special}
        ranks = {self.bytes_a[n]: n for t, n in stored.items() if t not in special}
        self.latin = tiktoken.Encoding("latin", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_b = [self._piece(n) for n in range(self.pieces.get_piece_size())]
        self.size_a = np.array([len(b) for b in self.bytes_a], np.int32)
        self.size_b = np.array([len(b) for b in self.bytes_b], np.int32)
        self.names = np.array([str(n) for n in range(max(len(self.bytes_a), len(self.bytes_b)))], object)

    def _piece(self, number: int) -> bytes:
        if self.pieces.is_control(number) or self.pieces.is_unknown(number):
            return b""
        piece = self.pieces.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[list[int], list[int]] | None:
        """The ids of both vocabularies, or None where there are none to align."""
        if not text:
            return None
        spaced = " " + text
        a = self.whole.encode(spaced, add_special_tokens=False).ids if BEYOND_LATIN.search(text) else self.latin.encode_ordinary(spaced)
        b = self.pieces.encode(text)
        raw = spaced.encode()
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        return a, b


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token of each token's group, as a position in the first sequence, for the tokens of both."""
    n = len(end_a)
    over_a, over_b = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
    successor = np.concatenate([np.where(end_b[over_a] > end_a, n + over_a, np.arange(n)), over_b])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor[:n], successor[n:]
        successor = further


class Aligned:
    """The tokens of a batch of texts, their groups and their links."""

    def __init__(self, texts: list[str | None], words: Vocabularies):
        found = [words.encode(t) for t in texts]
        self.n_a = np.array([len(f[0]) if f else 0 for f in found], np.int64)
        self.n_b = np.array([len(f[1]) if f else 0 for f in found], np.int64)
        self.a = np.fromiter(itertools.chain.from_iterable(f[0] for f in found if f), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter(itertools.chain.from_iterable(f[1] for f in found if f), np.int64, int(self.n_b.sum()))
        self.doc_a, self.doc_b = np.repeat(np.arange(len(texts)), self.n_a), np.repeat(np.arange(len(texts)), self.n_b)
        self.end_a, self.end_b = np.cumsum(words.size_a[self.a], dtype=np.int64), np.cumsum(words.size_b[self.b], dtype=np.int64)
        self.words, self.n = words, len(texts)
        if len(self.a):
            last_a, last_b = terminals(self.end_a, self.end_b)
            ends = last_a == np.arange(len(self.a))
            rank = np.cumsum(ends) - 1
            self.group_a, self.group_b = rank[last_a], rank[last_b]
            self.n_groups = np.bincount(self.doc_a[ends], minlength=self.n)
        else:
            self.group_a = self.group_b = np.zeros(0, np.int64)
            self.n_groups = np.zeros(self.n, np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct links of each text: its number, the pair (first id times the size of the second vocabulary, plus second id), how often."""
        if not len(self.a):
            return (np.zeros(0, np.int64),) * 3
        first = np.searchsorted(self.end_b, self.end_a - self.words.size_a[self.a], side="right")
        many = np.searchsorted(self.end_b, self.end_a) - first + 1
        ends = np.cumsum(many)
        own = np.repeat(np.arange(len(self.a)), many)
        other = np.arange(ends[-1]) - (ends - many - first)[own]
        wide = len(self.words.bytes_a) * len(self.words.bytes_b)
        pair = self.a[own] * len(self.words.bytes_b) + self.b[other]
        key, times = np.unique(self.doc_a[own] * wide + pair, return_counts=True)
        return key // wide, key % wide, times

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: ids of both vocabularies, group by group; empty without tokens."""
        place = np.concatenate([2 * self.group_a, 2 * self.group_b + 1])
        order = np.argsort(place, kind="stable")
        place = place[order]
        parts = np.empty(2 * len(order), object)
        parts[0::2] = self.words.names[np.concatenate([self.a, self.b])[order]]
        step = np.diff(place, append=-1)
        parts[1::2] = np.array([",", "|", ";"], object)[np.where(step == 0, 0, np.where((step == 1) & (place % 2 == 0), 1, 2))]
        bounds = 2 * np.append(0, np.cumsum(self.n_a + self.n_b))
        return [hashlib.sha256("".join(parts[s:e - 1].tolist()).encode()).hexdigest() if e > s else "" for s, e in zip(bounds[:-1], bounds[1:])]


def _packed(place: np.ndarray, times: np.ndarray) -> bytes:
    return pa.compress(np.concatenate([place, times]).astype("<u4").tobytes(), codec="zstd", asbytes=True) if len(place) else b""


def _unpacked(held: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(held, 8 * n, codec="zstd", asbytes=True), "<u4")
    return both[:n], both[n:]


def parts(docs: DataFrame, byte_path: str, piece_path: str, part_bytes: int = PART_BYTES, part_pairs: int = PART_PAIRS) -> DataFrame:
    """One row per document with its links as numbers of its part, and rows that name those pairs with the documents that hold them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links"]
    out = (f"part bigint, doc_id {kind}, {', '.join(f'{n} bigint' for n in names)}, groups_sha256 string, n_pairs bigint, links binary, "
           "at bigint, pairs array<bigint>, held array<bigint>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabularies(byte_path, piece_path)
        base, count = TaskContext.get().partitionId() << 24, 0
        number: dict[int, int] = {}
        held, size, id_type = np.zeros(0, np.int64), 0, None

        def named() -> Iterator[pa.RecordBatch]:
            """The pairs of the part that ends here, in pieces."""
            pairs = np.fromiter(number, np.int64, len(number))
            for at in range(0, len(pairs), 20_000):
                nothing = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + count]), pa.nulls(1, id_type), *[nothing] * 4, pa.nulls(1, pa.string()), nothing, pa.nulls(1, pa.binary()), pa.array([at]),
                     pa.array([pairs[at:at + 20_000]], pa.list_(pa.int64())), pa.array([held[at:at + 20_000]], pa.list_(pa.int64()))],
                    names=["part", "doc_id", *names, "groups_sha256", "n_pairs", "links", "at", "pairs", "held"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            bytes_of = np.diff(np.frombuffer(batch.column("text").cast(pa.large_binary()).buffers()[1], np.int64)[
                batch.column("text").offset:batch.column("text").offset + batch.num_rows + 1]) if batch.num_rows else np.zeros(0, np.int64)
            step, at = np.cumsum(bytes_of) // BATCH_BYTES, 0
            while at < batch.num_rows:
                to = int(np.searchsorted(step, step[at], side="right"))
                piece = batch.slice(at, to - at)
                at = to
                found = Aligned(piece.column("text").to_pylist(), words)
                doc, pair, times = found.links()
                distinct, where = np.unique(pair, return_inverse=True)
                known = [number.setdefault(p, len(number)) for p in distinct.tolist()]
                place = np.array(known, np.int64)[where] if len(known) else where
                held = np.concatenate([held, np.zeros(len(number) - len(held), np.int64)])
                held += np.bincount(place, minlength=len(number))
                order = np.lexsort([place, doc])
                doc, place, times = doc[order], place[order], times[order]
                bounds = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                links = [_packed(np.diff(place[s:e], prepend=0), times[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
                n, long = piece.num_rows, pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, base + count)), piece.column("doc_id"), pa.array(found.n_a), pa.array(found.n_b), pa.array(found.n_groups.astype(np.int64)),
                     pa.array(np.bincount(doc, weights=times, minlength=n).astype(np.int64)), pa.array(found.digests(), pa.string()),
                     pa.array(np.diff(bounds).astype(np.int64)), pa.array(links, pa.binary()), pa.nulls(n, long), pa.nulls(n, pa.list_(long)), pa.nulls(n, pa.list_(long))],
                    names=["part", "doc_id", *names, "groups_sha256", "n_pairs", "links", "at", "pairs", "held"])
                size += int(bytes_of[at - n:at].sum())
                if size > part_bytes or len(number) > part_pairs:
                    yield from named()
                    number, held, size, count = {}, np.zeros(0, np.int64), 0, count + 1
        if number:
            yield from named()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, out)


def pair_counts(named: DataFrame, second_size: int) -> DataFrame:
    """Per id pair the documents that hold it (``n``) and whether no other pair of its first id has more (``best``)."""
    counts = named.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.expr(f"pair div {second_size}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _answer(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of a part's documents."""
    n = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    place = pairs.column("place").to_numpy()
    n[place], best[place] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    size, held = docs.column("n_pairs").to_numpy(), docs.column("links").to_pylist()
    n_best, total = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for i, (s, h) in enumerate(zip(size, held)):
        if s:
            step, times = _unpacked(h, int(s))
            own = np.cumsum(step, dtype=np.int64)
            n_best[i], total[i] = (best[own] * times).sum(), (n[own] * times).sum()
    kept = docs.drop_columns(["part", "n_pairs", "links"])
    return kept.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(total))


def align(docs: DataFrame, byte_path: str, piece_path: str, **limits) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum for every row of ``docs``."""
    import sentencepiece

    spark = docs.sparkSession
    path = new_folder(spark, "aligned")
    parts(docs, byte_path, piece_path, **limits).write.parquet(path)
    rows = spark.read.parquet(path)          # read for each use, so that the two sides of the last step share no columns
    second = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    named = rows.filter("pairs is not null").select("part", "at", F.posexplode(F.arrays_zip("pairs", "held")).alias("step", "x")).select(
        "part", (F.col("at") + F.col("step")).alias("place"), F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    answers = named.join(pair_counts(named, second), "pair").select("part", "place", "n", "best")
    own = spark.read.parquet(path).filter("pairs is null").drop("at", "pairs", "held")
    done = own.drop("part", "n_pairs", "links").schema.simpleString()[7:-1] + ",n_best:bigint,count_sum:bigint"
    return own.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_answer, done.replace(":", " "))
