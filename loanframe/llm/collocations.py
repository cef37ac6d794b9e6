"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

Words are read piece by piece, phrases of one to four words never cross a piece.  First pass: tasks count the hashes of all
phrases they hold and send them to hash partitions: words and pairs first, then those longer phrases whose pairs have all
survived, as no phrase is more frequent than a pair in it.  A partition's summary keeps as many counters as its mass (all
occurrences in it) divided by the threshold, some times over; when more arrive, the largest counter beyond the capacity is taken
off all of them.  What was taken off in all bounds the error of every counter, and mass / (capacity + 1) bounds that below
the threshold: a phrase that reaches the threshold always survives.  Last pass: tasks count the survivors in all texts again,
by their words: a task tells phrases apart by two independent hashes of 64 bits, all else adds up by the phrases themselves,
so neither a collision in the summaries nor a false positive of the filter changes a count.

Defined results: null texts count as empty, null languages as ``und``; empty texts, and texts without a word, add nothing;
repeated rows count each; an empty table gives no rows; only lang and text are read, other columns may have any names; long
texts are cut at piece ends alone, so a single piece must fit a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanframe.llm.common import new_folder, stored

LONGEST = 4                # words of a phrase
THRESHOLD = 30             # occurrences of a candidate
SCALE = 2_000_000
COVER = 80                 # percent of a phrase's occurrences that a longer one must have to replace it
FIRST = 2_000              # phrases per language that are returned
COUNTERS = 1_000_000       # counters a hash partition may need, from which the number of partitions follows
CHUNK_BYTES = 1 << 20      # text whose phrases are counted together
ROWS_AT_ONCE = 500         # documents taken out of a batch together
HELD = 1_500_000           # distinct hashes a task holds before it sends them
PHRASES = 1_000_000        # and phrases
RECENT = 50_000            # phrases that are looked up one by one before they join the sorted ones
SPARE = 4                  # counters of a summary, in multiples of its mass by the threshold: the more, the fewer rare phrases survive
PARTS = 4                  # hash partitions with a summary of their own, per task
FILTER_BITS = 1 << 28      # most bits of the survivors' filter; more survivors only make it let more pass
LONG_WORD = 64             # bytes; longer words are hashed one by one

# a fixed table of bytes: A-Z lowered, what ends a piece as line feed, tab as space
_BYTES = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _BYTES[_c] = _c + 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _BYTES[_c] = 0x0A
_BYTES[0x09] = 0x20
_BYTES = bytes(_BYTES)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_END = re.compile(rb"[.,;:!?\x0a-\x0d]")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Two 64-bit numbers per word, from sums over its bytes: byte value times a power of the place, brought back to place 0."""

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)        # odd, so that they have inverses

    def __init__(self):
        rng = np.random.default_rng(13)
        self.values = [rng.integers(1, 1 << 63, 256, dtype=np.uint64) for _ in self.BASES]
        self.up: list[np.ndarray] = []
        self.down: list[np.ndarray] = []

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        if not self.up or len(self.up[0]) < len(data):
            self.up = [_powers(b, len(data)) for b in self.BASES]
            self.down = [_powers(pow(b, -1, 1 << 64), len(data)) for b in self.BASES]
        out = []
        for values, up, down in zip(self.values, self.up, self.down):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * up[:len(data)], out=sums[1:])
            out.append(_mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)))
        long = np.flatnonzero(end - start > LONG_WORD)
        if len(long):
            import xxhash

            raw = data.tobytes()
            for seed, own in enumerate(out):
                own[long] = [xxhash.xxh64_intdigest(raw[start[i]:end[i]], seed) for i in long.tolist()]
        return out


class Chunk:
    """The words of some documents: where they are, how many follow in their piece, their language and their hashes."""

    def __init__(self, texts: list[bytes], langs: list[int], hasher: Hasher):
        self.raw = (b"\n".join(texts) + b"\n").translate(_BYTES)
        data = np.frombuffer(self.raw, np.uint8)
        breaks = data == 0x0A
        word = ~(breaks | (data == 0x20))
        before = np.concatenate([[False], word[:-1]])
        self.start, self.end = np.flatnonzero(word & ~before), np.flatnonzero(before & ~word)
        piece = np.cumsum(breaks)[self.start]
        last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if len(piece) else np.zeros(0, np.int64)
        self.left = np.repeat(last + 1, np.diff(last, prepend=-1)) - np.arange(len(piece))
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.lang = np.array(langs, np.int64)[np.searchsorted(np.cumsum(size), self.start, side="right")]
        self.hashes = hasher.words(data, self.start, self.end)

    def phrases(self, longest: int, seeds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: the places where a phrase of it starts, and both hashes of its language and words."""
        both = [seeds[self.lang], _mixed(seeds[self.lang])]
        for n in range(1, longest + 1):
            both = [_mixed(h[:max(0, len(self.start) - n + 1)] * _ODD + own[n - 1:]) for h, own in zip(both, self.hashes)]
            at = np.flatnonzero(self.left >= n)
            yield n, at, both[0][at], both[1][at]

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join([self.raw[s:e] for s, e in zip(self.start[at:at + n].tolist(), self.end[at:at + n].tolist())])


class Languages:
    """Numbers of the languages a task has met."""

    def __init__(self):
        self.number: dict[str, int] = {}

    def of(self, lang: str) -> int:
        return self.number.setdefault(lang, len(self.number))

    def seeds(self) -> np.ndarray:
        import xxhash

        return np.array([xxhash.xxh64_intdigest(name, 7) for name in self.number], np.uint64)


def chunks(batches: Iterator[pa.RecordBatch], languages: Languages, at_once: int | None = None) -> Iterator[Chunk]:
    """Whole documents together up to about ``at_once`` bytes; longer ones in parts that end with a piece."""
    at_once, hasher = at_once or CHUNK_BYTES, Hasher()
    texts: list[bytes] = []
    langs: list[int] = []
    held = 0
    for batch in batches:
        for row in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(row, ROWS_AT_ONCE)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.large_binary()).to_pylist()):
                own, at = languages.of(lang), 0
                while at < len(text):
                    to = len(text)
                    if to - at > at_once:
                        cut = _END.search(text, at + at_once)
                        to = cut.end() if cut else to
                    texts.append(text[at:to]), langs.append(own)
                    held, at = held + to - at, to
                    if held >= at_once:
                        yield Chunk(texts, langs, hasher)
                        texts, langs, held = [], [], 0
    if texts:
        yield Chunk(texts, langs, hasher)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _hashed(batches: Iterator[pa.RecordBatch], lengths: tuple[int, ...], pairs: np.ndarray | None) -> Iterator[np.ndarray]:
    """The hashes of all phrases of the given lengths, chunk by chunk; with a filter, of those whose pairs all pass it."""
    languages = Languages()
    for chunk in chunks(batches, languages):
        found, fine = [np.zeros(0, np.uint64)], np.zeros(len(chunk.start) + LONGEST, bool)
        for size, at, h, _ in chunk.phrases(max(lengths), languages.seeds()):
            if size == 2 and pairs is not None:
                fine[at] = passed(pairs, h)
            if size in lengths:
                found.append(h if pairs is None else h[np.logical_and.reduce([fine[at + k] for k in range(size - 1)])])
        yield np.concatenate(found)


def masses(docs: DataFrame, parts: int, lengths: tuple[int, ...], pairs: np.ndarray | None = None) -> np.ndarray:
    """Occurrences that each hash partition will be sent."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(parts, np.int64)
        for h in _hashed(batches, lengths, shared.value):
            mass += np.bincount(h.view(np.int64) % parts, minlength=parts)
        used = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(mass[used])], names=["part", "n"])

    out = np.zeros(parts, np.int64)
    for r in _texts(docs).mapInArrow(count, "part int, n bigint").groupBy("part").agg(F.sum("n").alias("n")).collect():
        out[r["part"]] = r["n"]
    return out


def local_counts(docs: DataFrame, lengths: tuple[int, ...], pairs: np.ndarray | None = None, held_most: int | None = None) -> DataFrame:
    """What tasks counted of phrases of the given lengths: key and n."""
    shared, held_most = docs.sparkSession.sparkContext.broadcast(pairs), held_most or HELD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def sent() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 100_000].view(np.int64)), pa.array(n[at:at + 100_000])], names=["key", "n"])

        for h in _hashed(batches, lengths, shared.value):
            keys, n = merged(keys, n, *np.unique(h, return_counts=True))
            if len(keys) > held_most:
                yield from sent()
                keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield from sent()

    return _texts(docs).mapInArrow(count, "key bigint, n bigint")


def merged(keys: np.ndarray, n: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums per key of two lists, sorted by key."""
    both = np.concatenate([keys, more])
    order = np.argsort(both, kind="stable")
    both, n = both[order], np.concatenate([n, times])[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
    return both[first], np.add.reduceat(n, first) if len(first) else n


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by ``error`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys, self.n = merged(self.keys, self.n, keys, n)
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.n, len(self.n) - self.capacity - 1)[len(self.n) - self.capacity - 1])
            self.error += off
            kept = self.n > off
            self.keys, self.n = self.keys[kept], self.n[kept] - off

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` occurrences."""
        return self.keys[self.n + self.error >= threshold]


def survivors(local: DataFrame, mass: np.ndarray, partitions: int, threshold: int = THRESHOLD) -> DataFrame:
    """Hashes (``key``) that reach the threshold for all the summaries know; ``mass`` has the occurrences of each hash partition."""
    parts = len(mass)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Summary] = {}
        for batch in batches:
            keys, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            part = keys % parts
            for p in np.unique(part).tolist():
                own = part == p
                if p not in held:
                    held[p] = Summary(SPARE * int(mass[p]) // threshold + 1)
                held[p].add(keys[own].view(np.uint64), n[own])
        for summary in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(summary.reaching(threshold).view(np.int64))], names=["key"])

    return local.repartition(partitions, F.pmod("key", F.lit(parts))).mapInArrow(summarise, "key bigint")


def filter_bits(keys: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the keys, of ten bits per key but no more than ``most``; built in tasks and joined by their or."""
    n = keys.count()
    bits = min(most, max(1 << 13, 1 << (10 * n - 1).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _filter_places(batch.column("key").to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(held, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()])], names=["held"])

    # one filter per task and as few tasks as the keys need: what reaches the driver is bounded by the filter's size
    tasks = max(1, min(8, -(-n // 2_000_000)))
    out = np.zeros(bits // 8, np.uint8)
    for row in keys.repartition(tasks).mapInArrow(build, "held binary").toLocalIterator():
        out |= np.frombuffer(row["held"], np.uint8)
    return out


def _filter_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    again = _mixed(keys + _ODD)
    return [((x >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64) for x in (keys, again, _mixed(again + _ODD))]


def passed(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter lets pass: all that it was built from, and few others."""
    out = np.ones(len(keys), bool)
    for place in _filter_places(keys, 8 * len(bits)):
        out &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return out


class Counter:
    """Phrases of a task with their counts: two hashes tell them apart."""

    def __init__(self):
        self.phrases: list[bytes] = []
        self.sizes: list[int] = []
        self.langs: list[int] = []
        self.hashes: list[tuple[int, int]] = []
        self.n = np.zeros(0, np.int64)
        self.recent: dict[tuple[int, int], int] = {}
        self.one = self.two = np.zeros(0, np.uint64)      # hashes of the phrases of ``place``, sorted by the first
        self.place = np.zeros(0, np.int64)

    def add(self, chunk: Chunk, size: int, at: np.ndarray, one: np.ndarray, two: np.ndarray, times: np.ndarray) -> None:
        """Adds distinct phrases; where two share their first hash, the later one is looked up one by one."""
        where = np.minimum(np.searchsorted(self.one, one), max(0, len(self.one) - 1))
        known = (self.one[where] == one) & (self.two[where] == two) if len(self.one) else np.zeros(len(one), bool)
        self.n[self.place[where[known]]] += times[known]
        new, counts, found = np.flatnonzero(~known), [], []
        for place, key, many in zip(at[new].tolist(), zip(one[new].tolist(), two[new].tolist()), times[new].tolist()):
            row = self.recent.setdefault(key, len(self.phrases))
            if row == len(self.phrases):
                self.phrases.append(chunk.phrase(place, size)), self.sizes.append(size), self.langs.append(int(chunk.lang[place])), self.hashes.append(key)
            found.append(row), counts.append(many)
        self.n = np.append(self.n, np.zeros(len(self.phrases) - len(self.n), np.int64))
        np.add.at(self.n, found, counts)
        if len(self.recent) > RECENT:
            keys = np.array(list(self.recent), np.uint64).reshape(-1, 2)
            both = np.concatenate([self.one, keys[:, 0]])
            order = np.argsort(both, kind="stable")
            self.one, self.two = both[order], np.concatenate([self.two, keys[:, 1]])[order]
            self.place = np.concatenate([self.place, np.fromiter(self.recent.values(), np.int64, len(self.recent))])[order]
            self.recent = {}

    def packed(self, names: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
        """One row per bucket of the first hash, with lists of its phrases."""
        first = np.array([h[0] for h in self.hashes], np.uint64)
        bucket = (first % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        for at in range(0, len(order), 100_000):
            own = order[at:at + 100_000]
            starts = np.flatnonzero(np.append(True, np.diff(bucket[own]) != 0))
            offsets = pa.array(np.append(starts, len(own)), pa.int32())
            values = [pa.array(np.array(names, object)[np.array(self.langs)[own]], pa.string()), pa.array([self.phrases[i] for i in own.tolist()], pa.binary()).cast(pa.string()),
                      pa.array(np.array(self.sizes, np.int32)[own]), pa.array(self.n[own])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[own][starts]), *(pa.ListArray.from_arrays(offsets, v) for v in values)], names=["bucket", "lang", "phrase", "size", "n"])


def exact_counts(docs: DataFrame, bits: np.ndarray, partitions: int, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, size, n of the phrases that reach the threshold, and of all words per language (phrase and size null).

    Tasks send what they counted in lists by bucket of a hash; a bucket's lists are added up in one task.
    """
    held = docs.sparkSession.sparkContext.broadcast(bits)
    buckets = PARTS * partitions

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, filled, counter = Languages(), held.value, Counter()
        words = np.zeros(0, np.int64)
        for chunk in chunks(batches, languages):
            many = np.bincount(chunk.lang, minlength=len(languages.number))
            words = np.append(words, np.zeros(len(many) - len(words), np.int64)) + many
            for size, at, h, second in chunk.phrases(longest, languages.seeds()):
                kept = np.flatnonzero(passed(filled, h))
                order = kept[np.argsort(h[kept])]
                one, two = h[order], second[order]
                first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))) if len(order) else np.zeros(0, np.int64)
                counter.add(chunk, size, at[order[first]], one[first], two[first], np.diff(np.append(first, len(order))))
            if len(counter.phrases) > PHRASES:
                yield from counter.packed(list(languages.number), buckets)
                counter = Counter()
        yield from counter.packed(list(languages.number), buckets)
        spoken = np.flatnonzero(words)
        one_list = lambda values, kind: pa.array([values], pa.list_(kind))
        names = list(languages.number)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), one_list([names[i] for i in spoken], pa.string()), one_list([None] * len(spoken), pa.string()), one_list([None] * len(spoken), pa.int32()),
             one_list(words[spoken], pa.int64())], names=["bucket", "lang", "phrase", "size", "n"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, names = None, ["lang", "phrase", "size", "n"]
        for batch in batches:
            own = pa.table({c: batch.column(c).flatten() for c in names})
            both = own if total is None else pa.concat_tables([total, own])
            total = both.group_by(["lang", "phrase", "size"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(names)
        if total is not None:
            reach = pc.or_(pc.is_null(total.column("phrase")), pc.greater_equal(total.column("n"), threshold))
            yield from total.filter(reach).combine_chunks().to_batches()

    sent = _texts(docs).mapInArrow(count, "bucket int, lang array<string>, phrase array<string>, size array<int>, n array<bigint>")
    return sent.repartition(partitions, "bucket").mapInArrow(add_up, "lang string, phrase string, size int, n bigint")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, counters: int = COUNTERS) -> DataFrame:
    """lang, phrase, size, n of all phrases with ``threshold`` occurrences or more, and of all words per language (phrase null)."""
    spark = docs.sparkSession
    # a phrase begins at a word, and a word takes two bytes with what parts it from the next; a pass looks at two lengths
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * SPARE * (size // 2 + 1) // (threshold * counters)))
    parts, bits, paths = PARTS * partitions, None, []
    for lengths in [(1, 2), tuple(range(3, longest + 1))]:
        if lengths:
            mass = masses(docs, parts, lengths, bits)
            paths.append(new_folder(spark, "survivors"))
            survivors(local_counts(docs, lengths, bits), mass, partitions, threshold).write.parquet(paths[-1])
            bits = filter_bits(spark.read.parquet(*paths))
    return stored(exact_counts(docs, bits, partitions, threshold, longest))


def collocations(docs: DataFrame, first: int = FIRST, threshold: int = THRESHOLD, longest: int = LONGEST, cover: int = COVER, counters: int = COUNTERS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    counts = frequent_phrases(docs, threshold, longest, counters)
    phrases = counts.filter("phrase is not null").withColumn("words", F.split("phrase", " "))
    candidates = phrases.filter("size > 1").withColumnRenamed("n", "a")

    # what lies inside a longer candidate that is nearly as frequent goes
    inside = [(s, m) for m in range(2, longest) for s in range(longest - m + 1)]
    parts = F.array(*[F.when(F.col("size") >= s + m, F.when(F.col("size") > m, F.array_join(F.slice("words", s + 1, m), " "))) for s, m in inside])
    longer = candidates.select("lang", F.explode(parts).alias("phrase"), "a").filter("phrase is not null").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") < F.col("a").cast("decimal(20,0)") * F.lit(cover).cast("decimal(3,0)")))

    # every cut asks for the counts of both its parts
    cut = F.explode(F.filter(F.transform(F.sequence(F.lit(1), F.lit(longest - 1)), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("head"), F.array_join(F.slice("words", k + 1, F.lit(longest)), " ").alias("tail"),
        (k < F.col("size")).alias("is"))), lambda c: c["is"]))
    cuts = kept.select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.k", "c.head", "c.tail")
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    cuts = cuts.join(known.withColumnsRenamed({"part": "head", "times": "l"}), ["lang", "head"]).join(known.withColumnsRenamed({"part": "tail", "times": "r"}), ["lang", "tail"])
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("m"))
    words = counts.filter("phrase is null").select("lang", "n")
    scored = lowest.select("lang", "phrase", "m.a", "m.l", "m.r", "m.score").join(words, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
