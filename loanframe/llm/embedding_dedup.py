"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, rerank with the original vectors.

A rotation of the principal axes is learned on a bounded sample so that its signs are balanced binary codes.  A code is
cut into substrings; per substring a vector stands in its own bucket and in those that set one more bit, so two vectors
whose substrings differ in one bit at most meet in exactly one bucket of that table.  Substring length follows the
number of vectors, and as many rotations are learned as keep the expected recall at the threshold above ``recall``:
longer substrings are paid for with rotations, not with links.

First the codes alone are compared, which leaves the vectors that have a near code in a bucket.  Only those carry their
original numbers to the bucket, where cosines are computed in double precision, in blocks.  A pair that meets in
several tables counts in the first; a bucket returns counts and the links of a spanning forest rather than its pairs,
and very full buckets are dealt out as blocks of bounded size.  Equal vectors are one row throughout.

Defined results: vectors that are null, zero, or hold null or non-finite numbers link with nothing; vectors of different
lengths are compared with those of their own length; repeated rows link with each other like any equal vectors; a row without id gets the component of its vector
and never names one; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.llm.common import bounded_groups, components, hash_share, sorted_groups, stored

COSINE = 0.9
RECALL = 0.9995        # expected, of pairs exactly at the threshold, at any number of vectors; closer pairs are found more surely
SAMPLE = 20_000        # vectors that a rotation is learned on
NUMBERS = 4_000_000    # and numbers in them
LOAD = 16              # vectors expected in a bucket's own rows
BLOCK = 4_096          # rows of a bucket that are compared at a time
STEPS = 40             # of the iterative quantisation
TABLE_SHIFT = 40       # bits of a bucket's key below the table's number, so also the longest substring


@dataclass
class Codes:
    """Rotations of unit vectors, and how codes are cut into tables of ``bits`` bits."""

    axes: list[np.ndarray]          # one (dimension, code length) matrix per rotation
    bits: int
    near: int                       # largest distance of two whole codes that is looked at

    @property
    def tables(self) -> list[tuple[int, int]]:
        """(rotation, first bit) of each table."""
        length = self.axes[0].shape[1]
        return [(r, k * self.bits) for r in range(len(self.axes)) for k in range(max(1, length // self.bits))]

    def of(self, unit: np.ndarray) -> np.ndarray:
        """Codes, a 64-bit number per vector and rotation."""
        place = np.uint64(1) << np.arange(self.axes[0].shape[1], dtype=np.uint64)
        return np.stack([(unit @ a > 0) @ place for a in self.axes], 1)

    def part(self, codes: np.ndarray, table: int) -> np.ndarray:
        rotation, first = self.tables[table]
        return (codes[:, rotation] >> np.uint64(first)) & np.uint64((1 << self.bits) - 1)


def learn(sample: np.ndarray, bits: int, rotations: int, near: int) -> Codes:
    """Iterative quantisation from ``rotations`` random starts.

    The axes are those of the second moments about the origin, as the cosine is: with the mean taken away, the codes of
    a table that is one tight cluster would be its noise.  The rotation then spreads the weight evenly over the bits.
    """
    dimension = sample.shape[1]
    length = min(64, dimension)
    _, vectors = np.linalg.eigh(sample.T @ sample if len(sample) else np.eye(dimension))
    main = vectors[:, ::-1][:, :length]
    v, axes = sample @ main, []
    for start in range(rotations):
        turn, _ = np.linalg.qr(np.random.default_rng(start).normal(size=(length, length)))
        for _ in range(STEPS if len(sample) else 0):
            left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (left @ right).T
        axes.append(main @ turn)
    return Codes(axes, bits, near)


def distance_for(length: int, p: float, miss: float) -> int:
    """The smallest distance that codes of a pair at the threshold exceed with a probability of ``miss`` at most."""
    left, k = 1.0 - (1.0 - p) ** length, 0
    while left > miss and k < length:
        k += 1
        left -= math.comb(length, k) * p ** k * (1.0 - p) ** (length - k)
    return k


def rotations_for(bits: int, dimension: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Rotations that substrings of ``bits`` bits need for the wanted recall."""
    length, p = min(64, dimension), math.acos(cosine) / math.pi
    found = (1 - p) ** (bits - 1) * (1 - p + bits * p)
    return max(1, math.ceil(math.log(1 - recall) / (max(1, length // bits) * math.log(max(1e-12, 1 - found)))))


def plan(n: int, dimension: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int, int]:
    """Substring bits, rotations and the largest distance of whole codes for ``n`` vectors.

    Each bit of a pair at the threshold differs with probability angle / pi; a table finds it if at most one bit of
    its substring does.  A tenth of the loss allowed is left to the distance of whole codes, the rest to the tables.
    """
    length, p = min(64, dimension), math.acos(cosine) / math.pi
    bits = max(1, min(length, max(8, min(TABLE_SHIFT, math.ceil(math.log2(max(n, 2) / LOAD))))))
    lost = 1 - recall
    return bits, rotations_for(bits, dimension, cosine, 1 - 0.9 * lost), distance_for(length, p, 0.1 * lost)


def _usable(vector: str, dimension: int) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimension) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.Array, dimension: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bytes(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def _rows(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _coded(classes: DataFrame, codes: Codes, dimension: int) -> DataFrame:
    """cls, n, unit (doubles) and codes of each class of equal vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _unit(batch.column("vector"), dimension)
                yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("n"), _bytes(unit), _bytes(codes.of(unit))], names=["cls", "n", "unit", "codes"])

    return classes.select("cls", "n", "vector").mapInArrow(run, "cls bigint, n bigint, unit binary, codes binary")


def _placed(coded: DataFrame, codes: Codes) -> DataFrame:
    """(key, cls, home, code): the bucket of each substring, and those with one more bit set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip = np.uint64(1) << np.arange(codes.bits, dtype=np.uint64)
        for batch in batches:
            all_codes, cls = _rows(batch.column("codes"), np.uint64) if batch.num_rows else None, batch.column("cls").to_numpy()
            for t, (rotation, _) in enumerate(codes.tables if batch.num_rows else []):
                own = codes.part(all_codes, t)
                row, bit = np.nonzero((own[:, None] & flip) == 0)
                bucket = np.concatenate([own, own[row] | flip[bit]]).astype(np.int64)
                who = np.concatenate([np.arange(len(own)), row])
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket + (t << TABLE_SHIFT)), pa.array(cls[who]), pa.array(np.arange(len(who)) < len(own)),
                    pa.array(all_codes[who, rotation].view(np.int64))], names=["key", "cls", "home", "code"])

    return coded.select("cls", "codes").mapInArrow(run, "key bigint, cls bigint, home boolean, code bigint")


def _partnered(code: np.ndarray, home: np.ndarray, near: int) -> np.ndarray:
    """Which rows of a bucket have another one within ``near`` bits, at least one of the two being at home."""
    found = np.zeros(len(code), bool)
    homes = np.flatnonzero(home)
    for at in range(0, len(homes), 64):
        some = homes[at:at + 64]
        against = np.arange(len(code)) if not found[some].all() else np.flatnonzero(~found)
        close = np.bitwise_count(code[some, None] ^ code[against]) <= near
        close &= some[:, None] != against
        found[some] |= close.any(1)
        found[against] |= close.any(0)
    return found


def _candidates(placed: DataFrame, near: int, block: int) -> DataFrame:
    """The (key, cls, home) rows that have a near code in their bucket; all rows of a bucket that will be cut into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, big in bounded_groups(batches, ["key"], block):
            if big:
                yield from part.select(["key", "cls", "home"]).to_batches()
                continue
            code = part.column("code").to_numpy().view(np.uint64)
            home = part.column("home").to_numpy()
            keep = np.zeros(part.num_rows, bool)
            for g in np.flatnonzero((np.diff(at) > 1) & (np.add.reduceat(home.astype(np.int64), at[:-1]) > 0)):
                keep[at[g]:at[g + 1]] = _partnered(code[at[g]:at[g + 1]], home[at[g]:at[g + 1]], near)
            yield from part.filter(pa.array(keep)).select(["key", "cls", "home"]).to_batches()

    return placed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key bigint, cls bigint, home boolean")


def _blocks(candidates: DataFrame, block: int) -> DataFrame:
    """Deals the rows of very full buckets to pairs of blocks: (key, i, j, own, cls, home), ``own`` being the row's block."""
    full = candidates.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("many")).filter("many > 1")
    rows = candidates.join(full, "key", "left").withColumn("many", F.coalesce("many", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("many")).cast("int"))
    every = F.sequence(F.lit(0), F.col("many") - 1)
    target = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("own").alias("j")))
    query = F.transform(every, lambda j: F.struct(F.col("own").alias("i"), j.alias("j")))
    places = F.when(F.col("home"), F.array_union(target, query)).otherwise(target)
    return rows.withColumn("at", F.explode(places)).select("key", "at.i", "at.j", "own", "cls", "home")


def _verified(rows: DataFrame, codes: Codes, cosine: float, chunk: int = 256) -> DataFrame:
    """Per bucket: (a, null, add), links of a to be counted, and (a, b, 0), links that join the same vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at in sorted_groups(batches, ["key", "i", "j"]):
            column = {c: part.column(c).to_numpy() for c in ("key", "i", "j", "own", "cls", "home", "n")}
            a, b, add = [], [], []
            for start, end in zip(at[:-1], at[1:]):
                if end - start < 2:
                    continue
                own = {c: v[start:end] for c, v in column.items()}
                unit, code = (_rows(part.column(c).slice(start, end - start), k) for c, k in (("unit", float), ("codes", np.uint64)))
                counted, links = _bucket(own, unit, code, codes, cosine, chunk)
                who = np.flatnonzero(counted)
                a += own["cls"][who].tolist() + [own["cls"][x] for x, _ in links]
                b += [None] * len(who) + [own["cls"][y] for _, y in links]
                add += counted[who].tolist() + [0] * len(links)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(add, pa.int64())], names=["a", "b", "add"])

    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(run, "a bigint, b bigint, add bigint")


def _bucket(own: dict, unit: np.ndarray, code: np.ndarray, codes: Codes, cosine: float, chunk: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links per row, weighted by the rows' class sizes, and a spanning forest of them, for one block of one bucket."""
    table = int(own["key"][0]) >> TABLE_SHIFT
    query = np.flatnonzero(own["home"] & (own["own"] == own["i"]))
    target = np.flatnonzero(own["own"] == own["j"])
    counted, top = np.zeros(len(unit), np.int64), np.arange(len(unit))
    links: list[tuple[int, int]] = []
    for at in range(0, len(query), chunk):
        q = query[at:at + chunk]
        pair = (own["cls"][q, None] != own["cls"][target]) & (~own["home"][target] | (own["cls"][q, None] < own["cls"][target]))
        for t in range(table):
            differ = np.bitwise_count(codes.part(code[q], t)[:, None] ^ codes.part(code[target], t))
            pair &= differ > 1                                  # else the pair has met in an earlier table
        if not pair.any():
            continue
        pair &= unit[q] @ unit[target].T >= cosine
        counted[q] += pair @ own["n"][target]
        counted[target] += own["n"][q] @ pair
        for k in np.flatnonzero(pair.any(1)):                   # join what is not joined yet
            linked = target[pair[k]]
            for other in np.unique(top[linked]).tolist():
                mine = int(top[q[k]])
                if other != mine:
                    links.append((int(q[k]), int(linked[top[linked] == other][0])))
                    top[top == other] = mine
    return counted, links


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK,
                    bits: int | None = None, rotations: int | None = None) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``vectors`` (vec_id, embedding).

    ``bits`` and ``rotations`` take the place of the planned ones.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    lengths = rows.filter("size(vector) > 0").groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("d").collect()
    linked = [_of_length(rows, r["d"], cosine, recall, sample, block, bits, rotations) for r in lengths]
    compared = F.lit(False)
    for r in lengths:
        compared = compared | _usable("vector", r["d"])
    out = rows.filter(~compared).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    for part in linked:
        out = part.unionByName(out)
    return out


def _of_length(rows: DataFrame, dimension: int, cosine: float, recall: float, sample: int, block: int, bits: int | None, rotations: int | None) -> DataFrame:
    """vec_id, n_links and component_id of the usable vectors of one length."""
    usable = rows.filter(_usable("vector", dimension))
    classes = usable.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()))
    many = classes.count()
    planned = plan(many, dimension, cosine, recall)
    bits, near = min(bits or planned[0], 64, dimension), planned[2]
    rotations = rotations or rotations_for(bits, dimension, cosine, recall)
    at_most = max(1, min(sample, NUMBERS // dimension))
    draw = hash_share("vector", seed=31)
    chosen = classes.filter(draw < 1.1 * at_most / max(1, many)).orderBy(draw).limit(at_most).select("vector").toArrow()
    learned = _unit(chosen.column("vector").combine_chunks(), dimension) if chosen.num_rows else np.zeros((0, dimension))
    codes = learn(learned, bits, rotations, near)
    coded = stored(_coded(classes, codes, dimension))
    candidates = stored(_candidates(_placed(coded, codes), near, block))
    found = stored(_verified(_blocks(candidates, block).join(coded, "cls"), codes, cosine))
    counts = found.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("add").alias("more"))
    joined = components(found.filter("b is not null").select("a", "b"))
    classes = classes.join(counts, "cls", "left").join(joined, F.col("cls") == F.col("node"), "left")
    classes = classes.withColumn("root", F.coalesce("component", "cls")).withColumn("links", F.col("n") - 1 + F.coalesce("more", F.lit(0)))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(classes.join(names, "root").select("vector", "links", "component_id"))
    return usable.join(named, "vector").select("vec_id", F.col("links").alias("n_links"), "component_id")
