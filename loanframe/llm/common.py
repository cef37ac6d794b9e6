"""What the training-data operators share: shared storage, bounded samples, sorted groups, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"       # a word: no space, tab or line break


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage; a temporary one only where none is set, as in tests."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="loanframe-shared-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of its own below the shared one; a path with a scheme, so that every task reaches the same store."""
    path = shared_folder(spark)
    return f"{path if ':' in path else 'file://' + path}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the rows are written to the shared folder once and dropped from it with the last reference."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def hash_share(*columns: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the named values and the seed alone."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, at_most: int, key: str, seed: int) -> DataFrame:
    """At most ``at_most`` rows of ``df``, chosen by a hash of ``key``: a cheap filter first, then a bound that always holds."""
    n = df.select(F.lit(1)).count()
    if n > at_most:
        df = df.filter(hash_share(key, seed=seed) < 1.1 * at_most / n)
    return df.orderBy(hash_share(key, seed=seed), key).limit(at_most)


# ------------------------------------------------------------------ sorted groups


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a partition that is sorted by ``keys``.

    Yields tables that end where a group ends, with the row numbers at which groups begin (and the row count as last one).
    Holds one batch and one group at a time.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _changes(batch, keys)
        if len(starts) == 1 and held and _same(held[-1], batch, keys):
            held.append(batch)
            continue
        cut = int(starts[-1])
        first = [*held, batch.slice(0, cut)] if cut else held
        if not cut and held and _same(held[-1], batch, keys):
            first, cut, held = [], 0, [*held, batch]
        else:
            held = [batch.slice(cut)]
        if first and sum(b.num_rows for b in first):
            yield _whole(first, keys)
    if held:
        yield _whole(held, keys)


def bounded_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, np.ndarray, bool]]:
    """As ``sorted_groups``, but a group of more than ``most`` rows comes in pieces of its own, marked by the last value."""
    held: list[pa.RecordBatch] = []
    last, rows, big = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = [*_changes(batch, keys).tolist(), batch.num_rows]
        new = 0
        if last is not None and _same(last, batch, keys):
            new = 1
            held.append(batch.slice(0, starts[1]))
            rows += starts[1]
            if big or rows > most:
                yield *_whole(held, keys), True
                held, rows, big = [], 0, True
        if new < len(starts) - 1:
            if held:
                yield *_whole(held, keys), False
            if starts[-2] > starts[new]:
                yield *_whole([batch.slice(starts[new], starts[-2] - starts[new])], keys), False
            held, big = [batch.slice(starts[-2])], False
            rows = held[0].num_rows
        last = batch
    if held:
        yield *_whole(held, keys), False


def _whole(parts: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    done = pa.Table.from_batches([p for p in parts if p.num_rows]).combine_chunks()
    return done, np.append(_changes(done, keys), done.num_rows)


def _numbers(part, name: str) -> np.ndarray:
    column = part.column(name)
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).to_numpy(zero_copy_only=False)


def _changes(part, keys: list[str]) -> np.ndarray:
    new = np.zeros(part.num_rows, bool)
    new[0] = True
    for k in keys:
        v = _numbers(part, k)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _same(before: pa.RecordBatch, after: pa.RecordBatch, keys: list[str]) -> bool:
    return all(_numbers(before.slice(before.num_rows - 1), k)[0] == _numbers(after.slice(0, 1), k)[0] for k in keys)


# ------------------------------------------------------------------ connected components


def components(links: DataFrame) -> DataFrame:
    """Smallest node of each connected component, for every node that has a link: (node, component).

    ``links`` has the long columns a and b.  Large-star and small-star steps alternate until the links are stars; the
    number of rounds grows with the logarithm of the longest path.  Each step is an aggregate and a join on the node, so
    a node with very many neighbours is combined before the shuffle and split by the skew join.
    """
    e = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
        e = stored(_small_star(_large_star(e)))


def _lowest(e: DataFrame) -> DataFrame:
    """Smallest neighbour per node; stored, so that the join deals both sides itself and Spark may split a hot node."""
    return stored(e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).select("n", F.least("n", "m").alias("m"))
    return both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = _lowest(e)
    hung = e.join(low, F.col("a") == F.col("n")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
