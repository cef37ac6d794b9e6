"""Training rows as blocks of bins, the input of the tree learners.

Every feature is cut into at most 255 bins, once.  A block holds the bins of some thousand rows, one byte per value, next to
their class or target, their weight key and their time fold.  Passes over the rows are passes over blocks: a task answers
with sums, whose size depends on features, bins and nodes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted

BINS = 255
CUT_ROWS = 100_000      # rows that the cuts are learned from; all rows are binned and counted
MOST_ROWS = 65_536      # rows of a block
LEAST_ROWS = 2_048
DEALT = 16              # blocks per core, so that all cores are dealt about as many rows
WAVE_ROWS = 262_144     # rows of a partition, about


@dataclass
class Blocks:
    """Blocks of one table: x (features x rows, bytes), y, fold, key."""

    frame: DataFrame
    rdd: RDD
    cuts: list[np.ndarray]
    n: int

    @property
    def bins(self) -> np.ndarray:
        """Number of bins per feature."""
        return np.array([len(c) + 1 for c in self.cuts], np.int64)

    def release(self) -> None:
        self.rdd.unpersist()
        self.frame.unpersist()


def _values(df: DataFrame, columns: list[str]) -> list[Column]:
    return [(quoted(c) if c in df.columns else F.lit(0.0)).cast("double").alias(f"f{i}") for i, c in enumerate(columns)]


def learn_cuts(df: DataFrame, columns: list[str], n: int, bins: int = BINS, at_most: int = CUT_ROWS, seed: int = 42) -> list[np.ndarray]:
    """Cuts per feature: a value belongs to the bin of the cuts below it.

    Few distinct values get a bin each, many get bins of about equal rows.  Up to ``at_most`` rows all values are seen,
    beyond that a sample of so many.
    """
    sample = df if n <= at_most else df.sample(fraction=min(1.0, 1.02 * at_most / n), seed=seed)
    table = sample.select(*_values(df, columns)).limit(at_most).toArrow()
    return [feature_cuts(np.asarray(table.column(i).to_numpy(), float), bins) for i in range(len(columns))]


def feature_cuts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    values = np.sort(values[~np.isnan(values)])
    if not len(values):
        return np.zeros(0)
    distinct = values[np.append(True, np.diff(values) > 0)]
    if len(distinct) > bins:
        at = np.linspace(0, len(values) - 1, bins + 1)[1:-1].astype(np.int64)
        below = np.unique(values[at])
        place = np.searchsorted(distinct, below)
        return _between(below[place + 1 < len(distinct)], distinct[place[place + 1 < len(distinct)] + 1])
    return _between(distinct[:-1], distinct[1:])


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A cut between neighbours: their middle, or the lower one where no number lies between."""
    with np.errstate(over="ignore", invalid="ignore"):
        middle = low / 2 + high / 2
    return np.where((middle > low) & (middle < high), middle, low)


def binned(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Features x rows; missing values go to the last bin."""
    return np.stack([np.searchsorted(c, v, side="left").astype(np.uint8) for v, c in zip(columns, cuts)]) if cuts else np.zeros((0, 0), np.uint8)


def make_blocks(
    df: DataFrame, features: list[str], target: Column, fold: Column | None = None, bins: int = BINS, cut_rows: int = CUT_ROWS,
    rows_per_block: int | None = None,
) -> Blocks:
    """Bins the rows and keeps the blocks in memory or on disk until released."""
    context = df.sparkSession.sparkContext
    n = df.select(F.lit(1)).count()
    cuts = learn_cuts(df, features, n, bins, cut_rows)
    size = rows_per_block or min(MOST_ROWS, max(LEAST_ROWS, -(-n // (DEALT * context.defaultParallelism))))
    names = [f"f{i}" for i in range(len(features))]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts)
            x = binned([np.asarray(t.column(c).to_numpy(), float) for c in names], cuts)
            own = [x.tobytes(), *(np.ascontiguousarray(t.column(c).to_numpy()).tobytes() for c in ("y", "fold", "key"))]
            return pa.RecordBatch.from_arrays([pa.array([t.num_rows]), *(pa.array([o], pa.binary()) for o in own)], names=["n", "x", "y", "fold", "key"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(batch.slice(at, size))
                if sum(b.num_rows for b in held) >= size:
                    yield done(held)
                    held = []
        if held:
            yield done(held)

    rows = df.select(
        *_values(df, features), target.cast("double").alias("y"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
        F.xxhash64(*_values(df, features), target).alias("key"),
    )
    frame = rows.mapInArrow(build, "n bigint, x binary, y binary, fold binary, key binary")
    waves = max(1, -(-n // (WAVE_ROWS * context.defaultParallelism)))
    frame = frame.repartition(max(1, min(-(-n // size), waves * context.defaultParallelism))).persist(StorageLevel.MEMORY_AND_DISK)
    return Blocks(frame, frame.rdd.mapPartitions(lambda rows: joined(map(unpacked, rows), rows_per_block or MOST_ROWS)).persist(StorageLevel.MEMORY_AND_DISK), cuts, n)


def joined(blocks: Iterator[dict], size: int) -> Iterator[dict]:
    """Blocks of at most ``size`` rows made of smaller ones, as a pass costs less on few blocks; larger ones stay alone."""
    held: list[dict] = []
    for b in blocks:
        if held and sum(len(x["y"]) for x in held) + len(b["y"]) > size:
            yield _one(held)
            held = []
        held.append(b)
    if held:
        yield _one(held)


def _one(blocks: list[dict]) -> dict:
    return blocks[0] if len(blocks) == 1 else {name: np.concatenate([b[name] for b in blocks], axis=-1) for name in blocks[0]}


def unpacked(row) -> dict:
    """The arrays of a stored block."""
    n = row["n"]
    return {
        "x": np.frombuffer(row["x"], np.uint8).reshape(-1, n), "y": np.frombuffer(row["y"], float),
        "fold": np.frombuffer(row["fold"], np.int32), "key": np.frombuffer(row["key"], np.int64).view(np.uint64),
    }


def mixed(key: np.ndarray, *salts: int) -> np.ndarray:
    """Well-spread 64-bit numbers from a key and salts."""
    h = key.astype(np.uint64)
    for salt in salts:
        h = (h ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def share(key: np.ndarray, *salts: int) -> np.ndarray:
    """A number in [0, 1) per key."""
    return (mixed(key, *salts) >> np.uint64(11)).astype(float) / float(1 << 53)


def summed(rdd: RDD, of) -> np.ndarray:
    """Sum over all blocks of an array of bounded size; many partitions add up in two steps."""
    def within(blocks):
        total = None
        for b in blocks:
            own = of(b)
            total = own if total is None else total + own
        return [] if total is None else [total]

    part = rdd.mapPartitions(within)
    if part.getNumPartitions() > 64:
        return part.treeReduce(np.add, 2)
    total = None
    for own in part.collect():
        total = own if total is None else total + own
    return total
