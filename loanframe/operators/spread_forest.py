"""Forests whose nodes stay where they were grown.

An unbounded forest has about as many nodes as its trees have rows, too many for the driver and for a broadcast.  Its
subtrees are rows of a table; rows to be scored are brought together by the bins of their features, and every part of them
meets every subtree in turn.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted
from loanframe.operators.blocks import binned
from loanframe.operators.boosting import walked
from loanframe.operators.ordering import durable

CHUNK_ROWS = 262_144        # distinct rows that are scored by a task
PACK_NODES = 4_000_000      # nodes that meet them at a time
WALKED = 16_384             # rows that are walked at a time: few enough for a core's cache
CELL = "__cell"


class SpreadForest:
    """Upper nodes of all trees, and a table of subtrees: ``tree``, ``node`` (where it hangs), ``feature`` (-1: a leaf), ``bin``,
    ``value`` (per leaf the row of ``leaves``) and ``leaves``.  The n-th split node's children are nodes 2n + 1 and 2n + 2."""

    def __init__(
        self, features: list[str], cuts: list[np.ndarray], n_classes: int, uppers: list[tuple], subtrees: DataFrame, nodes: int, gains: np.ndarray,
    ):
        self.features, self.cuts, self.n_classes, self.uppers = list(features), cuts, n_classes, uppers
        self.subtrees, self.nodes, self.gains = subtrees, nodes, gains

    def importance(self) -> np.ndarray:
        return self.gains

    def cell_column(self, df: DataFrame) -> Column:
        """The bins of a row's features: rows of equal bins have equal shares."""
        cuts = self.cuts
        inputs = F.struct(*[(quoted(c) if c in df.columns else F.lit(0.0)).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])

        @F.pandas_udf("binary")
        def cell(rows: pd.DataFrame) -> pd.Series:
            x = np.ascontiguousarray(binned([rows.iloc[:, i].to_numpy(float) for i in range(rows.shape[1])], cuts).T)
            return pd.Series(np.frombuffer(x.tobytes(), f"V{len(cuts)}").tolist())

        return cell(inputs)

    def shares(self, cells: DataFrame) -> DataFrame:
        """Mean leaf shares of each distinct cell: the cell and ``__p``."""
        width, k, uppers, n_trees = len(self.features), self.n_classes, self.uppers, len(self.uppers)
        cells = durable(cells.distinct())
        cores, n = cells.sparkSession.sparkContext.defaultParallelism, cells.count()
        chunks = max(1, min(max(cores, -(-n // CHUNK_ROWS)), -(-n // 1024)))

        def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = b"".join(v for b in batches for v in b.column(0).to_pylist())
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([held], pa.large_binary())], names=["cells"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [tuple(r.values()) for b in batches for r in b.to_pylist()]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], names=["pack"])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A task has all packs of one or a few chunks, one after the other."""
            totals: dict[bytes, np.ndarray] = {}
            for b in batches:
                for cells, packed in zip(b.column("cells"), b.column("pack")):
                    cells = cells.as_py()
                    x = np.ascontiguousarray(np.frombuffer(cells, np.uint8).reshape(-1, width).T)
                    if cells not in totals:
                        totals[cells] = np.zeros((x.shape[1], k))
                    _add_shares(totals[cells], x, pickle.loads(packed.as_py()), uppers)
            for cells, total in totals.items():
                for at in range(0, len(total), 10_000):
                    own = total[at:at + 10_000]
                    names = np.frombuffer(cells, f"V{width}")[at:at + 10_000].tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *(pa.array(own[:, c]) for c in range(k))], names=[CELL, *(f"s{c}" for c in range(k))])

        dealt = durable(cells.repartition(chunks).mapInArrow(chunk, "cells binary"))
        parts = max(1, min(self.subtrees.rdd.getNumPartitions(), -(-self.nodes // PACK_NODES)))
        packs = self.subtrees.select("tree", "node", "feature", "bin", "value", "leaves").coalesce(parts).mapInArrow(pack, "pack binary")
        # each pair is read as it lies; the pairs of a chunk follow each other
        met = dealt.hint("shuffle_replicate_nl").crossJoin(packs).coalesce(chunks)
        found = met.mapInArrow(score, f"{CELL} binary, " + ", ".join(f"s{c} double" for c in range(k)))
        # read by every pass over the scored rows
        return durable(found.groupBy(CELL).agg(F.array(*[F.sum(f"s{c}") / n_trees for c in range(k)]).alias("__p")))

    def with_probabilities(self, df: DataFrame) -> DataFrame:
        keyed = df.withColumn(CELL, self.cell_column(df))
        return keyed.join(self.shares(keyed.select(CELL)), CELL, "left").drop(CELL)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        meta = pickle.dumps((self.features, self.cuts, self.n_classes, self.uppers, self.nodes, self.gains))
        spark.createDataFrame([(meta,)], "meta binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "SpreadForest":
        spark = SparkSession.getActiveSession()
        features, cuts, n_classes, uppers, nodes, gains = pickle.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        return cls(features, cuts, n_classes, uppers, spark.read.parquet(f"{path}/subtrees"), nodes, gains)


def _add_shares(total: np.ndarray, x: np.ndarray, subtrees: list[tuple], uppers: list[tuple]) -> None:
    """Adds to each row the shares of its leaf in each subtree that it comes to."""
    size = x.shape[1]
    for tree, node, feature, at_most, value, leaves in subtrees:
        feature, at_most = np.frombuffer(feature, np.int16).astype(np.int64), np.frombuffer(at_most, np.uint8).astype(np.int64)
        split = feature >= 0
        left = np.where(split, 2 * np.cumsum(split) - 1, -1)
        leaf = np.zeros(len(feature), np.int64)
        leaf[~split] = np.frombuffer(value, np.int32)
        shares = np.frombuffer(leaves).reshape(-1, total.shape[1])
        alone = len(uppers[tree][0]) == 1
        for at in range(0, size, WALKED):
            own = x[:, at:at + WALKED]
            if alone:
                total[at:at + WALKED] += shares[leaf[walked(own, (feature, at_most, left))]]
                continue
            rows = np.flatnonzero(walked(own, uppers[tree]) == node)
            if len(rows):
                total[at + rows] += shares[leaf[walked(own[:, rows], (feature, at_most, left))]]
