"""Trees as flat arrays: scoring, importance, attributions, storage."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted
from loanframe.operators.blocks import binned

WALK = 200_000          # places of rows x trees that are walked at a time: few enough for a core's cache
GROUP_NODES = 4_000_000      # nodes that a worker unpacks at a time


class TreeModel:
    """Trees with ``n_out`` outputs.

    ``feature``, ``bin``, ``left``, ``value`` (a number, or the row of ``leaves``), ``gain`` and ``cover`` are one entry per
    node; a row goes left where its bin is at most the node's, the right child follows the left one.  A leaf's ``left`` is
    -1.  ``root``, ``out`` and ``round`` are one entry per tree.
    """

    ARRAYS = ("feature", "bin", "left", "value", "gain", "cover", "root", "out", "round", "init")

    def __init__(self, kind: str, features: list[str], cuts: list[np.ndarray], arrays: dict[str, np.ndarray], leaves: np.ndarray | None = None):
        self.kind, self.features, self.cuts, self.leaves = kind, list(features), cuts, leaves
        self.arrays = {name: arrays[name] for name in self.ARRAYS}
        self._held = None

    # -------------------------------------------------------------- on arrays

    def margins(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        """rows x outputs: sums of the trees for boosted models, mean leaf shares for forests."""
        a, n = self.arrays, x.shape[1]
        trees = np.arange(len(a["root"])) if rounds is None else np.flatnonzero(a["round"] < rounds)
        total = np.tile(a["init"], (n, 1)).astype(float)
        if not len(trees) or not n:
            return total
        step = max(1, WALK // len(trees))
        for at in range(0, n, step):
            node = self._walk(x[:, at:at + step], trees)
            if self.kind == "forest":
                total[at:at + step] = self.leaves[a["value"][node].astype(np.int64)].mean(axis=1)
            else:
                value = a["value"][node]
                for o in range(total.shape[1]):
                    total[at:at + step, o] += value[:, a["out"][trees] == o].sum(axis=1)
        return total

    def _walk(self, x: np.ndarray, trees: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        a, n = self.arrays, x.shape[1]
        flat, feature, at_most, left = np.ascontiguousarray(x.T).ravel(), a["feature"], a["bin"], a["left"]
        node = np.tile(a["root"][trees].astype(np.int64), n)
        going = np.flatnonzero(left[node] >= 0)
        at, first = node[going], going // max(1, len(trees)) * len(x)          # where the row's bins begin
        while len(going):
            at = left.take(at) + (flat.take(first + feature.take(at)) > at_most.take(at))
            node[going] = at
            more = left.take(at) >= 0
            going, at, first = going[more], at[more], first[more]
        return node.reshape(n, len(trees))

    def parts(self, x: np.ndarray) -> np.ndarray:
        """rows x outputs x (features + 1): what each split on a row's path adds to the margin; the last entry is the start.

        Each node's ``value`` is the margin a tree gives when it ends there, so the parts of a row add up to its margin.
        """
        a, n, f = self.arrays, x.shape[1], len(self.features)
        out = np.zeros((n, len(a["init"]), f + 1))
        out[:, :, f] = a["init"]
        for tree in range(len(a["root"])):
            o, node = int(a["out"][tree]), np.full(n, a["root"][tree], np.int64)
            out[:, o, f] += a["value"][node]
            going = np.flatnonzero(a["left"][node] >= 0)
            while len(going):
                at = node[going]
                to = a["left"][at] + (x[a["feature"][at], going] > a["bin"][at])
                np.add.at(out, (going, o, a["feature"][at]), a["value"][to] - a["value"][at])
                node[going] = to
                going = going[a["left"][to] >= 0]
        return out

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        if self.kind == "forest":
            return margin
        if self.kind == "logistic":
            p = 1.0 / (1.0 + np.exp(-margin[:, 0]))
            return np.stack([1.0 - p, p], axis=1)
        e = np.exp(margin - margin.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def importance(self) -> np.ndarray:
        """Gain per feature.  Forests: shares per tree, averaged; boosted: share of all gain."""
        a = self.arrays
        split = a["left"] >= 0
        if self.kind != "forest":
            total = np.bincount(a["feature"][split], a["gain"][split], len(self.features))
            return total / total.sum() if total.sum() else total
        bounds, out, trees = np.append(a["root"], len(a["left"])), np.zeros(len(self.features)), 0
        for s, e in zip(bounds[:-1], bounds[1:]):
            own = np.bincount(a["feature"][s:e][split[s:e]], a["gain"][s:e][split[s:e]], len(self.features))
            if own.sum():
                out, trees = out + own / own.sum(), trees + 1
        return out / out.sum() if trees else out

    # -------------------------------------------------------------- on tables

    def _shared(self, spark: SparkSession):
        """The arrays, sent once to each worker that scores; a few numbers per node."""
        if self._held is None:
            keep = ("root", "out", "round", "init", "feature", "bin", "left", "value")
            slim = {k: v for k, v in self.arrays.items() if k in keep} | {k: np.zeros(0) for k in ("gain", "cover")}
            self._held = spark.sparkContext.broadcast((self.kind, self.features, self.cuts, slim, self.leaves))
        return self._held

    def _scored(self, df: DataFrame, of, kind: str) -> Column:
        held = self._shared(df.sparkSession)
        inputs = F.struct(*[(quoted(c) if c in df.columns else F.lit(0.0)).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])

        @F.pandas_udf(kind)
        def score(rows: pd.DataFrame) -> pd.Series:
            model = TreeModel(*held.value)
            return pd.Series(list(of(model, binned([rows.iloc[:, i].to_numpy(float) for i in range(rows.shape[1])], model.cuts))))

        return score(inputs)

    def probability_column(self, df: DataFrame, rounds: int | None = None) -> Column:
        return self._scored(df, lambda model, x: model.probabilities(model.margins(x, rounds)), "array<double>")

    def number_column(self, df: DataFrame, rounds: int | None = None) -> Column:
        return self._scored(df, lambda model, x: model.margins(x, rounds)[:, 0], "double")

    def parts_column(self, df: DataFrame) -> Column:
        """Per output the parts of all features and the start."""
        return self._scored(df, lambda model, x: [p.ravel() for p in model.parts(x)], "array<double>")

    # -------------------------------------------------------------- storage

    def save(self, path: str) -> None:
        """A few files of bounded size; nodes in pieces."""
        spark = SparkSession.getActiveSession()
        held = {**self.arrays, **{f"cut{i}": c for i, c in enumerate(self.cuts)}, **({} if self.leaves is None else {"leaves": self.leaves.ravel()})}
        rows = [(name, at, str(v.dtype), v[at:at + GROUP_NODES].tobytes()) for name, v in held.items() for at in range(0, max(1, len(v)), GROUP_NODES)]
        meta = json.dumps({"kind": self.kind, "features": self.features, "width": None if self.leaves is None else self.leaves.shape[1]}, ensure_ascii=False)
        spark.createDataFrame([("meta", 0, "text", meta.encode()), *rows], "name string, at bigint, type string, bytes binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> "TreeModel":
        rows = SparkSession.getActiveSession().read.parquet(path).collect()
        meta = json.loads(next(r["bytes"] for r in rows if r["name"] == "meta").decode())
        held: dict[str, list] = {}
        for r in sorted((r for r in rows if r["name"] != "meta"), key=lambda r: (r["name"], r["at"])):
            held.setdefault(r["name"], []).append(np.frombuffer(bytes(r["bytes"]), np.dtype(r["type"])))
        whole = {name: np.concatenate(v) for name, v in held.items()}
        leaves = whole["leaves"].reshape(-1, meta["width"]) if meta["width"] else None
        return cls(meta["kind"], meta["features"], [whole[f"cut{i}"] for i in range(len(meta["features"]))], whole, leaves)
