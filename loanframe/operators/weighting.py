"""Class weights as plain dictionaries and as a weight column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions.fields import lookup, quoted


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class; the number of classes is small."""
    rows = df.groupBy(quoted(label).cast("int").alias("label")).count().collect()
    return {r["label"]: r["count"] for r in sorted(rows, key=lambda r: r["label"])}


def balanced(counts: dict[int, int]) -> dict[int, float]:
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def balanced_weights(df: DataFrame, label: str) -> dict[int, float]:
    return balanced(class_counts(df, label))


def balanced_weight_table(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(quoted(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    return counts.crossJoin(F.broadcast(totals)).select(
        "label", "n", F.try_divide(F.col("total"), F.col("k") * F.col("n")).alias("weight")
    )


def resolve(counts: dict[int, int], mode: str, manual: dict[int, float] | None = None) -> dict[int, float] | None:
    """Weights for the classes present: none, balanced, or given (1 if not given)."""
    if mode == "none":
        return None
    if mode == "auto":
        return balanced(counts)
    if mode != "manual":
        raise ValueError(f"unknown weight mode {mode}")
    if not manual:
        raise ValueError("manual weighting needs a weight per class")
    if not set(manual) & set(counts):
        raise ValueError("no given weight belongs to a class in the training rows")
    return {c: float(manual.get(c, 1.0)) for c in counts}


def weight_column(label: str, weights: dict[int, float] | None) -> Column:
    return F.lit(1.0) if not weights else lookup(quoted(label), weights, 1.0)
