"""From a raw loan table to labelled, split and purified tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanframe.operators.labels import with_labels
from loanframe.operators.purify import purify_splits
from loanframe.operators.splits import check_split_sizes, ordered_cut, temporal_split
from loanframe.sources.tables import first_rows, write_by_month


def labelled_splits(loans: DataFrame) -> DataFrame:
    """Chronological split and all labels; both are narrow projections."""
    return with_labels(temporal_split(loans))


def demo_splits(loans: DataFrame, limit: int = 12_000) -> DataFrame:
    """The same for the first rows only, with running-share boundaries."""
    return with_labels(ordered_cut(first_rows(loans, limit)))


def build_tables(loans: DataFrame, path: str, target_ratio: float = 4.0) -> dict[str, int]:
    """Writes ``splits`` and ``purified`` below ``path``, by split and month.

    The purified table is built from the written splits, so the label
    projection runs once.
    """
    spark = loans.sparkSession
    write_by_month(labelled_splits(loans), f"{path}/splits")
    split = spark.read.parquet(f"{path}/splits").drop("issue_month")
    sizes = check_split_sizes(split)
    write_by_month(purify_splits(split, target_ratio), f"{path}/purified")
    return sizes
