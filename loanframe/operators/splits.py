"""Chronological splits with exact row counts.

The order is (issue month, id).  A split boundary is one month and one id, so
rows are assigned by comparing with a few literals: the table is scanned twice
for counts and never shuffled or sorted as a whole.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions.fields import any_of, month, quoted
from loanframe.operators.ordering import order_statistics

SPLITS = ("train", "val", "test")


def month_counts(df: DataFrame) -> DataFrame:
    """Rows per issue month; the unparsable ones under a NULL month."""
    return df.groupBy(month(df, "issue_d").alias("issue_month")).agg(F.count("*").alias("n"))


def dated_only(df: DataFrame) -> DataFrame:
    return df.where(month(df, "issue_d").isNotNull())


def undated_count(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(month(df, "issue_d").isNull()).alias("n_undated"), F.count("*").alias("n_rows")
    )


@dataclass(frozen=True)
class Cut:
    """The first row that lies behind a boundary."""

    month: dt.date | None
    key: int | None

    def behind(self, issue_month: Column, key: Column) -> Column:
        if self.month is None:          # boundary after the last row
            return F.lit(False)
        on_month = (issue_month == F.lit(self.month)) & (key >= F.lit(self.key))
        return (issue_month > F.lit(self.month)) | on_month


def cuts_at(df: DataFrame, ranks: list[int], counts: list | None = None, key: str = "id") -> list[Cut]:
    """Boundaries in front of the given zero-based ranks of the dated rows.

    The month histogram has one row per calendar month.  Only months that
    contain a boundary are looked at again, to find the id at the exact rank.
    """
    if counts is None:
        counts = dated_only(df).transform(month_counts).orderBy("issue_month").collect()
    places: list[tuple | None] = []
    for rank in ranks:
        seen, place = 0, None
        for row in counts:
            if rank < seen + row["n"]:
                place = (row["issue_month"], rank - seen)
                break
            seen += row["n"]
        places.append(place)
    months = sorted({p[0] for p in places if p})
    dated = df.select(month(df, "issue_d").alias("issue_month"), quoted(key).alias("key"))
    dated = dated.where(F.col("issue_month").isin(months)).persist()        # several passes, so that what is below is read once
    found = order_statistics(dated, "key", [p for p in places if p], group="issue_month")
    dated.unpersist()
    return [Cut(p[0], found[p]) if p else Cut(None, None) for p in places]


def split_sizes(total: int, shares: tuple[float, float] = (0.70, 0.15)) -> tuple[int, int, int]:
    """Row counts of train, validation and test; the rest goes to test."""
    train, val = (int(total * s) for s in shares)
    return train, val, total - train - val


def _numbered(df: DataFrame, cuts: list[Cut], key: str, names: tuple = ()) -> Column:
    """How many boundaries a row lies behind, or the name for it; NULL for rows without an issue month.

    The month is bound to a lambda variable, so it is parsed once for all comparisons.
    """
    def behind(issue_month: Column) -> Column:
        reached = F.lit(names[0] if names else 0)
        for number, cut in enumerate(cuts, 1):              # boundaries rise, so the last one reached counts
            reached = F.when(cut.behind(issue_month, quoted(key)), names[number] if names else number).otherwise(reached)
        return F.when(issue_month.isNotNull(), reached)

    return F.transform(F.array(month(df, "issue_d")), behind)[0]


def _label_splits(df: DataFrame, bounds: list[int], counts: list, key: str) -> DataFrame:
    number = _numbered(df, cuts_at(df, bounds, counts, key), key, SPLITS)
    return df.withColumn("split", number).where(F.col("split").isNotNull())


def temporal_split(df: DataFrame, shares: tuple[float, float] = (0.70, 0.15), key: str = "id") -> DataFrame:
    """Adds ``split`` so that older loans train and newer ones test.

    Rows without an issue month are dropped.  ``key`` must be unique and
    integral; it breaks ties inside the month of a boundary.
    """
    counts = dated_only(df).transform(month_counts).orderBy("issue_month").collect()
    train, val, _ = split_sizes(sum(r["n"] for r in counts), shares)
    return _label_splits(df, [train, train + val], counts, key)


def ordered_cut(df: DataFrame, upto: tuple[float, float] = (0.70, 0.85), key: str = "id") -> DataFrame:
    """Like :func:`temporal_split`, with boundaries given as running shares."""
    counts = dated_only(df).transform(month_counts).orderBy("issue_month").collect()
    total = sum(r["n"] for r in counts)
    return _label_splits(df, [int(total * s) for s in upto], counts, key)


def check_split_sizes(split: DataFrame, shares: tuple[float, float] = (0.70, 0.15)) -> dict[str, int]:
    """Row counts per split; raises when they are not the requested ones."""
    seen = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    got = tuple(seen.get(s, 0) for s in SPLITS)
    wanted = split_sizes(sum(got), shares)
    if got != wanted:
        raise ValueError(f"split sizes {got} differ from the requested {wanted}")
    return dict(zip(SPLITS, got))


def month_plan(df: DataFrame, shares: tuple[float, float] = (0.70, 0.15)) -> DataFrame:
    """Rows each issue month gives to train, validation and test.

    Works on the month histogram, which has one row per calendar month.
    """
    from pyspark.sql import Window

    per_month = dated_only(df).transform(month_counts)
    upto = Window.orderBy("issue_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(0))
    placed = per_month.withColumns({
        "upto": F.sum("n").over(upto), "total": F.sum("n").over(every),
    }).withColumns({
        "before": F.col("upto") - F.col("n"),
        "b1": F.floor(F.col("total") * F.lit(shares[0])),
    })
    placed = placed.withColumn("b2", F.col("b1") + F.floor(F.col("total") * F.lit(shares[1])))

    def overlap(low, high):
        return F.greatest(F.least("upto", high) - F.greatest("before", low), F.lit(0)).cast("bigint")

    zero = F.lit(0).cast("bigint")
    return placed.select(
        "issue_month", "n",
        overlap(zero, F.col("b1")).alias("n_train"),
        overlap(F.col("b1"), F.col("b2")).alias("n_val"),
        overlap(F.col("b2"), F.col("total")).alias("n_test"),
    )


# ------------------------------------------------------------------------- time folds


def fold_bounds(n_rows: int, n_folds: int = 5) -> list[tuple[int, int]]:
    """(first validation rank, end rank) of expanding-window folds."""
    size = n_rows // (n_folds + 1)
    if size == 0:
        raise ValueError(f"{n_rows} rows are too few for {n_folds} folds")
    return [(n_rows - (n_folds - i) * size, n_rows - (n_folds - i - 1) * size) for i in range(n_folds)]


def with_time_folds(df: DataFrame, n_folds: int = 5, key: str = "id") -> DataFrame:
    """Adds ``fold``: -1 for rows before every validation block, else its block.

    Fold i trains on rows with ``fold < i`` and validates on ``fold == i``.
    """
    counts = dated_only(df).transform(month_counts).orderBy("issue_month").collect()
    starts = [a for a, _ in fold_bounds(sum(r["n"] for r in counts), n_folds)]
    cuts = cuts_at(df, starts, counts, key)
    return df.withColumn("fold", _numbered(df, cuts, key) - 1).where(F.col("fold").isNotNull())


def fold_sizes(folded: DataFrame, n_folds: int = 5) -> DataFrame:
    """Training and validation rows of every fold."""
    per_block = folded.groupBy("fold").agg(F.count("*").alias("n"))
    spark = folded.sparkSession
    folds = spark.createDataFrame([(i,) for i in range(n_folds)], "fold_no int")
    return (
        per_block.join(F.broadcast(folds), any_of([F.col("fold") <= F.col("fold_no")]))
        .groupBy("fold_no")
        .agg(
            F.sum(F.when(F.col("fold") < F.col("fold_no"), F.col("n")).otherwise(0)).alias("n_train"),
            F.sum(F.when(F.col("fold") == F.col("fold_no"), F.col("n")).otherwise(0)).alias("n_valid"),
        )
    )
