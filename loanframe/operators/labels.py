"""Labels derived from the observed repayment of each loan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import (
    any_of, clamp, half_even, is_yes, lookup, month, num, opt_col, quoted, status, term_months,
    true_or_false, within,
)

RISK = "preloan_risk_label"
LIMIT = "calibrated_credit_limit"
OVERDUE = "estimated_overdue_days"
SCENE = "postloan_scene_label"

# ---- fixed values: bands and shares of the credit limit ----
LIMIT_BANDS = [(5_000, "<=5k"), (10_000, "5k-10k"), (20_000, "10k-20k"), (50_000, "20k-50k")]
TOP_BAND = "50k+"
RISK_MULTIPLIERS = {0: 1.0, 1: 0.85, 2: 0.55, 3: 0.20}


def overdue_days(df: DataFrame) -> Column:
    """Conservative estimate of the days past due.

    One flat CASE: label columns feed later predicates, and each use of a
    nested value would be copied into them.
    """
    state = status(df)
    reported = clamp(num(df, "hardship_dpd", 0.0), 0.0)
    overdue_amount = clamp(num(df, "delinq_amnt", 0.0), 0.0)
    missed = F.ceil(F.try_divide(overdue_amount, F.nullif(num(df, "installment"), F.lit(0.0))))
    late_guess = F.coalesce(within(missed * 30.0, 31.0, 120.0), F.lit(60.0))
    return (
        F.when(state.isin(vocab.LOSS_STATUSES), F.greatest(reported, F.lit(181.0)))
        .when(reported > 0, reported)
        .when(state == vocab.GRACE, 15.0)
        .when(state == vocab.LATE_SHORT, 23.0)
        .when(state == vocab.LATE_LONG, late_guess)
        .when(overdue_amount > 0, 15.0)
        .otherwise(0.0)
        .cast("int")
    )


def risk_class(df: DataFrame) -> Column:
    """0 normal, 1 up to 30 days, 2 up to 180 days, 3 loss; reads ``OVERDUE``."""
    days = quoted(OVERDUE)
    loss = any_of([
        status(df).isin(vocab.LOSS_STATUSES),
        days > 180,
        is_yes(df, "debt_settlement_flag"),
        opt_col(df, "settlement_status").isNotNull(),
        num(df, "recoveries", 0.0) > 0,
    ])
    return F.when(loss, 3).when(days > 30, 2).when(days > 0, 1).otherwise(0)


def credit_limit(df: DataFrame) -> Column:
    """Affordable limit scaled down by risk, in whole hundreds; reads ``RISK``."""
    burden = clamp(num(df, "dti", 0.0) / 100.0, 0.0, 1.5)
    share = clamp(0.45 - 0.30 * burden, 0.08, 0.45)
    affordable = clamp(num(df, "annual_inc", 0.0), 0.0) * share
    asked = clamp(num(df, "loan_amnt", 0.0), 0.0)
    scaled = F.least(asked, affordable) * lookup(quoted(RISK), RISK_MULTIPLIERS, 0.20)
    floored = F.when(scaled > 0, F.greatest(scaled, F.lit(500.0))).otherwise(0.0)
    return (half_even(floored / 100.0, 0) * 100).cast("int")


def limit_band(limit: Column) -> Column:
    band = F
    for upper, name in LIMIT_BANDS:
        band = band.when(limit <= upper, name)
    return band.otherwise(TOP_BAND)


def scene_class(df: DataFrame) -> Column:
    """0 maintain, 1 warn, 2 collect, 3 negotiate; reads ``RISK`` and ``OVERDUE``."""
    risk, days = quoted(RISK), quoted(OVERDUE)
    negotiate = any_of([
        is_yes(df, "hardship_flag"),
        is_yes(df, "debt_settlement_flag"),
        opt_col(df, "settlement_status").isNotNull(),
        risk == 3,
    ])
    return (
        F.when(negotiate, 3)
        .when((days > 30) | (risk == 2), 2)
        .when((days > 0) | (risk == 1), 1)
        .otherwise(0)
    )


def with_labels(df: DataFrame) -> DataFrame:
    """All seven label columns, as one narrow chain of projections."""
    out = df.withColumn(OVERDUE, overdue_days(df))
    out = out.withColumn(RISK, risk_class(out))
    out = out.withColumn(LIMIT, credit_limit(out))
    out = out.withColumn(SCENE, scene_class(out))
    return out.withColumns({
        f"{RISK}_name": lookup(quoted(RISK), vocab.RISK_NAMES),
        f"{LIMIT}_band": limit_band(quoted(LIMIT)),
        f"{SCENE}_name": lookup(quoted(SCENE), vocab.SCENE_NAMES),
    })


def remap_class(label: Column, scheme: dict) -> Column:
    return lookup(label, scheme)


# --------------------------------------------------------------------------- maturity


def observation_date(df: DataFrame) -> DataFrame:
    """One row: latest credit pull, else the latest issue month."""
    return df.agg(
        F.coalesce(F.max(month(df, "last_credit_pull_d")), F.max(month(df, "issue_d")))
        .alias("observed_on")
    )


def with_maturity(df: DataFrame, observed_on: dt.date | None = None) -> DataFrame:
    """Adds ``is_mature``: the final outcome of the loan can already be known.

    The observation date is a one-row aggregate, so the cross join with it is
    a broadcast of a single value.
    """
    if observed_on is None:
        base = df.crossJoin(F.broadcast(observation_date(df)))
    else:
        base = df.withColumn("observed_on", F.lit(observed_on).cast("date"))
    days = num(df, OVERDUE, 0.0) if OVERDUE in df.columns else overdue_days(df)
    due = F.date_add(month(df, "issue_d"), (term_months(df) * 30).cast("int"))
    mature = any_of([
        status(df).isin(vocab.TERMINAL_STATUSES),
        true_or_false(days > 0),
        true_or_false(due <= F.col("observed_on")),
    ])
    return base.withColumn("is_mature", mature).drop("observed_on")


def mature_only(df: DataFrame, observed_on: dt.date | None = None) -> DataFrame:
    return with_maturity(df, observed_on).where("is_mature").drop("is_mature")


def maturity_impact(df: DataFrame, classes: list[int], label: str = RISK) -> DataFrame:
    """Class counts and shares before and after the maturity filter, one pass."""
    counts = with_maturity(df).groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n_before"),
        F.count_if("is_mature").alias("n_after"),
    )
    return with_shares(fill_classes(counts, classes, ["n_before", "n_after"]), {
        "n_before": "share_before", "n_after": "share_after",
    }).withColumn("kept_share", _over_total("n_after", "n_before"))


# ----------------------------------------------------------------------- distributions


def fill_classes(counts: DataFrame, classes: list[int], columns: list[str]) -> DataFrame:
    """Counts for every listed class, zero where none was seen."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(int(c),) for c in classes], "label int")
    joined = wanted.join(counts.withColumn("label", F.col("label").cast("int")), "label", "left")
    return joined.select("label", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in columns])


def _over_total(part: str, whole: str) -> Column:
    # windows here span the rows of a class table: one row per label
    from pyspark.sql import Window

    every = Window.partitionBy(F.lit(0))
    return F.round(F.try_divide(F.sum(part).over(every), F.sum(whole).over(every)), 6)


def with_shares(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    from pyspark.sql import Window

    every = Window.partitionBy(F.lit(0))
    return counts.withColumns({
        share: F.round(F.coalesce(F.try_divide(F.col(n), F.sum(n).over(every)), F.lit(0.0)), 6)
        for n, share in names.items()
    })


def class_distribution(df: DataFrame, label: str, classes: list[int] | None = None) -> DataFrame:
    """Count and share per class; listed classes appear even when empty."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
    if classes is not None:
        counts = fill_classes(counts, classes, ["n"])
    return with_shares(counts, {"n": "share"})


def compare_distributions(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Counts per class in two tables over the union of their labels."""
    tagged = [
        part.select(F.col(label).cast("int").alias("label"), F.lit(i).alias("side"))
        for i, part in enumerate([before, after])
    ]
    return (
        tagged[0].unionByName(tagged[1])
        .groupBy("label")
        .agg(F.count_if(F.col("side") == 0).alias("n_before"), F.count_if(F.col("side") == 1).alias("n_after"))
    )
