"""Sample-quality rules and stratified down-sampling of normal loans."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import (
    any_of, is_missing, month, month_gap, num, opt_col, quoted, status, true_or_false, within,
)
from loanframe.operators.labels import RISK
from loanframe.operators.ordering import (
    bucket_digits, dealt, durable, exact_quantiles, quota_edges, rows_up_to_edge,
)

CORE_FIELDS = ["annual_inc", "dti", "delinq_2yrs", "inq_last_6mths"]
RULES = ["missing_core", "too_fresh", "too_few_payments", "unused_line", "odd_clean_debtor"]
MIN_MONTHS = 6
MIN_PAYMENTS = 3
MIN_UTILISATION = 1.0
MAX_CLEAN_DTI = 80.0


def is_normal(df: DataFrame) -> Column:
    """A paid or running loan whose risk label, when there is one, is 0."""
    fine = status(df).isin(vocab.NORMAL_STATUSES)
    return fine & (num(df, RISK, 1.0) == 0) if RISK in df.columns else fine


def observed_months(df: DataFrame) -> Column:
    issued = month(df, "issue_d")
    end = F.coalesce(month(df, "last_pymnt_d"), month(df, "last_credit_pull_d"), issued)
    return F.greatest(F.coalesce(month_gap(issued, end), F.lit(0)), F.lit(0)).cast("int")


def repayment_periods(df: DataFrame) -> Column:
    """Instalments covered by the money paid, at least the observed months."""
    months = observed_months(df).cast("double")
    instalment = F.nullif(num(df, "installment"), F.lit(0.0))
    covered = F.floor(F.try_divide(within(num(df, "total_pymnt"), 0.0), instalment))
    return F.greatest(F.coalesce(covered.cast("double"), months), months, F.lit(0.0))


def _core_missing(df: DataFrame) -> Column:
    absent = [c for c in CORE_FIELDS if c not in df.columns]
    if absent:
        warnings.warn(f"columns {absent} are absent, so every row counts as missing a core field", stacklevel=3)
    return any_of([is_missing(df, c) for c in CORE_FIELDS])


def _normal_rules(df: DataFrame) -> list[Column]:
    """The rules for normal loans, in the order of ``RULES[1:]``; unknown
    comparisons keep the row."""
    no_delinquency = (num(df, "delinq_2yrs", 0.0) <= 0) & (num(df, "acc_now_delinq", 0.0) <= 0)
    return [true_or_false(m) for m in (
        observed_months(df) < MIN_MONTHS,
        repayment_periods(df) < MIN_PAYMENTS,
        num(df, "revol_util") < MIN_UTILISATION,
        (num(df, "dti") > MAX_CLEAN_DTI) & no_delinquency,
    )]


def purify(df: DataFrame) -> DataFrame:
    """Rows no removal rule applies to.

    Filters are pushed below the projections they read, which copies an
    expression for every use of it.  So the normal-loan predicate is written
    once, and the payments rule is left out: a loan has at least as many
    payments as observed months, so whatever it removes is too fresh as well.
    """
    rules = _normal_rules(df)
    if MIN_PAYMENTS <= MIN_MONTHS:
        del rules[RULES.index("too_few_payments") - 1]
    return df.where(~(_core_missing(df) | (is_normal(df) & any_of(rules))))


def rule_counts(df: DataFrame) -> DataFrame:
    """Rows hit by each rule and by any rule, in one pass."""
    flagged = df.withColumn("__normal", is_normal(df))
    masks = [_core_missing(df)] + [F.col("__normal") & m for m in _normal_rules(df)]
    hits = flagged.select(*[m.alias(n) for n, m in zip(RULES, masks)])
    totals = hits.agg(
        *[F.count_if(n).alias(n) for n in RULES],
        F.count_if(any_of([F.col(n) for n in RULES])).alias("any_rule"),
    )
    names = [*RULES, "any_rule"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_rows")) for n in names]))
    return totals.select(pairs.alias("p")).select("p.*")


def normal_risk_summary(df: DataFrame) -> DataFrame:
    """Row counts of both sides and their ratio: infinite without risk rows,
    NaN for an empty table."""
    counted = df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_normal(df)).alias("n_normal"),
        F.count_if(~is_normal(df)).alias("n_risk"),
    )
    ratio = (
        F.when(F.col("n_rows") == 0, F.lit(float("nan")))
        .when(F.col("n_risk") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(F.col("n_normal"), F.col("n_risk")))
    )
    return counted.withColumn("normal_risk_ratio", ratio)


# ------------------------------------------------------------------------------ strata


def fifth_code(value: Column, edges: list[float] | None, prefix: str) -> Column:
    """Name of the fifth a value lies in; equal edges are merged first.

    Equal values share a fifth.  Missing values, and columns whose edges are
    all the same, are ``unknown``.
    """
    distinct = sorted(set(edges or []))
    if len(distinct) < 2:
        return F.lit(f"{prefix}_unknown")
    code = F.when(value.isNull(), f"{prefix}_unknown")
    for i, upper in enumerate(distinct[1:-1]):
        code = code.when(value <= upper, f"{prefix}_{i}")
    return code.otherwise(f"{prefix}_{len(distinct) - 2}")


STRATA_FIELDS = {"annual_inc": "inc", "dti": "dti"}


def strata_edges(normal: DataFrame) -> dict[str, list[float] | None]:
    """Edges of the income and burden fifths; None with fewer than five values."""
    numeric = normal.select(*[num(normal, c).alias(c) for c in STRATA_FIELDS])
    return exact_quantiles(numeric, list(STRATA_FIELDS), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], min_rows=5)


def strata_key(df: DataFrame, edges: dict) -> Column:
    """grade | income fifth | burden fifth."""
    codes = [fifth_code(num(df, c), edges.get(c), p) for c, p in STRATA_FIELDS.items()]
    return F.concat_ws("|", F.coalesce(opt_col(df, "grade").cast("string"), F.lit("Unknown")), *codes)


def with_strata(normal: DataFrame) -> DataFrame:
    return normal.withColumn("strata_key", strata_key(normal, strata_edges(normal)))


def quotas(sizes: DataFrame, target: int) -> DataFrame:
    """Shares ``target`` out over strata by size, largest remainder first.

    ``sizes`` (``strata_key``, ``n``) has one row per stratum, so the windows
    here run over a table of a few hundred rows.
    """
    every = Window.partitionBy(F.lit(0))
    exact = sizes.withColumn("exact", F.col("n") / F.sum("n").over(every) * F.lit(int(target)))
    floored = exact.withColumn("base", F.least(F.floor("exact"), F.col("n")))
    floored = floored.withColumns({
        "left": F.lit(int(target)) - F.sum("base").over(every),
        "open": F.col("base") < F.col("n"),
    })
    turn = Window.partitionBy("open").orderBy(F.desc(F.col("exact") - F.col("base")), "strata_key")
    extra = F.when(F.col("open") & (F.row_number().over(turn) <= F.col("left")), 1).otherwise(0)
    return floored.select("strata_key", "n", (F.col("base") + extra).cast("bigint").alias("quota"))


def strata_sizes(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("strata_key").agg(F.count("*").alias("n"))


def stratified_sample(df: DataFrame, target_ratio: float = 4.0, seed: int = 42, key: str = "id") -> DataFrame:
    """Keeps every risk row and at most ``target_ratio`` times as many normal rows.

    Fifths, strata sizes and quota edges come from the four columns they need,
    kept for the time of the counting.  The rows themselves are then filtered
    by a lookup of their stratum.
    """
    if target_ratio <= 0:
        raise ValueError("target_ratio must be positive")
    fields = [c for c in ("annual_inc", "dti", "grade") if c in df.columns]
    narrow = df.select(quoted(key), *fields, is_normal(df).alias("__normal")).persist()
    normal = narrow.where("__normal")
    n_rows, n_normal = narrow.agg(F.count("*"), F.count_if("__normal")).first()
    target = int((n_rows - n_normal) * target_ratio)
    if n_normal == 0 or n_normal == n_rows or n_normal <= target:
        narrow.unpersist()
        return df
    edges, digits = strata_edges(normal), bucket_digits(n_rows)
    keyed = dealt(normal.withColumn("strata_key", strata_key(normal, edges)), key, seed, digits)
    share = quotas(strata_sizes(keyed), target)
    last = quota_edges(keyed, ["strata_key"], share, "__b")
    last = durable(last)            # one row per stratum; it frees the counted columns
    narrow.unpersist()
    marked = dealt(df.withColumns({"__normal": is_normal(df), "strata_key": strata_key(df, edges)}), key, seed, digits)
    kept = rows_up_to_edge(marked, ["strata_key"], last, "__b", ["__h", key], always=~F.col("__normal"))
    return kept.drop("__normal", "strata_key", "__h", "__b").select(*df.columns)


def purify_splits(split: DataFrame, target_ratio: float = 4.0, seed: int = 42) -> DataFrame:
    """Rules on every split, down-sampling on the training split only."""
    kept = purify(split)
    train = stratified_sample(kept.where(F.col("split") == "train"), target_ratio, seed)
    return train.unionByName(kept.where(F.col("split") != "train"))
