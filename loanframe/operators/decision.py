"""From class probabilities and raw limits to decisions.

The business rules read repayment facts (status, days past due) that exist
only after a loan was paid out.  Metrics are therefore reported with and
without them.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import (
    clamp, first_max_position, half_even, lookup, num, quoted, status, within,
)
from loanframe.operators.metrics import class_report, report_summary

# ---- fixed values: grids and caps ----
THRESHOLD_GRID = [x / 100.0 for x in range(50, 100)]
LOSS_GRID = [0.50, 0.45, 0.40, 0.35, 0.30, 0.25, 0.20, 0.15]
GRID_THRESHOLDS = [0.65, 0.70, 0.75, 0.80, 0.85, None]      # None searches the best one
CAP_MONTHS = {0: 12.0, 1: 6.0, 2: 3.0, 3: 0.0}


def pick_class(probs: list[Column], classes: list[int]) -> Column:
    """Class of the first largest probability."""
    return lookup(first_max_position(probs), dict(enumerate(classes))) if len(probs) > 1 else F.lit(classes[0])


def pick_risk_class(probs: list[Column], classes: list[int]) -> Column:
    risk = [(p, c) for p, c in zip(probs, classes) if c != 0]
    return pick_class([p for p, _ in risk], [c for _, c in risk])


def threshold_class(probs: list[Column], threshold, classes: list[int] | None = None) -> Column:
    """Normal only with enough confidence, else the likeliest risk class."""
    classes = classes or list(range(len(probs)))
    if len(classes) < 2:
        raise ValueError("a threshold needs at least two class probabilities")
    normal = probs[classes.index(0)]
    return F.when(normal >= threshold, 0).otherwise(pick_risk_class(probs, classes))


def loss_class(probs: list[Column], threshold: float | None, classes: list[int], loss: int) -> Column:
    """Loss as soon as its probability reaches the threshold, else the likeliest class."""
    likeliest = pick_class(probs, classes)
    if threshold is None:
        return likeliest
    return F.when(probs[classes.index(loss)] >= threshold, loss).otherwise(likeliest)


# ------------------------------------------------------------------- threshold search


def thresholds_reached(value: str, grid: list[float], df: DataFrame) -> DataFrame:
    """Adds ``reached``: how many grid thresholds the value is at or above."""
    cut = Bucketizer(splits=[-math.inf, *sorted(grid), math.inf], inputCol=value, outputCol="reached", handleInvalid="keep")
    return cut.transform(df).withColumn("reached", F.col("reached").cast("int"))


def threshold_confusion(
    df: DataFrame, y: str, probs: list[str], grid: list[float] | None = None, classes: list[int] | None = None,
) -> DataFrame:
    """Confusion counts at every threshold from one pass over the rows.

    Rows are counted by label, likeliest risk class and number of thresholds
    reached; the counts are then replayed per threshold.
    """
    grid = sorted(grid or THRESHOLD_GRID)
    classes = classes or list(range(len(probs)))
    columns = [quoted(p) for p in probs]
    base = df.select(
        quoted(y).cast("int").alias("y"),
        columns[classes.index(0)].alias("p_normal"),
        pick_risk_class(columns, classes).cast("int").alias("risk_pick"),
    )
    counts = thresholds_reached("p_normal", grid, base).groupBy("y", "risk_pick", "reached").agg(F.count("*").alias("n"))
    steps = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("needed"), F.lit(t).alias("threshold")) for i, t in enumerate(grid)
    ]))
    replayed = counts.select("y", "risk_pick", "reached", "n", steps.alias("s")).select(
        "s.threshold", "y", "n",
        F.when(F.col("reached") >= F.col("s.needed"), 0).otherwise(F.col("risk_pick")).alias("pred"),
    )
    return replayed.groupBy("threshold", "y", "pred").agg(F.sum("n").alias("n"))


def threshold_curve(
    df: DataFrame, y: str, probs: list[str], grid: list[float] | None = None, classes: list[int] | None = None,
) -> DataFrame:
    confusion = threshold_confusion(df, y, probs, grid, classes)
    summary = report_summary(class_report(confusion, ["threshold"]), ["threshold"])
    return summary.select(
        "threshold", "normal_precision", "risk_recall_mean", "macro_f1", "weighted_f1", "predicted_normal_ratio"
    )


def best_threshold(curve: DataFrame, min_normal_precision: float = 0.8) -> DataFrame:
    """The best row of a threshold curve.

    Above the precision floor the highest mean risk recall wins, then macro F1,
    then the smaller threshold.  When no threshold is above the floor, the
    highest precision wins, then risk recall.
    """
    ok = F.col("normal_precision") >= min_normal_precision
    first = F.when(ok, F.round("risk_recall_mean", 9)).otherwise(F.round("normal_precision", 9))
    second = F.when(ok, F.round("macro_f1", 9)).otherwise(F.round("risk_recall_mean", 9))
    return (
        curve.withColumns({"above_floor": ok, "__a": first, "__b": second})
        .orderBy(F.desc("above_floor"), F.desc("__a"), F.desc("__b"), F.asc("threshold"))
        .limit(1)
        .drop("__a", "__b")
    )


def find_threshold(
    df: DataFrame, y: str, probs: list[str], min_normal_precision: float = 0.8, classes: list[int] | None = None,
) -> dict:
    """The best threshold with its metrics, as plain values (one row)."""
    return best_threshold(threshold_curve(df, y, probs, None, classes), min_normal_precision).first().asDict()


def loss_threshold_scan(
    df: DataFrame, y: str, probs: list[str], classes: list[int], loss: int, grid: list[float] | None = None,
) -> DataFrame:
    """F1 and recall per class at every loss threshold and for plain argmax."""
    grid = sorted(grid or LOSS_GRID)
    columns = [quoted(p) for p in probs]
    base = df.select(
        quoted(y).cast("int").alias("y"),
        columns[classes.index(loss)].alias("p_loss"),
        pick_class(columns, classes).cast("int").alias("pick"),
    )
    counts = thresholds_reached("p_loss", grid, base).groupBy("y", "pick", "reached").agg(F.count("*").alias("n"))
    settings = [(f"{t:.2f}", i + 1) for i, t in enumerate(grid)] + [("argmax", len(grid) + 2)]
    steps = F.explode(F.array(*[
        F.struct(F.lit(name).alias("setting"), F.lit(need).alias("needed")) for name, need in settings
    ]))
    replayed = counts.select("y", "pick", "reached", "n", steps.alias("s")).select(
        "s.setting", "y", "n",
        F.when(F.col("reached") >= F.col("s.needed"), loss).otherwise(F.col("pick")).alias("pred"),
    )
    confusion = replayed.groupBy("setting", "y", "pred").agg(F.sum("n").alias("n"))
    report = class_report(confusion, ["setting"])
    recalls = report.groupBy("setting").agg(*[
        F.coalesce(F.max(F.when(F.col("label") == c, F.col("recall"))), F.lit(0.0)).alias(f"recall_{c}")
        for c in classes
    ])
    return report_summary(report, ["setting"]).select("setting", "weighted_f1", "macro_f1").join(recalls, "setting")


# --------------------------------------------------------------------- business rules


def historic_overdue(df: DataFrame) -> Column:
    """Largest overdue-days signal of a loan: reported, implied or inferred."""
    def reported(name):
        value = num(df, name)
        return F.when(F.abs(value) < math.inf, value)

    state = status(df)
    overdue_amount = clamp(num(df, "delinq_amnt", 0.0), 0.0)
    instalment = num(df, "installment")
    inferred = F.when((instalment > 0) & (instalment < math.inf), F.ceil(F.try_divide(overdue_amount, instalment)) * 30.0)
    implied = (
        F.when(state.isin(vocab.LOSS_STATUSES), 181.0)
        .when(state == vocab.LATE_LONG, F.coalesce(F.when(inferred > 0, clamp(inferred, 31.0, 120.0)), F.lit(60.0)))
        .when(state == vocab.LATE_SHORT, 23.0)
        .when(state == vocab.GRACE, 15.0)
    )
    names = ["historical_max_overdue_days", "max_overdue_days", "estimated_overdue_days", "hardship_dpd"]
    signals = [reported(n) for n in names if n in df.columns]
    return F.coalesce(F.greatest(*signals, implied, F.when(inferred > 0, inferred)), F.lit(0.0))


# ---- fixed values: class demanded by each rule ----
RULE_CLASSES = {
    "overdue_over_180": 3, "overdue_91_to_180": 2, "overdue_31_to_90": 2,
    "burden_and_delinquency": 2, "burden_and_inquiries": 1,
}


def fired_rule(df: DataFrame, days: Column | None = None) -> Column:
    """Name of the first rule that applies, NULL when none does."""
    days = historic_overdue(df) if days is None else days
    burden = num(df, "dti", 0.0)
    return (
        F.when(days > 180, "overdue_over_180")
        .when(days.between(91, 180), "overdue_91_to_180")
        .when(days.between(31, 90), "overdue_31_to_90")
        .when((burden > 60) & (num(df, "delinq_2yrs", 0.0) > 0), "burden_and_delinquency")
        .when((burden > 50) & (num(df, "inq_last_6mths", 0.0) > 10), "burden_and_inquiries")
    )


def rule_class(rule: Column) -> Column:
    """Risk class a rule demands, NULL without a rule."""
    out = F
    for name, label in RULE_CLASSES.items():
        out = out.when(rule == name, label)
    return out


def with_rules(df: DataFrame, pred: str, out: str = "final_pred") -> DataFrame:
    """Adds the days, the rule that fired and the prediction after rules."""
    staged = df.withColumn("historic_overdue_days", historic_overdue(df))
    staged = staged.withColumn("fired_rule", fired_rule(staged, F.col("historic_overdue_days")))
    return staged.withColumn(out, F.coalesce(rule_class(F.col("fired_rule")), quoted(pred)).cast("int"))


def escalate_three(df: DataFrame, pred: str) -> Column:
    """Three-class prediction that rules may raise and never lower."""
    demanded = F.coalesce(rule_class(fired_rule(df)), F.lit(0))
    return F.greatest(quoted(pred), lookup(demanded, vocab.TO_THREE_CLASS)).cast("int")


# ----------------------------------------------------------------------- limits, names


def disposable_income(df: DataFrame) -> Column:
    """Monthly income left after debt payments."""
    absent = {"annual_inc", "dti"} - set(df.columns)
    if absent:
        raise ValueError(f"limit caps need the columns {sorted(absent)}")
    burden = clamp(num(df, "dti", 0.0) / 100.0, 0.0, 1.0)
    return clamp(num(df, "annual_inc", 0.0) * (1.0 - burden) / 12.0, 0.0)


def limit_cap(df: DataFrame, risk: str) -> Column:
    """Highest limit allowed; an unknown risk class allows none."""
    return disposable_income(df) * lookup(quoted(risk), CAP_MONTHS, 0.0)


def capped_limit(df: DataFrame, raw: str, risk: str) -> Column:
    capped = F.least(clamp(quoted(raw), 0.0), limit_cap(df, risk))
    return half_even(F.when(quoted(raw).isNotNull(), capped), 2)


def cap_violations(df: DataFrame, limit: str, risk: str) -> DataFrame:
    """Rows whose limit lies above their cap."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(quoted(limit) > limit_cap(df, risk) + 1e-6).alias("n_violations"),
    )


def risk_name(label: Column, n_classes: int = 4) -> Column:
    names = {**vocab.RISK_NAMES, **vocab.RISK_NAMES_3} if n_classes <= 3 else vocab.RISK_NAMES
    return lookup(label, names, vocab.UNKNOWN_NAME)


def scene_of_risk(label: Column, n_classes: int = 4) -> Column:
    mapping = {0: 0, 1: 1, 2: 3} if n_classes <= 3 else {c: c for c in range(4)}
    return lookup(label, mapping, vocab.DEFAULT_SCENE)


def cap_class_of_risk(label: Column, n_classes: int = 4) -> Column:
    if n_classes <= 3:
        return lookup(label, {0: 0, 1: 1, 2: 2}, 2)
    return clamp(label.cast("int"), 0, 3)


def compose_two_stage(p_normal: Column, p_risk: Column, within_risk: dict[int, Column]) -> list[Column]:
    """Four class probabilities from stage 1 and the classes given risk."""
    parts = [p_normal] + [p_risk * within_risk[c] if c in within_risk else F.lit(0.0) for c in (1, 2, 3)]
    total = parts[0] + parts[1] + parts[2] + parts[3]
    return [p / F.greatest(total, F.lit(1e-12)) for p in parts]
