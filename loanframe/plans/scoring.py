"""Batch scoring: one chain of projections over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions import vocab
from loanframe.functions.fields import clamp, half_even, lookup, quoted
from loanframe.operators.classify import probability_columns
from loanframe.operators.decision import (
    cap_class_of_risk, capped_limit, pick_class, risk_name, scene_of_risk, threshold_class, with_rules,
)
from loanframe.operators.strategy import with_strategy
from loanframe.operators.two_stage import TwoStageModel
from loanframe.sources.tables import with_applicant_fields

RECORD = [
    "raw_model_risk_label", "raw_model_risk_label_name", "threshold_adjusted_risk_label",
    "threshold_adjusted_risk_label_name", "rule_adjusted_risk_label", "rule_adjusted_risk_label_name",
    "risk_label", "risk_label_name", "risk_probabilities", "normal_class_threshold",
    "raw_credit_limit", "approved_credit_limit", "strategy_scenario", "strategy_content", "strategy_source",
]


def probability_map(probs: list[Column], classes: list[int]) -> Column:
    """Display name -> probability with four digits."""
    n = len(classes)
    return F.map_from_arrays(
        F.array(*[risk_name(F.lit(c), n) for c in classes]), F.array(*[half_even(p, 4) for p in probs])
    )


def decide(scored: DataFrame, threshold: float, classes: list[int], raw_pred: Column | None = None) -> DataFrame:
    """Labels, limits and texts from ``p<class>`` columns and ``raw_limit``."""
    n = len(classes)
    probs = [quoted(f"p{c}") for c in classes]
    base = scored.drop(*RECORD, "preloan_risk_label", "postloan_scene_label", "postloan_scene_label_name")
    staged = base.withColumns({
        "raw_model_risk_label": (pick_class(probs, classes) if raw_pred is None else raw_pred).cast("int"),
        "threshold_adjusted_risk_label": threshold_class(probs, threshold, classes).cast("int"),
    })
    staged = with_rules(staged, "threshold_adjusted_risk_label", "risk_label")
    staged = staged.withColumn("__cap_class", cap_class_of_risk(F.col("risk_label"), n))
    staged = staged.withColumns({
        "rule_adjusted_risk_label": F.col("risk_label"),
        "raw_model_risk_label_name": risk_name(F.col("raw_model_risk_label"), n),
        "threshold_adjusted_risk_label_name": risk_name(F.col("threshold_adjusted_risk_label"), n),
        "rule_adjusted_risk_label_name": risk_name(F.col("risk_label"), n),
        "risk_label_name": risk_name(F.col("risk_label"), n),
        "risk_probabilities": probability_map(probs, classes),
        "normal_class_threshold": F.lit(float(threshold)),
        "raw_credit_limit": half_even(clamp(F.col("raw_limit"), 0.0), 2),
        "approved_credit_limit": capped_limit(staged, "raw_limit", "__cap_class"),
        "postloan_scene_label": scene_of_risk(F.col("risk_label"), n),
    })
    staged = staged.withColumn("postloan_scene_label_name", lookup(F.col("postloan_scene_label"), vocab.SCENE_NAMES))
    return with_strategy(staged, "approved_credit_limit").drop("__cap_class")


def score_batch(df: DataFrame, chain, threshold: float | None = None) -> DataFrame:
    """Input columns followed by the record of every loan or applicant."""
    rows = with_applicant_fields(df)
    features = chain.selector.transform(chain.preprocessor.transform(rows))
    risk = chain.risk.transform(features)
    if isinstance(chain.risk, TwoStageModel):
        scored, classes = risk, chain.risk.classes
    else:
        classes = chain.risk.classes
        scored = probability_columns(risk, classes, classes)
    decided = decide(chain.limit.transform(scored), chain.threshold if threshold is None else threshold, classes, F.col("prediction"))
    kept = [c for c in df.columns if c not in RECORD]
    return decided.select(*[quoted(c) if c in decided.columns else F.lit(None).alias(c) for c in kept], *RECORD)
