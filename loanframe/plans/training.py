"""Training, storing and loading of the whole model chain."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted
from loanframe.operators.classify import RiskClassifier, RiskModel, probability_columns
from loanframe.operators.features import LoanPreprocessor, LoanPreprocessorModel
from loanframe.operators.labels import LIMIT, RISK
from loanframe.operators.metrics import diagnose, headline, regression_metrics
from loanframe.operators.ordering import dealt_out
from loanframe.operators.regress import LimitModel, LimitRegressor
from loanframe.operators.resample import smote_enn
from loanframe.operators.selection import FeatureSelector, FeatureSelectorModel
from loanframe.operators.two_stage import TwoStageClassifier, TwoStageModel

POLICY_VERSION = "application-fields-4-class-1"


@dataclass
class FeatureTable:
    """One feature table for all splits: kept in memory or on disk while in use, or read from where it was written."""

    table: DataFrame
    preprocessor: LoanPreprocessorModel
    selector: FeatureSelectorModel
    label: str

    def save(self, path: str, manifest: dict) -> None:
        """Rows, fitted steps, and the manifest last: a folder without one is unfinished."""
        self.table.write.mode("overwrite").parquet(f"{path}/table")
        self.preprocessor.save(f"{path}/preprocessor")
        self.selector.save(f"{path}/selector")
        row = [(json.dumps({**manifest, "label": self.label, "columns": self.table.columns}, ensure_ascii=False),)]
        self.table.sparkSession.createDataFrame(row, "manifest string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @classmethod
    def load(cls, spark: SparkSession, path: str, manifest: dict) -> "FeatureTable | None":
        """The table that was written for this manifest, or None: there is none, or inputs or settings have changed."""
        found = _text_at(spark, f"{path}/manifest")
        if found is None:
            return None
        held = json.loads(found)
        if any(held.get(k) != v for k, v in manifest.items()):
            return None
        table = spark.read.parquet(f"{path}/table").select(*[quoted(c) for c in held["columns"]])
        return cls(table, LoanPreprocessorModel.load(f"{path}/preprocessor"), FeatureSelectorModel.load(f"{path}/selector"), held["label"])

    @property
    def features(self) -> list[str]:
        return self.selector.outputs

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)

    def release(self) -> None:
        self.table.unpersist()


def preprocessed(split: DataFrame, target: str) -> tuple[LoanPreprocessorModel, DataFrame]:
    """Preprocessing fitted on the training rows, and its kept result for all rows, which are labelled once for both."""
    rows = dealt_out(split.persist())
    preprocessor = LoanPreprocessor(target).fit(rows.where(F.col("split") == "train"))
    table = dealt_out(preprocessor.transform(rows).persist())
    table.count()
    rows.unpersist()
    return preprocessor, table


def prepare_features(
    split: DataFrame, label: str = RISK, top_k: int = 50, n_trees: int = 200, max_depth: int | None = None,
    target: str = RISK, select_on: DataFrame | None = None,
) -> FeatureTable:
    """Fits preprocessing and selection on the training rows, applies both to all.

    The input columns stay next to the features, so rules and limit caps need
    no join later.
    """
    preprocessor, table = preprocessed(split, target)
    chosen_on = table.where(F.col("split") == "train") if select_on is None else select_on
    selector = FeatureSelector(preprocessor.outputs, label, top_k=top_k, n_trees=n_trees, max_depth=max_depth).fit(chosen_on)
    return FeatureTable(table, preprocessor, selector, label)


def manifest_of(split: DataFrame, **settings) -> dict:
    """What a feature table depends on: the rows, whatever their order, and the settings."""
    whole = F.xxhash64(*[quoted(c) for c in split.columns])
    n, digest = split.agg(F.count(F.lit(1)), F.sum(whole.cast("decimal(38,0)"))).first()
    return {"version": POLICY_VERSION, "settings": settings, "rows": n, "digest": str(digest), "inputs": split.columns}


def stored_features(split: DataFrame, path: str, **settings) -> FeatureTable:
    """The feature table written below ``path`` for these rows and settings; fitted and written where there is none.

    Settings are those of ``prepare_features``.  Tables of other rows or settings stay where they are.
    """
    split = split.persist()                                         # read by the manifest, by preprocessing and for the table
    spark, manifest = split.sparkSession, manifest_of(split, **settings)
    own = f"{path.rstrip('/')}/features-{hashlib.sha256(json.dumps(manifest, sort_keys=True).encode()).hexdigest()[:24]}"
    found = FeatureTable.load(spark, own, manifest)
    if found is None:
        fitted = prepare_features(split, **settings)
        fitted.save(own, manifest)
        fitted.release()
        found = FeatureTable.load(spark, own, manifest)
    split.unpersist()
    return found


def _text_at(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.text(path).first()["value"]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


@dataclass
class TrainedChain:
    """Everything batch scoring needs."""

    preprocessor: LoanPreprocessorModel
    selector: FeatureSelectorModel
    risk: RiskModel | TwoStageModel
    limit: LimitModel
    threshold: float
    metrics: dict

    def importance(self, spark: SparkSession) -> DataFrame:
        return self.risk.importance(spark).orderBy(F.desc("importance"), F.asc("feature"))

    def save(self, path: str) -> None:
        self.preprocessor.save(f"{path}/preprocessor")
        self.selector.save(f"{path}/selector")
        self.risk.save(f"{path}/risk")
        self.limit.save(f"{path}/limit")
        spark = SparkSession.getActiveSession()
        policy = {
            "version": POLICY_VERSION, "two_stage": isinstance(self.risk, TwoStageModel),
            "threshold": self.threshold, "metrics": self.metrics,
        }
        spark.createDataFrame([(json.dumps(policy),)], "policy string").coalesce(1).write.mode("overwrite").text(f"{path}/policy")

    @classmethod
    def load(cls, path: str) -> "TrainedChain | None":
        """The stored chain, or None when there is none of the current policy."""
        found = _text_at(SparkSession.getActiveSession(), f"{path}/policy")
        if found is None:
            return None
        policy = json.loads(found)
        if policy["version"] != POLICY_VERSION:
            return None
        risk = (TwoStageModel if policy["two_stage"] else RiskModel).load(f"{path}/risk")
        return cls(
            LoanPreprocessorModel.load(f"{path}/preprocessor"), FeatureSelectorModel.load(f"{path}/selector"),
            risk, LimitModel.load(f"{path}/limit"), policy["threshold"], policy["metrics"],
        )


def train_chain(
    split: DataFrame, two_stage: bool = False, resample: bool = False, top_k: int | None = None,
    n_trees: int | None = None, threshold: float = 0.9, tree_depth: int | None = None, **params,
) -> TrainedChain:
    """Preprocess, optionally resample, select, classify, regress and evaluate.

    The limit regressor always learns from the original rows.
    """
    top_k = top_k or (80 if two_stage else 30)
    n_trees = n_trees or (100 if two_stage else 50)
    preprocessor, table = preprocessed(split, RISK)
    train, valid, test = [table.where(F.col("split") == s) for s in ("train", "val", "test")]
    learn = smote_enn(train, RISK, preprocessor.outputs, preprocessor.nominal_outputs) if resample else train
    selector = FeatureSelector(preprocessor.outputs, RISK, top_k=top_k, n_trees=n_trees, max_depth=tree_depth).fit(learn)
    features = selector.outputs
    if two_stage:
        risk = TwoStageClassifier(features, RISK, valid=valid, **params).fit(learn)
        scored, threshold = risk.transform(test), risk.threshold
        classes = risk.classes
    else:
        risk = RiskClassifier("lightgbm", features, RISK, **params).fit(learn)
        classes = sorted({*risk.classes, 0, 1, 2, 3})
        scored = probability_columns(risk.transform(test), risk.classes, classes)
    limit = LimitRegressor("lightgbm", features, LIMIT, **{k: v for k, v in params.items() if k in ("n_estimators", "max_depth")}).fit(train)
    values = headline(diagnose(scored, RISK, "prediction", [f"p{c}" for c in classes], classes))
    values.update(regression_metrics(limit.transform(test), LIMIT, "raw_limit").first().asDict())
    table.unpersist()
    return TrainedChain(preprocessor, selector, risk, limit, threshold, values)


def trained_or_loaded(split: DataFrame, path: str, **options) -> TrainedChain:
    """The stored chain when it follows the current policy, else a new one."""
    found = TrainedChain.load(path)
    if found is None:
        found = train_chain(split, **options)
        found.save(path)
    return found
