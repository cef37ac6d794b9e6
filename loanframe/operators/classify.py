"""Risk classifiers with explicit class labels: logistic regression of ``pyspark.ml``, trees over blocks of bins."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions.fields import lookup, quoted
from loanframe.operators.blocks import make_blocks
from loanframe.operators.boosting import Fit, fit_boosted
from loanframe.operators.decision import pick_class
from loanframe.operators.forest import Forest, fit_forest
from loanframe.operators.selection import VECTOR, assembled
from loanframe.operators.spread_forest import SpreadForest
from loanframe.operators.treemodel import TreeModel
from loanframe.operators.weighting import resolve, weight_column

KINDS = ("logistic_regression", "decision_tree", "random_forest", "xgboost", "lightgbm")

# ---- fixed values: parameters and grids of the model families; no depth means no limit ----
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "decision_tree": {"max_depth": None, "minInstancesPerNode": 1},
    "random_forest": {"n_estimators": 300, "max_depth": None, "minInstancesPerNode": 1},
    "xgboost": {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": 0.8},
    "lightgbm": {"n_estimators": 200, "max_depth": 7, "learning_rate": 0.05, "num_leaves": 31},
}
GRIDS = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0]},
    "decision_tree": {"max_depth": [3, 5, 7, 9, None], "minInstancesPerNode": [1, 5, 15]},
    "random_forest": {"n_estimators": [100, 200, 300], "max_depth": [5, 7, 9, None], "minInstancesPerNode": [1, 5, 10]},
    "xgboost": {
        "n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
        "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": [0.8, 1.0],
    },
    "lightgbm": {"n_estimators": [50, 100, 200, 300], "max_depth": [3, 5, 7, 9], "learning_rate": [0.01, 0.05, 0.1], "num_leaves": [15, 31, 63]},
}
BOOSTED = ("xgboost", "lightgbm")


def boosted_fit(kind: str, p: dict, loss: str, seed: int, **more) -> Fit:
    """The settings of a boosted kind; its regularisation is fixed."""
    if kind == "xgboost":
        own = {"leaves": None, "penalty": 1.0, "least_rows": 1, "least_hessian": 1.0, "start_at_mean": False,
               "row_share": p["subsamplingRate"], "feature_share": p["featureSubsetStrategy"]}
    else:
        own = {"leaves": p["num_leaves"], "penalty": 0.0, "least_rows": 20, "least_hessian": 1e-3}
    return Fit(loss, rounds=p["n_estimators"], depth=p["max_depth"], rate=p["learning_rate"], seed=seed, **own, **more)


class RiskClassifier(Estimator):
    """One interface over the model families."""

    def __init__(
        self, kind: str, features: list[str], label: str = "preloan_risk_label", weight_mode: str = "none",
        weights: dict[int, float] | None = None, seed: int = 42, of: dict[int, int | None] | None = None, **params,
    ):
        super().__init__()
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind}, expected one of {KINDS}")
        self.kind, self.features, self.label, self.of = kind, list(features), label, of
        self.weight_mode, self.weights, self.seed = weight_mode, weights, seed
        self.params_used = {**DEFAULTS[kind], **params}

    def own_class(self, c: int) -> int | None:
        """The class to be learned for a class of the label; None where such rows are left out."""
        return c if self.of is None else self.of.get(c)

    def _fit(self, df: DataFrame) -> "RiskModel":
        return fit_together(df, [self])[0]


def position_of(classes: list[int], label: str) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in classes]), quoted(label).cast("int")) - 1


def fit_together(
    df: DataFrame, learners: list[RiskClassifier], fold: Column | None = None, spans: list[tuple[int | None, int | None]] | None = None,
) -> list["RiskModel"]:
    """Fits learners of the same features and label on the same rows; boosted ones grow in the same passes.

    With ``fold`` and ``spans`` a learner sees only rows whose fold is at least the first and below the second number.
    Every model knows the classes of all rows; a class that a learner has not seen gets no share.
    """
    first, spans = learners[0], spans or [(None, None)] * len(learners)
    if any((x.features, x.label) != (first.features, first.label) for x in learners):
        raise ValueError("learners that are fitted together need the same features and label")
    number = (F.lit(0) if fold is None else fold).cast("int")
    seen = [(r["f"], r["c"], r["count"]) for r in df.groupBy(number.alias("f"), quoted(first.label).cast("int").alias("c")).count().collect()]
    base = sorted({c for _, c, _ in seen})
    models: list[RiskModel | None] = []
    plans = []
    for x, (low, high) in zip(learners, spans):
        classes = sorted({k for c in base if (k := x.own_class(c)) is not None})
        counts = {k: 0 for k in classes}
        for f, c, n in seen:
            if x.own_class(c) is not None and (low is None or f >= low) and (high is None or f < high):
                counts[x.own_class(c)] += n
        weights = resolve({k: n for k, n in counts.items() if n}, x.weight_mode, x.weights)
        plans.append((classes, counts, weights))
        models.append(RiskModel(x.kind, x.features, classes, [], x.params_used, None) if len(classes) == 1 else None)
    open_ = [i for i, m in enumerate(models) if m is None]
    boosted = [i for i in open_ if learners[i].kind in BOOSTED]
    forests = [i for i in open_ if learners[i].kind in ("decision_tree", "random_forest")]
    if boosted or forests:
        blocks = make_blocks(df, first.features, position_of(base, first.label), fold)
        fits = []
        for i in boosted:
            x, (classes, _, weights) = learners[i], plans[i]
            own = [x.own_class(c) for c in base]
            plain = weights is None and None not in own
            fits.append(boosted_fit(
                x.kind, x.params_used, "logistic" if len(classes) == 2 else "softmax", x.seed, n_classes=len(classes), fold_from=spans[i][0], fold_below=spans[i][1],
                class_weights=None if plain else [0.0 if k is None else (weights or {}).get(k, 1.0) for k in own],
                relabel=None if own == classes else [0 if k is None else classes.index(k) for k in own]))
        found = dict(zip(boosted, fit_boosted(blocks, first.features, fits))) if boosted else {}
        for i in forests:
            x, (classes, _, weights) = learners[i], plans[i]
            p, single, own = x.params_used, x.kind == "decision_tree", [x.own_class(c) for c in base]
            found[i] = fit_forest(blocks, first.features, Forest(
                len(classes), 1 if single else p["n_estimators"], p["max_depth"], p["minInstancesPerNode"], len(first.features) if single else None, not single,
                [0.0 if k is None else (weights or {}).get(k, 1.0) for k in own], *spans[i], [0 if k is None else classes.index(k) for k in own], x.seed))
        blocks.release()
        for i, trees in found.items():
            models[i] = RiskModel(learners[i].kind, first.features, plans[i][0], [trees], learners[i].params_used, plans[i][2])
    for i in open_:
        if models[i] is None:
            x, (low, high) = learners[i], spans[i]
            rows = df if high is None else df.where(fold < high)
            models[i] = _fit_linear(rows if low is None else rows.where(fold >= low), x, *plans[i])
    return models


def _fit_linear(df: DataFrame, learner: RiskClassifier, classes: list[int], counts: dict[int, int], weights: dict | None) -> "RiskModel":
    p, total = learner.params_used, sum(n * (weights or {}).get(c, 1.0) for c, n in counts.items())
    if learner.of is not None:
        df = df.withColumn(learner.label, lookup(quoted(learner.label).cast("int"), {c: k for c, k in learner.of.items() if k is not None})).where(quoted(learner.label).isNotNull())
    rows = assembled(df, learner.features).select(VECTOR, position_of(classes, learner.label).cast("double").alias("__y"), weight_column(learner.label, weights).alias("__w"))
    stage = LogisticRegression(
        featuresCol=VECTOR, labelCol="__y", weightCol="__w", family="multinomial", maxIter=p["max_iter"], elasticNetParam=0.0,
        regParam=1.0 / (p["C"] * total), standardization=False,
    ).fit(rows)
    return RiskModel(learner.kind, learner.features, classes, [stage], p, weights)


class RiskModel(Model):
    """Adds ``probabilities`` (an array in the order of ``classes``) and ``prediction``."""

    def __init__(self, kind: str, features: list[str], classes: list[int], stages: list, params: dict, weights: dict | None):
        super().__init__()
        self.kind, self.features, self.classes = kind, features, classes
        self.stages, self.params_used, self.weights = stages, params, weights

    def _probabilities(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        if not self.stages:
            return df.withColumn("__p", F.array(F.lit(1.0)))
        if isinstance(self.stages[0], TreeModel):
            return df.withColumn("__p", self.stages[0].probability_column(df, rounds))
        if isinstance(self.stages[0], SpreadForest):
            return self.stages[0].with_probabilities(df)
        stage = self.stages[0].copy()
        made = [f"__{name}" for name in ("raw", "probability", "prediction")]
        for setter, name in zip(("setRawPredictionCol", "setProbabilityCol", "setPredictionCol"), made):
            getattr(stage, setter)(name)
        staged = stage.transform(assembled(df, self.features))
        shares = vector_to_array("__probability")
        # the last classes may have no training rows
        missing = len(self.classes) - stage.numClasses
        return staged.withColumn("__p", F.concat(shares, F.array_repeat(F.lit(0.0), missing)) if missing else shares).drop(VECTOR, *made)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.after(df, None)

    def after(self, df: DataFrame, rounds: int | None) -> DataFrame:
        """What the first ``rounds`` rounds of a boosted model say; all of them, if not given."""
        scored = self._probabilities(df, rounds)
        picks = [F.col("__p")[i] for i in range(len(self.classes))]
        pick = pick_class(picks, self.classes)
        return scored.withColumn("prediction", pick.cast("int")).withColumnRenamed("__p", "probabilities")

    def importance(self, spark: SparkSession) -> DataFrame:
        """Share of the trees' gain per feature; equal ones without trees."""
        trees = [s for s in self.stages if isinstance(s, (TreeModel, SpreadForest))]
        values = trees[0].importance().tolist() if trees else [1.0] * len(self.features)
        return spark.createDataFrame(list(zip(self.features, values)), "feature string, importance double")

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {
            "kind": self.kind, "features": self.features, "classes": self.classes, "params": self.params_used,
            "weights": {str(c): w for c, w in (self.weights or {}).items()}, "n_stages": len(self.stages), "spread": any(isinstance(s, SpreadForest) for s in self.stages),
        }
        row = [(json.dumps(meta, ensure_ascii=False),)]
        spark.createDataFrame(row, "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        for i, stage in enumerate(self.stages):
            if isinstance(stage, (TreeModel, SpreadForest)):
                stage.save(f"{path}/stage_{i}")
            else:
                stage.write().overwrite().save(f"{path}/stage_{i}")

    @classmethod
    def load(cls, path: str) -> "RiskModel":
        meta = json.loads(SparkSession.getActiveSession().read.parquet(f"{path}/meta").first()["meta"])
        stored = LogisticRegressionModel if meta["kind"] == "logistic_regression" else SpreadForest if meta.get("spread") else TreeModel
        stages = [stored.load(f"{path}/stage_{i}") for i in range(meta["n_stages"])]
        weights = {int(c): w for c, w in meta["weights"].items()} or None
        return cls(meta["kind"], meta["features"], meta["classes"], stages, meta["params"], weights)


def probability_columns(df: DataFrame, classes: list[int], wanted: list[int], source: str = "probabilities") -> DataFrame:
    """Spreads the array into ``p<class>`` columns, zero for unknown classes."""
    return df.withColumns({
        f"p{c}": F.col(source)[classes.index(c)] if c in classes else F.lit(0.0) for c in wanted
    })
