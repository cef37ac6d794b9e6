"""Feature selection on the training rows: variance, correlation, importance, PCA."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted
from loanframe.operators.blocks import make_blocks
from loanframe.operators.forest import Forest, forest_gains
from loanframe.operators.weighting import balanced_weights, weight_column

VECTOR = "__features"


def assembled(df: DataFrame, columns: list[str], out: str = VECTOR) -> DataFrame:
    """Adds the feature vector; names with odd characters are fine."""
    plain = [f"__f{i}" for i in range(len(columns))]
    staged = df.withColumns({p: (quoted(c) if c in df.columns else F.lit(0.0)).cast("double") for p, c in zip(plain, columns)})
    return VectorAssembler(inputCols=plain, outputCol=out).transform(staged).drop(*plain)


def variances(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population variance of every column, one aggregate."""
    sums = df.agg(*[F.var_pop(quoted(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance")) for i, c in enumerate(columns)]))
    return sums.select(rows.alias("r")).select("r.*")


def varying(df: DataFrame, columns: list[str], threshold: float = 0.01) -> list[str]:
    kept = {r["feature"] for r in variances(df, columns).where(F.col("variance") > threshold).collect()}
    return [c for c in columns if c in kept]


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, earlier column first.

    One pass over the rows; the result is columns x columns.
    """
    spark = df.sparkSession
    schema = "left string, right string, left_no int, right_no int, correlation double"
    if len(columns) < 2:
        return spark.createDataFrame([], schema)
    matrix = Correlation.corr(assembled(df, columns).select(VECTOR), VECTOR).first()[0].toArray()
    rows = [
        (columns[i], columns[j], i, j, float(matrix[i][j]))
        for j in range(len(columns)) for i in range(j)
    ]
    return spark.createDataFrame(rows, schema)


def correlated_columns(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Columns strongly correlated with any earlier one, dropped ones included."""
    strong = pairs.where(F.abs("correlation") > threshold)
    return strong.groupBy(F.col("right").alias("feature")).agg(
        F.count("*").alias("n_partners"), F.round(F.max(F.abs("correlation")), 6).alias("top_correlation")
    )


def forest_importance(
    df: DataFrame, columns: list[str], label: str, n_trees: int = 200, max_depth: int | None = None, seed: int = 42,
) -> list[tuple[str, float]]:
    """Features from most to least important for a class-balanced forest."""
    weights = balanced_weights(df, label)
    classes = sorted(weights)
    order = F.array_position(F.array(*[F.lit(c) for c in classes]), quoted(label).cast("int")) - 1
    blocks = make_blocks(df, columns, order)
    gains = forest_gains(blocks, len(columns), Forest(len(classes), n_trees, max_depth, class_weights=[weights[c] for c in classes], seed=seed))
    blocks.release()
    return sorted(zip(columns, gains.tolist()), key=lambda p: (-p[1], p[0]))


class FeatureSelector(Estimator):
    """Keeps varying, uncorrelated and important features, optionally as components."""

    def __init__(
        self, inputs: list[str], label: str, min_variance: float = 0.01, max_correlation: float = 0.8,
        top_k: int = 50, n_trees: int = 200, max_depth: int | None = None, pca_share: float | None = None, seed: int = 42,
    ):
        super().__init__()
        self.inputs, self.label = inputs, label
        self.min_variance, self.max_correlation = min_variance, max_correlation
        self.top_k, self.n_trees, self.max_depth = top_k, n_trees, max_depth
        self.pca_share, self.seed = pca_share, seed

    def _fit(self, df: DataFrame) -> "FeatureSelectorModel":
        kept = varying(df, self.inputs, self.min_variance)
        dropped = {r["feature"] for r in correlated_columns(correlations(df, kept), self.max_correlation).collect()}
        kept = [c for c in kept if c not in dropped]
        if not kept:
            raise ValueError("no features remain after variance and correlation filtering")
        ranked = forest_importance(df, kept, self.label, self.n_trees, self.max_depth, self.seed)
        chosen = ranked[: self.top_k]
        scaler = pca = None
        n_components = 0
        if self.pca_share is not None:
            names = [c for c, _ in chosen]
            rows = assembled(df, names).select(VECTOR)
            scaler = StandardScaler(withMean=True, withStd=False, inputCol=VECTOR, outputCol="__centred").fit(rows)
            pca = PCA(k=len(names), inputCol="__centred", outputCol="__components").fit(scaler.transform(rows))
            total = 0.0
            for share in pca.explainedVariance.toArray():
                total += share
                n_components += 1
                if total >= self.pca_share:
                    break
        return FeatureSelectorModel(chosen, scaler, pca, n_components)


class FeatureSelectorModel(Model):
    """Reduces a feature table to the chosen columns, or adds components."""

    def __init__(self, chosen: list[tuple[str, float]], scaler=None, pca=None, n_components: int = 0):
        super().__init__()
        self.chosen, self.scaler, self.pca, self.n_components = chosen, scaler, pca, n_components

    @property
    def outputs(self) -> list[str]:
        if self.pca is None:
            return [c for c, _ in self.chosen]
        return [f"pca_component_{i + 1:03d}" for i in range(self.n_components)]

    def importance(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.chosen, "feature string, importance double")

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [c for c, _ in self.chosen]
        absent = {c: F.lit(0.0) for c in names if c not in df.columns}
        out = df.withColumns(absent) if absent else df
        if self.pca is None:
            return out
        staged = self.pca.transform(self.scaler.transform(assembled(out, names)))
        parts = staged.withColumn("__a", vector_to_array("__components"))
        parts = parts.withColumns({n: F.col("__a")[i] for i, n in enumerate(self.outputs)})
        return parts.drop("__a", "__components", "__centred", VECTOR)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = json.dumps({"chosen": self.chosen, "n_components": self.n_components, "pca": self.pca is not None}, ensure_ascii=False)
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        if self.pca is not None:
            self.scaler.write().overwrite().save(f"{path}/scaler")
            self.pca.write().overwrite().save(f"{path}/pca")

    @classmethod
    def load(cls, path: str) -> "FeatureSelectorModel":
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        chosen = [(c, s) for c, s in meta["chosen"]]
        if not meta["pca"]:
            return cls(chosen)
        return cls(chosen, StandardScalerModel.load(f"{path}/scaler"), PCAModel.load(f"{path}/pca"), meta["n_components"])
