"""Leak-free feature engineering: fitted on training rows, applied to any."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanframe.functions import vocab
from loanframe.functions.fields import clamp, num, opt_col, quoted
from loanframe.operators.ordering import SMALL_TABLE, dealt_out, durable, exact_quantiles
from loanframe.sources.tables import column_profile, describe_columns

MISSING = "__missing__"
UNKNOWN = "__unknown__"
ENCODING_SCHEMA = "feature string, category string, encoded double"


# ------------------------------------------------------------------------------ policy


def is_allowed(name: str, excluded: list[str] = ()) -> bool:
    """Known at application time, and neither a label nor an outcome field."""
    barred = {*vocab.LABEL_COLUMNS, *vocab.OUTCOME_FIELDS, *excluded}
    leaking = any(name.startswith(p) for p in vocab.OUTCOME_PREFIXES)
    return name in vocab.APPLICATION_FIELDS and name not in barred and not leaking


def allowed_columns(df: DataFrame, excluded: list[str] = ()) -> list[str]:
    return [c for c in df.columns if is_allowed(c, excluded)]


def feature_group(name: str) -> str:
    lowered = name.lower()
    for group, fragments in vocab.GROUP_FRAGMENTS.items():
        if any(f in lowered for f in fragments):
            return group
    return vocab.OTHER_GROUP


def split_types(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(continuous, categorical) by declared type."""
    texty = (T.StringType, T.BooleanType)
    categorical = [c for c in columns if isinstance(df.schema[c].dataType, texty)]
    return [c for c in columns if c not in categorical], categorical


def group_profile(df: DataFrame) -> DataFrame:
    """Per allowed feature its business group, gaps, distinct values and moments."""
    columns = allowed_columns(df)
    continuous, _ = split_types(df, columns)
    picked = df.select(*[quoted(c) for c in columns])
    names = F.create_map(*[F.lit(x) for c in columns for x in (c, feature_group(c))])
    moments = describe_columns(picked, continuous).select("column_name", "mean", "std")
    return column_profile(picked).join(moments, "column_name", "left").select(
        F.col("column_name").alias("feature"),
        names[F.col("column_name")].alias("feature_group"),
        (1 - F.try_divide("n_present", "n_rows")).alias("null_share"),
        "n_distinct", "mean", "std",
    )


# ------------------------------------------------------------------------ fitted stages


def is_low_cardinality(df: DataFrame, columns: list[str], limit: int) -> dict[str, dict]:
    """Exact facts about categorical columns with at most ``limit`` values.

    A sketch screens the columns first; sets and modes are collected only
    where the sketch proves them small.  Columns missing in the result have
    more values.
    """
    if not columns:
        return {}
    sketch = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    small = [c for i, c in enumerate(columns) if sketch[f"d{i}"] <= 2 * limit + 8]
    if not small:
        return {}
    facts = df.agg(*[
        F.struct(
            F.array_sort(F.collect_set(quoted(c).cast("string"))).alias("values"),
            F.mode(quoted(c).cast("string"), True).alias("mode"),
            F.count_if(quoted(c).isNull()).alias("gaps"),
        ).alias(f"s{i}") for i, c in enumerate(small)
    ]).first()
    out = {}
    for i, c in enumerate(small):
        fact = facts[f"s{i}"]
        if len(fact["values"]) <= limit:
            out[c] = {"values": list(fact["values"]), "mode": fact["mode"], "gaps": fact["gaps"]}
    return out


def frequent_value(df: DataFrame, column: str) -> str | None:
    """Most frequent value, the smallest among equals, by a distributed count."""
    counts = df.where(quoted(column).isNotNull()).groupBy(quoted(column).cast("string").alias("v")).agg(F.count("*").alias("n"))
    row = counts.orderBy(F.desc("n"), F.asc("v")).first()
    return row["v"] if row else None


def fit_fills(df: DataFrame, continuous: list[str], categorical: list[str], low: dict) -> dict:
    """Median of numbers (0 without values), mode of texts."""
    numbers = df.select(*[num(df, c).alias(c) for c in continuous])
    medians = exact_quantiles(numbers, continuous, [0.5])
    fills: dict = {c: (q[0] if q else 0.0) for c, q in medians.items()}
    for c in categorical:
        value = low[c]["mode"] if c in low else frequent_value(df, c)
        fills[c] = value if value is not None else MISSING
    return fills


def imputed(df: DataFrame, fills: dict, continuous: list[str], categorical: list[str]) -> dict[str, Column]:
    out = {c: num(df, c, fills[c]) for c in continuous}
    out.update({c: F.coalesce(opt_col(df, c).cast("string"), F.lit(fills[c])) for c in categorical})
    return out


def fit_bounds(filled: DataFrame, continuous: list[str]) -> dict[str, tuple[float, float]]:
    """1.5 interquartile ranges around the quartiles; the full range when flat."""
    if not continuous:
        return {}
    quartiles = exact_quantiles(filled, continuous, [0.25, 0.75])
    ends = filled.agg(*[f(quoted(c)).alias(f"{t}{i}") for i, c in enumerate(continuous) for t, f in (("a", F.min), ("b", F.max))]).first()
    bounds = {}
    for i, c in enumerate(continuous):
        if quartiles[c] is None:
            bounds[c] = (0.0, 0.0)
            continue
        q1, q3 = quartiles[c]
        spread = 1.5 * (q3 - q1)
        bounds[c] = (q1 - spread, q3 + spread) if spread != 0 else (ends[f"a{i}"], ends[f"b{i}"])
    return bounds


def encode_targets(filled: DataFrame, columns: list[str], target: str, smoothing: float) -> DataFrame:
    """Mean target per category, pulled towards the overall mean when rare.

    Categories of all columns are counted together with map-side combine, so
    a category holding most rows arrives as one partial sum per task.
    """
    pairs = filled.select(
        quoted(target).cast("double").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).alias("category")) for c in columns])).alias("p"),
    )
    overall = filled.agg(F.avg(quoted(target).cast("double")).alias("overall"))
    stats = pairs.groupBy("p.feature", "p.category").agg(F.avg("y").alias("mean"), F.count("y").alias("n"))
    weight = F.col("n") / (F.col("n") + F.lit(float(smoothing)))
    return stats.crossJoin(F.broadcast(overall)).select(
        "feature", "category", (F.col("overall") * (1 - weight) + F.col("mean") * weight).alias("encoded")
    )


class LoanPreprocessor(Estimator):
    """Impute, clip, then scale, one-hot encode and target encode."""

    def __init__(self, target: str = "preloan_risk_label", max_one_hot: int = 10, smoothing: float = 20.0, excluded: list[str] = ()):
        super().__init__()
        self.target, self.max_one_hot = target, max_one_hot
        self.smoothing, self.excluded = smoothing, list(excluded)

    def _fit(self, df: DataFrame) -> "LoanPreprocessorModel":
        columns = [c for c in allowed_columns(df, self.excluded) if c != self.target]
        if self.target not in df.columns:
            raise ValueError(f"training rows need the target column {self.target}")
        # several passes follow, each over the result of the one before
        df = dealt_out(df.select(*[quoted(c) for c in columns], quoted(self.target)).persist())
        continuous, categorical = split_types(df, columns)
        low = is_low_cardinality(df, categorical, self.max_one_hot)
        high = [c for c in categorical if c not in low]
        fills = fit_fills(df, continuous, categorical, low)
        filled = df.select(
            quoted(self.target), *[v.alias(c) for c, v in imputed(df, fills, continuous, categorical).items()]
        )
        bounds = fit_bounds(filled, continuous)
        clipped = [clamp(quoted(c), *bounds[c]) for c in continuous]
        moments = filled.agg(
            F.count_if(quoted(self.target).isNull()).alias("gaps"), F.avg(quoted(self.target)).alias("y"),
            *[F.avg(v).alias(f"m{i}") for i, v in enumerate(clipped)],
            *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(clipped)],
        ).first()
        if high and moments["gaps"]:
            raise ValueError(f"{moments['gaps']} training rows have no {self.target}, which target encoding needs")
        categories = {}
        for c in low:
            seen = {*low[c]["values"], *([fills[c]] if low[c]["gaps"] else [])}
            categories[c] = sorted(seen) + ([] if UNKNOWN in seen else [UNKNOWN])
        state = {
            "target": self.target, "features": columns, "continuous": continuous,
            "low": [c for c in categorical if c in low], "high": high, "fills": fills,
            "bounds": bounds, "categories": categories, "target_mean": moments["y"] or 0.0,
            "mean": {c: moments[f"m{i}"] or 0.0 for i, c in enumerate(continuous)},
            "std": {c: moments[f"s{i}"] or 1.0 for i, c in enumerate(continuous)},
            "encoded_rows": {},
        }
        encodings = None
        if high:
            encodings = durable(encode_targets(filled, high, self.target, self.smoothing))
            sizes = encodings.groupBy("feature").count().collect()
            state["encoded_rows"] = {r["feature"]: r["count"] for r in sizes}
        df.unpersist()
        return LoanPreprocessorModel(state, encodings)


class LoanPreprocessorModel(Model):
    """Adds the feature columns of a fitted preprocessor to a loan table.

    Statistics per column are literals in the plan; the target encoding is a
    table, because a category column may have millions of values.
    """

    def __init__(self, state: dict, encodings: DataFrame | None):
        super().__init__()
        self.state, self.encodings = state, encodings

    @property
    def outputs(self) -> list[str]:
        s = self.state
        scaled = [f"{c}__scaled" for c in s["continuous"]]
        one_hot = [f"{c}={v}" for c in s["low"] for v in s["categories"][c]]
        return scaled + one_hot + [f"{c}__target_encoded" for c in s["high"]]

    @property
    def nominal_outputs(self) -> list[str]:
        s = self.state
        return [f"{c}={v}" for c in s["low"] for v in s["categories"][c]]

    def imputed(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        s = self.state
        values = imputed(df, s["fills"], s["continuous"], s["low"] + s["high"])
        return df.select(*[quoted(k) for k in keep], *[values[c].alias(c) for c in s["features"]])

    def clipped(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        filled = self.imputed(df, keep)
        return filled.select(*[quoted(k) for k in keep], *[
            (clamp(quoted(c), *self.state["bounds"][c]) if c in self.state["bounds"] else quoted(c)).alias(c)
            for c in self.state["features"]
        ])

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        values = imputed(df, s["fills"], s["continuous"], s["low"] + s["high"])
        new = {}
        for c in s["continuous"]:
            new[f"{c}__scaled"] = (clamp(values[c], *s["bounds"][c]) - s["mean"][c]) / s["std"][c]
        for c in s["low"]:
            known = s["categories"][c]
            listed = [v for v in known if v != UNKNOWN]
            for v in known:
                hit = values[c] == v if v != UNKNOWN else ~values[c].isin(listed)
                new[f"{c}={v}"] = F.when(hit, 1.0).otherwise(0.0)
        helpers = {f"__key_{i}": values[c] for i, c in enumerate(s["high"])}
        out = df.withColumns({**new, **helpers})
        for i, c in enumerate(s["high"]):
            table = self.encodings.where(F.col("feature") == c).select(
                F.col("category").alias(f"__key_{i}"), F.col("encoded").alias(f"__enc_{i}")
            )
            if s["encoded_rows"].get(c, SMALL_TABLE + 1) <= SMALL_TABLE:
                table = F.broadcast(table)
            out = out.join(table, f"__key_{i}", "left")
            out = out.withColumn(f"{c}__target_encoded", F.coalesce(f"__enc_{i}", F.lit(s["target_mean"])))
            out = out.drop(f"__key_{i}", f"__enc_{i}")
        return out

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        text = spark.createDataFrame([(json.dumps(self.state, ensure_ascii=False),)], "state string")
        text.coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
        table = self.encodings if self.encodings is not None else spark.createDataFrame([], ENCODING_SCHEMA)
        table.write.mode("overwrite").parquet(f"{path}/encodings")

    @classmethod
    def load(cls, path: str) -> "LoanPreprocessorModel":
        spark = SparkSession.getActiveSession()
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        return cls(state, spark.read.parquet(f"{path}/encodings"))
