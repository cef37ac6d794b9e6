"""The loan table: schema, readers, writers and the views built on order data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanframe.functions import vocab
from loanframe.functions.fields import is_missing, month, quoted
from loanframe.operators.ordering import spread_out

_NUMBERS = """loan_amnt annual_inc dti installment total_pymnt delinq_amnt hardship_dpd
recoveries delinq_2yrs inq_last_6mths acc_now_delinq revol_util revol_bal""".split()
_TEXTS = """url issue_d last_pymnt_d last_credit_pull_d term loan_status hardship_flag
debt_settlement_flag settlement_status grade purpose home_ownership verification_status
addr_state emp_title""".split()

LOAN_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("id", "member_id")]
    + [T.StructField(c, T.DoubleType()) for c in _NUMBERS]
    + [T.StructField(c, T.StringType()) for c in _TEXTS]
)


def read_loans(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Loan table from CSV (header, declared types) or Parquet."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    return spark.read.schema(schema or LOAN_SCHEMA).csv(path, header=True, enforceSchema=False)


def loans_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small table typed in by hand, such as one applicant."""
    known = {f.name: f.dataType for f in LOAN_SCHEMA}
    names = list(dict.fromkeys(k for r in rows for k in r))
    fields = []
    for name in names:
        kind = known.get(name)
        if kind is None:
            values = [r[name] for r in rows if r.get(name) is not None]
            numeric = values and all(isinstance(v, (int, float)) for v in values)
            kind = T.DoubleType() if numeric else T.StringType()
        fields.append(T.StructField(name, kind))
    tidy = [
        tuple(
            None if r.get(f.name) is None
            else float(r[f.name]) if isinstance(f.dataType, T.DoubleType)
            else int(r[f.name]) if isinstance(f.dataType, T.LongType)
            else str(r[f.name])
            for f in fields
        )
        for r in rows
    ]
    return spark.createDataFrame(tidy, T.StructType(fields))


def with_applicant_fields(df: DataFrame) -> DataFrame:
    """Adds every applicant field that is absent, as NULL."""
    absent = {c: F.lit(None).cast(t) for c, t in vocab.APPLICANT_FIELDS.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*vocab.IDENTIFIERS)


def first_rows(df: DataFrame, limit: int | None, key: str = "id") -> DataFrame:
    """The first ``limit`` rows by key; no limit, or one below 1, keeps all."""
    return df if limit is None or limit <= 0 else df.orderBy(key).limit(limit)


def align_columns(df: DataFrame, columns: list[str], fill=0.0, dtype: str = "double") -> DataFrame:
    """Exactly ``columns`` in that order: absent ones filled, others dropped."""
    return df.select(*[
        quoted(c) if c in df.columns else F.lit(fill).cast(dtype).alias(c) for c in columns
    ])


def write_by_month(df: DataFrame, path: str, fmt: str = "parquet", rows_per_task: int = 1_000_000) -> None:
    """One directory per split and issue month.

    Rows are clustered by month and a hash of the key before the write, so a
    task writes few directories and a month holding a large part of the table
    is spread over as many tasks as its rows, counted first, ask for.
    """
    dated = df.withColumn("issue_month", F.date_format(month(df, "issue_d"), "yyyy-MM"))
    counts = {r["issue_month"]: r["count"] for r in dated.groupBy("issue_month").count().collect()}     # one row per month
    parts = [F.lit(x) for m, n in counts.items() if m for x in (m, math.ceil(n / rows_per_task))]
    many = F.coalesce(F.create_map(*parts)[F.col("issue_month")], F.lit(1)) if parts else F.lit(1)
    spread = F.pmod(F.xxhash64("id"), many)
    (
        dated.repartition("split", "issue_month", spread)
        .write.mode("overwrite").partitionBy("split", "issue_month").format(fmt).save(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """A metric table (a few rows per model) as one file."""
    write_table(metrics.coalesce(1), path, fmt)


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, present values and distinct values of every column, in long form.

    Each row becomes one (column, value) pair per column and equal pairs are
    merged map-side, so a value shared by a third of all rows travels as a
    handful of partial counts.
    """
    names = df.columns
    pairs = df.select(F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(~is_missing(df, c), quoted(c).cast("string")).alias("value"),
        ) for c in names
    ])).alias("p")).select("p.*")
    per_value = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_present"),
        F.count("value").alias("n_distinct"),
    )


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, in long form."""
    stats = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"), F.count(quoted(c)).alias("n"),
            F.avg(quoted(c)).alias("mean"), F.stddev(quoted(c)).alias("std"),
            F.min(quoted(c)).alias("low"), F.max(quoted(c)).alias("high"),
        ).alias(f"s{i}") for i, c in enumerate(columns)
    ])
    rows = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))]))
    return stats.select(rows.alias("s")).select("s.*")


# ------------------------------------------------------------------ views on order data

MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"

LOANS_SQL = f"""
SELECT
  o_orderkey AS id,
  o_custkey AS member_id,
  CASE WHEN o_orderkey % 97 = 13 THEN 'n/a'
       ELSE substr({MONTHS}, (month(o_orderdate) - 1) * 3 + 1, 3)
            || '-' || CAST(year(o_orderdate) AS STRING) END AS issue_d,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
       ELSE substr({MONTHS}, (CAST(o_orderkey % 12 AS INT)) * 3 + 1, 3)
            || '-' || CAST(year(o_orderdate) + CAST(o_orderkey % 4 AS INT) AS STRING) END AS last_pymnt_d,
  substr({MONTHS}, (CAST(o_orderkey % 9 AS INT)) * 3 + 1, 3)
            || '-' || CAST(year(o_orderdate) + 1 AS STRING) AS last_credit_pull_d,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN ' 60 months'
       WHEN o_orderkey % 101 = 7 THEN NULL
       ELSE ' 36 months' END AS term,
  o_totalprice / 16 AS loan_amnt,
  CASE WHEN o_orderkey % 53 = 5 THEN NULL ELSE 24000 + abs(c_acctbal) * 12 END AS annual_inc,
  CASE WHEN o_orderkey % 61 = 3 THEN NULL ELSE CAST(o_orderkey * 7919 % 9500 AS DOUBLE) / 100 END AS dti,
  CASE WHEN o_orderkey % 89 = 1 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / 512 END AS installment,
  o_totalprice / 64 * CAST(o_orderkey % 5 AS DOUBLE) AS total_pymnt,
  substr('ABCDEFG', CAST(o_orderkey % 7 AS INT) + 1, 1) AS grade,
  CASE WHEN o_orderkey * 37 % 100 < 50 THEN 'Fully Paid'
       WHEN o_orderkey * 37 % 100 < 74 THEN 'Current'
       WHEN o_orderkey * 37 % 100 < 84 THEN 'Charged Off'
       WHEN o_orderkey * 37 % 100 < 88 THEN 'Late (31-120 days)'
       WHEN o_orderkey * 37 % 100 < 91 THEN 'Late (16-30 days)'
       WHEN o_orderkey * 37 % 100 < 94 THEN 'In Grace Period'
       WHEN o_orderkey * 37 % 100 < 95 THEN 'Default'
       WHEN o_orderkey * 37 % 100 < 96 THEN 'Does not meet the credit policy. Status:Charged Off'
       WHEN o_orderkey * 37 % 100 < 97 THEN 'Does not meet the credit policy. Status:Fully Paid'
       WHEN o_orderkey * 37 % 100 < 99 THEN '  CURRENT '
       ELSE NULL END AS loan_status,
  CASE WHEN o_orderkey % 29 = 0 THEN o_totalprice / 256 ELSE CAST(0 AS DOUBLE) END AS delinq_amnt,
  CASE WHEN o_orderkey % 71 = 2 THEN CAST(o_orderkey % 200 AS DOUBLE) ELSE NULL END AS hardship_dpd,
  CASE WHEN o_orderkey % 83 = 4 THEN o_totalprice / 128 ELSE CAST(0 AS DOUBLE) END AS recoveries,
  CASE WHEN o_orderkey % 113 = 6 THEN 'y' WHEN o_orderkey % 2 = 0 THEN 'N' ELSE NULL END AS debt_settlement_flag,
  CASE WHEN o_orderkey % 127 = 8 THEN 'ACTIVE' ELSE NULL END AS settlement_status,
  CASE WHEN o_orderkey % 71 = 2 THEN 'Y' ELSE 'N' END AS hardship_flag,
  CASE WHEN o_orderkey % 79 = 9 THEN NULL ELSE CAST(o_orderkey * 13 % 6 AS DOUBLE) END AS delinq_2yrs,
  CASE WHEN o_orderkey % 73 = 11 THEN NULL ELSE CAST(o_orderkey * 17 % 14 AS DOUBLE) END AS inq_last_6mths,
  CAST(CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS acc_now_delinq,
  CASE WHEN o_orderkey % 67 = 10 THEN NULL ELSE CAST(o_orderkey * 101 % 1100 AS DOUBLE) / 10 END AS revol_util,
  CAST(c_custkey * 173 % 20000 AS DOUBLE) AS revol_bal,
  c_mktsegment AS purpose,
  CASE WHEN c_custkey % 4 = 0 THEN 'RENT' WHEN c_custkey % 4 = 1 THEN 'MORTGAGE'
       WHEN c_custkey % 4 = 2 THEN 'OWN' ELSE NULL END AS home_ownership,
  n_name AS addr_state,
  'https://example.test/loan/' || CAST(o_orderkey AS STRING) AS url
FROM {{orders}}
JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey
"""

LOAN_SCORES_SQL = """
SELECT id, y_true,
  w0 / (w0 + w1 + w2 + w3) AS p0, w1 / (w0 + w1 + w2 + w3) AS p1,
  w2 / (w0 + w1 + w2 + w3) AS p2, w3 / (w0 + w1 + w2 + w3) AS p3
FROM (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey * 37 % 100 < 80 THEN 0 WHEN o_orderkey * 37 % 100 < 87 THEN 1
         WHEN o_orderkey * 37 % 100 < 92 THEN 2 ELSE 3 END AS y_true,
    CAST(40 + o_orderkey * 31 % 997 + CASE WHEN o_orderkey * 37 % 100 < 80 THEN 600 ELSE 0 END AS DOUBLE) AS w0,
    CAST(1 + o_orderkey * 17 % 89 AS DOUBLE) AS w1,
    CAST(1 + o_orderkey * 23 % 83 AS DOUBLE) AS w2,
    CAST(1 + o_orderkey * 29 % 101 + CASE WHEN o_orderkey * 37 % 100 >= 92 THEN 60 ELSE 0 END AS DOUBLE) AS w3
  FROM {orders}
) t
"""


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def loans(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """One loan per order, with deterministic attributes; ``spread`` deals a small file's orders out to all cores."""
    held = {n: _table(spark, folder, n) for n in ("orders", "customer", "nation")}
    if spread:
        held["orders"] = spread_out(held["orders"])
    return spark.sql(LOANS_SQL, **held)


def loan_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Deterministic class probabilities per loan, with ties."""
    return spark.sql(LOAN_SCORES_SQL, orders=_table(spark, folder, "orders"))
