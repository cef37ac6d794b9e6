import datetime as dt
import math
from itertools import product

from loanframe.operators import labels as L
from loanframe.sources.tables import loans_from_rows

STATUSES = ["Fully Paid", " current ", "In Grace Period", "Late (16-30 days)", "Late (31-120 days)", "Charged Off", "Default",
            "Does not meet the credit policy. Status:Charged Off", None]


def expected_days(status, dpd, amount, instalment):
    s = (status or "").strip().lower()
    days = max(dpd or 0.0, 0.0)
    if days == 0 and s == "in grace period":
        days = 15
    if days == 0 and s == "late (16-30 days)":
        days = 23
    if days == 0 and s == "late (31-120 days)":
        days = min(max(math.ceil(amount / instalment) * 30, 31), 120) if instalment else 60
    if s.endswith("charged off") or s == "default":
        days = max(days, 181)
    if days == 0 and amount > 0:
        days = 15
    return int(days)


def test_overdue_days_every_branch(spark):
    cases = list(product(STATUSES, [0.0, None, 10.0, 200.0, 0.5], [0.0, 50.0, 5000.0], [None, 0.0, 100.0]))
    rows = [
        {"id": i, "loan_status": s, "hardship_dpd": d, "delinq_amnt": a, "installment": n} for i, (s, d, a, n) in enumerate(cases)
    ]
    df = loans_from_rows(spark, rows)
    got = {r.id: r.d for r in df.select("id", L.overdue_days(df).alias("d")).collect()}
    assert got == {i: expected_days(*c) for i, c in enumerate(cases)}


def test_risk_and_scene_precedence(spark):
    base = {"loan_status": "Current", "delinq_amnt": 0.0}
    rows = [
        {**base, "hardship_dpd": 0.0}, {**base, "hardship_dpd": 1.0}, {**base, "hardship_dpd": 30.0}, {**base, "hardship_dpd": 31.0},
        {**base, "hardship_dpd": 180.0}, {**base, "hardship_dpd": 181.0}, {**base, "debt_settlement_flag": "y"},
        {**base, "settlement_status": "ACTIVE"}, {**base, "recoveries": 1.0}, {**base, "hardship_flag": "Y"},
    ]
    df = L.with_labels(loans_from_rows(spark, [{"id": i, **r} for i, r in enumerate(rows)])).orderBy("id").collect()
    assert [r[L.RISK] for r in df] == [0, 1, 1, 2, 2, 3, 3, 3, 3, 0]
    assert [r[L.SCENE] for r in df] == [0, 1, 1, 2, 2, 3, 3, 3, 3, 3]
    assert df[3][f"{L.RISK}_name"] == "次级/可疑类"


def test_credit_limit_edges(spark):
    rows = [
        dict(loan_amnt=5050.0, annual_inc=1e6, dti=0.0), dict(loan_amnt=4950.0, annual_inc=1e6, dti=0.0),
        dict(loan_amnt=10.0, annual_inc=1e6, dti=0.0), dict(loan_amnt=0.0, annual_inc=1e6, dti=0.0),
        dict(loan_amnt=1e6, annual_inc=100000.0, dti=200.0), dict(loan_amnt=1e6, annual_inc=100000.0, dti=None),
        dict(loan_amnt=-5.0, annual_inc=None, dti=1.0), dict(loan_amnt=50000.0, annual_inc=1e7, dti=0.0),
    ]
    out = L.with_labels(loans_from_rows(spark, [{"id": i, "loan_status": "Current", **r} for i, r in enumerate(rows)])).orderBy("id").collect()
    assert [r[L.LIMIT] for r in out] == [5000, 5000, 500, 0, 8000, 45000, 0, 50000]
    assert [r[f"{L.LIMIT}_band"] for r in out] == ["<=5k", "<=5k", "<=5k", "<=5k", "5k-10k", "20k-50k", "<=5k", "20k-50k"]


def test_absent_columns_and_text_numbers(spark):
    df = spark.createDataFrame([(1, "12x", "7000")], "id bigint, hardship_dpd string, loan_amnt string")
    row = L.with_labels(df).first()
    assert (row[L.OVERDUE], row[L.RISK], row[L.LIMIT]) == (0, 0, 0)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan"), 9000.0, 50000.0)], "id bigint, dti double, loan_amnt double, annual_inc double")
    assert L.with_labels(df).first()[L.LIMIT] == 9000


def test_maturity(spark):
    rows = [
        dict(loan_status="Fully Paid", issue_d="Jan-2018"), dict(loan_status="Current", issue_d="Jan-2018", term=" 36 months"),
        dict(loan_status="Current", issue_d="Jan-2015", term=" 36 months"), dict(loan_status="In Grace Period", issue_d="Jan-2018"),
        dict(loan_status="Current", issue_d="n/a", term=None),
    ]
    df = loans_from_rows(spark, [{"id": i, "last_credit_pull_d": "Mar-2019", **r} for i, r in enumerate(rows)])
    assert [r.id for r in L.mature_only(df).orderBy("id").collect()] == [0, 2, 3]
    assert [r.id for r in L.mature_only(df, dt.date(2030, 1, 1)).orderBy("id").collect()] == [0, 1, 2, 3]


def test_labels_on_a_stream(spark, tmp_path):
    from loanframe.sources.tables import LOAN_SCHEMA
    from loanframe.streaming.labels import read_loan_stream, write_labelled_stream

    rows = loans_from_rows(spark, [{"id": 1, "loan_status": "Default"}, {"id": 2, "loan_status": "Current"}])
    from pyspark.sql import functions as F

    full = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LOAN_SCHEMA])
    full.write.parquet(str(tmp_path / "in"))
    write_labelled_stream(read_loan_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r.id: r[L.RISK] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: 3, 2: 0}
