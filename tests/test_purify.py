import pytest
from pyspark.sql import functions as F

from loanframe.operators import purify as P
from loanframe.operators.labels import with_labels
from loanframe.sources.tables import loans_from_rows

GOOD = dict(loan_status="Current", issue_d="Jan-2015", last_pymnt_d="Jan-2016", annual_inc=50000.0, dti=10.0, delinq_2yrs=0.0,
            inq_last_6mths=1.0, revol_util=50.0, total_pymnt=1000.0, installment=100.0, acc_now_delinq=0.0)


def test_one_row_per_rule(spark):
    changes = [
        {}, {"dti": None}, {"last_pymnt_d": "May-2015"}, {"revol_util": 0.5}, {"revol_util": None}, {"dti": 85.0},
        {"dti": 85.0, "delinq_2yrs": 1.0}, {"last_pymnt_d": "Feb-2015", "loan_status": "Charged Off"}, {"revol_util": 0.0, "loan_status": "Default"},
        {"last_pymnt_d": None, "last_credit_pull_d": "Dec-2015"}, {"issue_d": "n/a"},
    ]
    df = with_labels(loans_from_rows(spark, [{"id": i, **GOOD, **c} for i, c in enumerate(changes)]))
    assert [r.id for r in P.purify(df).orderBy("id").collect()] == [0, 4, 6, 7, 8, 9]
    hits = {r.rule: r.n_rows for r in P.rule_counts(df).collect()}
    assert hits == {"missing_core": 1, "too_fresh": 2, "too_few_payments": 0, "unused_line": 1, "odd_clean_debtor": 1, "any_rule": 5}


def test_absent_core_column_removes_all(spark):
    df = loans_from_rows(spark, [{"id": 1, **{k: v for k, v in GOOD.items() if k != "dti"}}])
    with pytest.warns(UserWarning):
        assert P.purify(df).count() == 0


@pytest.mark.parametrize("sizes,target,want", [
    ({"a": 5, "b": 3, "c": 2}, 7, {"a": 4, "b": 2, "c": 1}), ({"a": 2, "b": 2}, 3, {"a": 2, "b": 1}), ({"a": 4}, 0, {"a": 0}),
])
def test_quotas(spark, sizes, target, want):
    df = spark.createDataFrame(list(sizes.items()), "strata_key string, n bigint")
    got = {r.strata_key: r.quota for r in P.quotas(df, target).collect()}
    assert got == want and sum(got.values()) == target


def test_fifths_merge_equal_edges(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 1.0, 1.0, 5.0, 6.0, None]], "annual_inc double").withColumn("dti", F.lit(2.0))
    keys = {(r.annual_inc, r.strata_key) for r in P.with_strata(df).collect()}
    tail = "|dti_unknown"
    assert keys == {(v, f"Unknown|inc_{c}{tail}") for v, c in ((1.0, "0"), (5.0, "0"), (6.0, "1"), (None, "unknown"))}


def test_down_sampling_keeps_risk_and_ratio(spark):
    rows = [{"id": i, **GOOD, "annual_inc": 1000.0 * (i % 17), "grade": "ABC"[0 if i < 250 else i % 3]} for i in range(400)]
    rows += [{"id": 1000 + i, **GOOD, "loan_status": "Charged Off"} for i in range(40)]
    df = with_labels(loans_from_rows(spark, rows))
    out = P.stratified_sample(df, 4.0)
    assert out.count() == 40 + 160 and out.columns == df.columns
    assert out.where("id >= 1000").count() == 40
    ids = {r.id for r in out.select("id").collect()}
    assert ids == {r.id for r in P.stratified_sample(df.repartition(9), 4.0).select("id").collect()}
    assert P.stratified_sample(df, 20.0).count() == 440
    with pytest.raises(ValueError):
        P.stratified_sample(df, 0)
