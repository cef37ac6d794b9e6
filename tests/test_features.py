import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.operators import features as X
from loanframe.operators import selection as S


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(60):
        rows.append((
            i, float(i % 7) if i % 5 else None, 3.0, None, "ab"[i % 2] if i % 9 else None, f"state{i % 20}", i % 3, "leak", 1.0 * i,
        ))
    return spark.createDataFrame(
        rows, "id bigint, dti double, revol_bal double, open_acc double, purpose string, addr_state string, preloan_risk_label int, loan_status string, total_pymnt double"
    )


def test_policy():
    assert X.is_allowed("dti") and not X.is_allowed("dti", ["dti"])
    assert not any(map(X.is_allowed, ["id", "grade", "loan_status", "total_rec_int", "hardship_anything", "preloan_risk_label"]))
    assert X.feature_group("inq_last_6mths") == "credit_risk_features" and X.feature_group("zip_code") == "user_base_features"


def test_fit_and_transform(spark, table):
    model = X.LoanPreprocessor().fit(table)
    s = model.state
    assert s["features"] == ["dti", "revol_bal", "open_acc", "purpose", "addr_state"]
    assert s["fills"]["open_acc"] == 0.0 and s["bounds"]["revol_bal"] == (3.0, 3.0)
    known = [float(i % 7) for i in range(60) if i % 5]
    assert s["fills"]["dti"] == np.median(known)
    assert s["low"] == ["purpose"] and s["high"] == ["addr_state"] and s["categories"]["purpose"] == ["a", "b", "__unknown__"]
    out = model.transform(table)
    row = out.agg(*[F.avg(F.col(c)).alias(c) for c in ("dti__scaled", "revol_bal__scaled")], F.stddev_pop("dti__scaled").alias("sd")).first()
    assert row.dti__scaled == pytest.approx(0, abs=1e-9) and row.sd == pytest.approx(1) and row.revol_bal__scaled == 0
    enc = {r.category: r.encoded for r in model.encodings.collect()}
    overall = np.mean([i % 3 for i in range(60)])
    mine = [i % 3 for i in range(60) if i % 20 == 4]
    assert enc["state4"] == pytest.approx(overall * (20 / 23) + np.mean(mine) * (3 / 23))


def test_unseen_and_absent(spark, table):
    model = X.LoanPreprocessor().fit(table)
    new = spark.createDataFrame([(1, "zzz", "nowhere")], "id bigint, purpose string, addr_state string")
    row = model.transform(new).first()
    assert row["purpose=__unknown__"] == 1.0 and row["purpose=a"] == 0.0
    assert row["addr_state__target_encoded"] == pytest.approx(1.0)
    assert set(model.outputs) <= set(model.transform(new).columns)


def test_transform_ignores_the_rows_it_sees(spark, table, tmp_path):
    model = X.LoanPreprocessor().fit(table)
    model.save(str(tmp_path / "m"))
    again = X.LoanPreprocessorModel.load(str(tmp_path / "m"))
    one = table.where("id = 3")
    pick = lambda m, t: [m.transform(t).where("id = 3").first()[c] for c in model.outputs]
    assert pick(model, one) == pick(model, table) == pick(again, table)


def test_target_gaps_are_an_error(table):
    with pytest.raises(ValueError):
        X.LoanPreprocessor().fit(table.withColumn("preloan_risk_label", F.when(F.col("id") > 5, F.col("preloan_risk_label"))))


def test_selection_order_matters(spark):
    rows = [(float(i), 2.0 * i + (i % 2), float(i % 5), 1.0, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, y int")
    names = ["a", "b", "c", "flat"]
    assert S.varying(df, names) == ["a", "b", "c"]
    assert [r.feature for r in S.correlated_columns(S.correlations(df, ["a", "b", "c"])).collect()] == ["b"]
    model = S.FeatureSelector(names, "y", top_k=2, n_trees=5).fit(df)
    assert sorted(model.outputs) == ["a", "c"]
    pca = S.FeatureSelector(names, "y", top_k=2, n_trees=5, pca_share=0.95).fit(df)
    out = pca.transform(df)
    assert pca.outputs[0] == "pca_component_001" and out.agg(F.avg("pca_component_001")).first()[0] == pytest.approx(0, abs=1e-8)


def test_fits_of_the_catalog_read_their_table_once(spark, table, monkeypatch):
    from loanframe.plans import catalog

    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    split = table.repartition(2).withColumn("dti", seen("dti")).withColumn("split", F.lit("train"))
    want = catalog._bounds(table.withColumn("split", F.lit("train")))
    got = catalog._bounds(split)
    assert (got[1], got[2]) == (want[1], want[2]) and read.value == 60
    monkeypatch.setattr(catalog, "_split", lambda spark, folder: split)
    assert catalog.imputer_fit(spark, "").count() == 5 and read.value == 120


def test_a_boundary_month_is_read_once(spark):
    from loanframe.operators.splits import cuts_at

    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(v):
        read.add(1)
        return v

    rows = spark.createDataFrame([(i, f"{('Jan', 'Feb', 'Mar')[i % 3]}-2020") for i in range(300)], "id bigint, issue_d string").repartition(2)
    counts = [{"issue_month": m, "n": 100} for (m,) in rows.selectExpr("to_date(issue_d, 'MMM-yyyy') m").distinct().orderBy("m").collect()]
    cuts = cuts_at(rows.withColumn("id", seen("id")), [30, 130], counts)
    assert [c.key for c in cuts] == [90, 91] and read.value <= 300


def test_rows_of_a_small_file_reach_all_cores(spark):
    """The labelled rows and the preprocessed table once stayed in the one or two tasks that read the file."""
    from loanframe.plans.catalog import _split
    from loanframe.plans.training import preprocessed

    split = _split(spark, "/root/testdata/sf0.001")
    assert split.rdd.getNumPartitions() >= 8
    sizes = split.rdd.glom().map(len).collect()
    assert sum(size > 0 for size in sizes) >= 8
    model, table = preprocessed(split, "preloan_risk_label")
    assert table.rdd.getNumPartitions() >= 8 and table.count() == split.count() and set(model.outputs) <= set(table.columns)
    table.unpersist()
