from pyspark.sql import functions as F

from loanframe.operators import decision as D
from loanframe.operators import strategy as T
from loanframe.sources.tables import loans_from_rows


def test_rules_at_their_borders(spark):
    cases = [
        (dict(hardship_dpd=30.0), 0), (dict(hardship_dpd=30.5), 0), (dict(hardship_dpd=31.0), 2), (dict(hardship_dpd=90.0), 2),
        (dict(hardship_dpd=90.5), 0), (dict(hardship_dpd=91.0), 2), (dict(hardship_dpd=180.0), 2), (dict(hardship_dpd=181.0), 3),
        (dict(dti=60.0, delinq_2yrs=1.0), 0), (dict(dti=60.1, delinq_2yrs=1.0), 2), (dict(dti=60.1, delinq_2yrs=0.0), 0),
        (dict(dti=50.0, inq_last_6mths=11.0), 0), (dict(dti=50.1, inq_last_6mths=11.0), 1), (dict(dti=50.1, inq_last_6mths=10.0), 0),
        (dict(loan_status="Default"), 3), (dict(loan_status="Late (31-120 days)"), 2), (dict(loan_status="Late (16-30 days)"), 0),
        (dict(delinq_amnt=500.0, installment=100.0), 2), (dict(delinq_amnt=900.0, installment=100.0), 3), (dict(), 0),
    ]
    df = loans_from_rows(spark, [{"id": i, "loan_status": None, "hardship_dpd": None, **c} for i, (c, _) in enumerate(cases)])
    out = D.with_rules(df.withColumn("pred", F.lit(0)), "pred").orderBy("id").collect()
    assert [r.final_pred for r in out] == [w for _, w in cases]


def test_thresholds_and_ties(spark):
    df = spark.createDataFrame([(0.9, 0.05, 0.05), (0.5, 0.25, 0.25), (0.1, 0.2, 0.7)], "p0 double, p1 double, p2 double")
    probs = [F.col(c) for c in df.columns]
    assert [r[0] for r in df.select(D.threshold_class(probs, 0.9)).collect()] == [0, 1, 2]
    assert [r[0] for r in df.select(D.loss_class(probs, 0.25, [0, 1, 2], 2)).collect()] == [0, 2, 2]
    assert [r[0] for r in df.select(D.threshold_class(probs, 0.6, [3, 0, 7])).collect()] == [3, 3, 7]


def test_curve_equals_replay_per_threshold(spark):
    import random

    rng = random.Random(1)
    rows = []
    for _ in range(400):
        w = [rng.random() for _ in range(4)]
        rows.append((rng.randrange(4), *[round(x / sum(w), 2) for x in w]))
    df = spark.createDataFrame(rows, "y int, p0 double, p1 double, p2 double, p3 double")
    counts = {(round(r.threshold, 2), r.y, r.pred): r.n for r in D.threshold_confusion(df, "y", ["p0", "p1", "p2", "p3"]).collect()}
    want = {}
    for t in D.THRESHOLD_GRID:
        for y, *p in rows:
            pred = 0 if p[0] >= t else 1 + p[1:].index(max(p[1:]))
            want[(t, y, pred)] = want.get((t, y, pred), 0) + 1
    assert counts == want


def test_limit_caps(spark):
    rows = [(-5.0, 0, 12000.0, 0.0), (1e9, 0, 12000.0, 0.0), (1e9, 1, 12000.0, 50.0), (1e9, 2, 12000.0, 150.0), (10.0, 3, 12000.0, 0.0), (10.0, 7, 12000.0, 0.0), (10.005, 0, None, 0.0)]
    df = spark.createDataFrame(rows, "raw double, risk int, annual_inc double, dti double")
    assert [r[0] for r in df.select(D.capped_limit(df, "raw", "risk")).collect()] == [0.0, 12000.0, 3000.0, 0.0, 0.0, 0.0, 0.0]


def test_escalation_never_lowers(spark):
    df = loans_from_rows(spark, [{"id": 1, "hardship_dpd": 200.0}, {"id": 2, "hardship_dpd": 40.0}, {"id": 3, "hardship_dpd": 40.0}, {"id": 4, "hardship_dpd": 0.0}])
    df = df.withColumn("pick", F.when(F.col("id") == 3, 2).otherwise(0))
    assert [r[0] for r in df.orderBy("id").select(D.escalate_three(df, "pick")).collect()] == [2, 1, 2, 0]


def test_review_replies_and_scenarios(spark):
    rows = [
        ("o", '{"revised_content": "r"}'), ("o", '```json\n{"revised_content": " r "}\n```'), ("o", 'text {"revised_content": "r"} text'),
        ("o", "no json"), ("o", '{"revised_content": "  "}'), ("o", None), ("o", '{"broken'), ("o", '{"other": 1}'),
    ]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(T.reviewed_text(F.col("a"), F.col("b"))).collect()] == ["r", "r", "r", "o", "o", "o", "o", "o"]
    users = spark.createDataFrame([(i,) for i in range(5)], "preloan_risk_label int")
    assert [r[0] for r in users.select(T.scenario(users)).collect()] == ["正常维护", "风险预警", "逾期催收", "协商还款", "风险预警"]


def test_limits_of_ten_million_are_written_out(spark):
    from loanframe.operators.strategy import strategy_text

    rows = spark.createDataFrame([(1, 500.0), (2, 9999999.5), (3, 12345678.0), (4, 10000000.25), (5, None)], "id int, x double")
    texts = {r.id: r.t for r in rows.select("id", strategy_text(F.lit("正常维护"), F.col("x")).alias("t")).collect()}
    for i, text in {1: "500.0", 2: "9999999.5", 3: "12345678.0", 4: "10000000.25", 5: "待定"}.items():
        assert f"额度 {text} 元" in texts[i]
