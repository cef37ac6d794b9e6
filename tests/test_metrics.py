import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.operators import metrics as M

PROBS, CLASSES = ["p0", "p1", "p2"], [0, 1, 2]


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        y = rng.choice([0, 0, 0, 0, 1, 2])
        w = [rng.random() + (0.5 if c == y else 0) for c in range(3)]
        # a third of all rows share one score
        p = [0.4, 0.3, 0.3] if i % 3 == 0 else [round(x / sum(w), 2) for x in w]
        rows.append((i, y, int(np.argmax(p)), *p))
    return rows, spark.createDataFrame(rows, "id bigint, y int, pred int, p0 double, p1 double, p2 double").repartition(5).persist()


def brute(rows, c):
    pos = [r[3 + c] for r in rows if r[1] == c]
    neg = [r[3 + c] for r in rows if r[1] != c]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    cuts = {r[3 + c] for r in rows}
    ks = max(sum(a >= t for a in pos) / len(pos) - sum(b >= t for b in neg) / len(neg) for t in cuts)
    top = sorted(rows, key=lambda r: (-r[3 + c], r[0]))[: int(len(rows) * 0.2)]
    return auc, ks, sum(r[1] == c for r in top) / len(pos)


@pytest.mark.parametrize("per_range", [10**6, 60])
def test_rank_metrics_against_brute_force(scored, per_range):
    rows, df = scored
    ranks = {r.label: r for r in M.rank_metrics(df, "y", PROBS, CLASSES, per_range).collect()}
    capture = {r.label: r.capture for r in M.bad_capture(df, "y", PROBS, CLASSES, rows_per_range=per_range).collect()}
    for c in CLASSES:
        auc, ks, cap = brute(rows, c)
        assert ranks[c].auc == pytest.approx(auc) and ranks[c].ks == pytest.approx(ks) and capture[c] == pytest.approx(cap)
    want = []
    for a, b in [(0, 1), (0, 2), (1, 2)]:
        pair = [r for r in rows if r[1] in (a, b)]
        want.append((np.mean([brute(pair, c)[0] for c in (a, b)]), len(pair)))
    got = M.ovo_auc(df, "y", PROBS, CLASSES, per_range).first()
    assert got.auc_ovo_macro == pytest.approx(np.mean([w for w, _ in want]))
    assert got.auc_ovo_weighted == pytest.approx(np.average([w for w, _ in want], weights=[n for _, n in want]))


def test_report_and_diagnosis(scored):
    rows, df = scored
    out = M.summarize(df, "y", "pred", CLASSES).first()
    f1 = []
    for c in CLASSES:
        tp = sum(r[1] == c == r[2] for r in rows)
        f1.append(2 * tp / (sum(r[1] == c for r in rows) + sum(r[2] == c for r in rows)))
    assert out.macro_f1 == pytest.approx(np.mean(f1))
    assert out.accuracy == pytest.approx(np.mean([r[1] == r[2] for r in rows]))
    table = M.diagnose(df, "y", "pred", PROBS, CLASSES)
    head = M.headline(table)
    assert head["ks_mean"] == pytest.approx(np.mean([brute(rows, c)[1] for c in CLASSES]))
    assert head["capture_mean"] == pytest.approx(np.mean([brute(rows, c)[2] for c in CLASSES]))
    assert table.where("scope = 'class' and label = 1 and metric = 'auc'").first().value == pytest.approx(brute(rows, 1)[0])


def test_one_sided_class_is_undefined(spark):
    df = spark.createDataFrame([(1, 0, 0.9, 0.1), (2, 0, 0.8, 0.2)], "id bigint, y int, p0 double, p1 double")
    assert all(r.auc is None and r.ks is None for r in M.rank_metrics(df, "y", ["p0", "p1"], [0, 1]).collect())


def test_labels_seen_and_listed(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, pred int")
    row = M.summarize(df, "y", "pred", [0, 1, 2, 3]).first()
    assert row.macro_f1 == pytest.approx(0.4) and row.report_macro_f1 == pytest.approx(0.2)
    flags = M.degeneration(M.class_report(M.confusion_counts(df, "y", "pred"), classes=[0, 1])).first()
    assert flags.zero_recall_classes == "1" and flags.lazy_normal and not flags.wide_f1_gap


def test_regression(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 8.0), (20.0, 25.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert (r.mae, r.rmse, r.r2, r.mape) == pytest.approx((8 / 3, 10**0.5, 1 - 30 / 200, 0.225))
    flat = M.regression_metrics(df.withColumn("y", F.lit(3.0)), "y", "y").first()
    assert flat.r2 == 1.0
    bins = M.residual_histogram(df, "y", "p", 7).orderBy("bin").collect()
    assert [b.n for b in bins] == list(np.histogram([1, -2, 5], bins=7)[0])
