import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.operators import ordering as O
from loanframe.operators import splits as S

RNG = random.Random(3)


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id bigint, v {kind}").repartition(5)


@pytest.mark.parametrize("name", ["uniform", "hot", "tails", "longs", "negative"])
def test_order_statistics_match_a_sort(spark, name):
    values = {
        "uniform": [RNG.random() for _ in range(3000)],
        "hot": [7.0] * 1500 + [RNG.gauss(7, 1) for _ in range(1500)],
        "tails": [RNG.random() * 10 ** RNG.randint(-200, 200) for _ in range(3000)],
        "longs": [2**62 - RNG.randint(0, 5000) for _ in range(3000)],
        "negative": [RNG.uniform(-5, 5) for _ in range(3000)] + [None] * 50,
    }[name]
    df = frame(spark, values, "bigint" if name == "longs" else "double")
    ordered = sorted(v for v in values if v is not None)
    ranks = [0, 1, 1499, 2100, len(ordered) - 1]
    got = O.order_statistics(df, "v", [(None, r) for r in ranks], leaf_values=16)
    assert [got[(None, r)] for r in ranks] == [ordered[r] for r in ranks]
    with pytest.raises(ValueError):
        O.order_statistics(df, "v", [(None, len(ordered))])


def test_order_statistics_with_infinities(spark):
    big = 1.7976931348623157e308
    values = [RNG.gauss(0, 1) for _ in range(300)] + [math.inf] * 3 + [-math.inf] * 2 + [big, -big]
    ordered = sorted(values)
    df = frame(spark, values)
    ranks = [0, 1, 2, 3, 150, len(values) - 5, len(values) - 4, len(values) - 3, len(values) - 1]
    got = O.order_statistics(df, "v", [(None, r) for r in ranks], leaf_values=4)
    assert [got[(None, r)] for r in ranks] == [ordered[r] for r in ranks]
    only = O.order_statistics(frame(spark, [big] * 9 + [math.inf] * 9), "v", [(None, 8), (None, 9)], leaf_values=4)
    assert [only[(None, r)] for r in (8, 9)] == [big, math.inf]


def test_exact_quantiles_both_ways(spark):
    values = [RNG.gauss(0, 1) for _ in range(2001)] + [None] * 10
    df = frame(spark, values).withColumn("none", F.lit(None).cast("double"))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = np.quantile([v for v in values if v is not None], shares)
    for limit in (10, 10**6):
        got = O.exact_quantiles(df, ["v", "none"], shares, max_values=limit)
        assert got["none"] is None
        np.testing.assert_allclose(got["v"], want, rtol=1e-12)


def test_quantiles_of_many_columns_by_brackets(spark, monkeypatch):
    """Ties, few and many values, infinities; brackets that hold a rank, miss it or hold too much give the same."""
    n = 30_000
    columns = {
        "a": [RNG.gauss(0, 1) for _ in range(n)], "b": [float(RNG.choice([0, 0, 0, 1, 7])) for _ in range(n)], "c": [None if RNG.random() < 0.5 else RNG.random() for _ in range(n)],
        "d": [RNG.choice([-math.inf, math.inf, RNG.random()]) for _ in range(n)], "e": [float(i) for i in range(n)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(4)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for sketch, most in ((10_000, 10**6), (200, 10**6), (200, 50)):
        monkeypatch.setattr(O, "SKETCH", sketch)
        got = O.exact_quantiles(df, list(columns), shares, max_values=most)
        for c, values in columns.items():
            own = np.sort([v for v in values if v is not None])
            for s, v in zip(shares, got[c]):
                p = s * (len(own) - 1)
                a, b = own[math.floor(p)], own[math.ceil(p)]
                assert v == (a if a == b else (math.ceil(p) - p) * a + (p - math.floor(p)) * b) or abs(v - (a + (b - a) * (p - math.floor(p)))) < 1e-12, (c, s)


def test_running_sums_by_ranges(spark):
    rows = [(k, v, RNG.randint(0, 9)) for k in "ab" for v in RNG.sample(range(10**6), 500)]
    df = spark.createDataFrame(rows, "k string, v int, n int").repartition(6)
    bounds = O.range_bounds(df, "v", 1000, 100)
    assert len(bounds) > 5
    for down in (False, True):
        plain, ranged = [
            {(r.k, r.v): r.c for r in O.running_sums(df, ["k"], "v", {"c": "n"}, b, down).collect()} for b in ([], bounds)
        ]
        assert plain == ranged and len(plain) == 1000


def test_seeded_sample_is_exact_and_stable(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"))
    quotas = spark.createDataFrame([(0, 777), (1, 9999)], "g int, quota bigint")
    first = O.take_by_quota(df, "g", quotas, "id", 42)
    again = O.take_by_quota(df.repartition(7), "g", quotas, "id", 42)
    sizes = {r.g: r["count"] for r in first.groupBy("g").count().collect()}
    assert sizes == {0: 777, 1: 1667}
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    assert O.random_sample(df, 123, 1).count() == 123 and O.random_sample(df, 0, 1).count() == 5000


def months(n):
    return [f"{'JanFebMarAprMayJunJulAugSepOctNovDec'[(i % 12) * 3:(i % 12) * 3 + 3]}-{2010 + i // 12}" for i in range(n)]


@pytest.mark.parametrize("size,span", [(7, 3), (10, 1), (100, 9), (1000, 2)])
def test_temporal_split_is_exact_and_chronological(spark, size, span):
    names = months(span)
    rows = [(i, names[RNG.randrange(span)]) for i in range(size)] + [(size + 1, "n/a"), (size + 2, None)]
    df = spark.createDataFrame(rows, "id bigint, issue_d string").repartition(3)
    out = S.temporal_split(df)
    S.check_split_sizes(out)
    order = sorted(rows[:size], key=lambda r: (names.index(r[1]), r[0]))
    train, val, _ = S.split_sizes(size)
    want = {r[0]: "train" if i < train else "val" if i < train + val else "test" for i, r in enumerate(order)}
    assert {r.id: r.split for r in out.collect()} == want
    if size >= 100:
        folds = {r.id: r.fold for r in S.with_time_folds(df).collect()}
        block = size // 6
        assert [folds[r[0]] for r in order] == [min(4, (i - (size - 5 * block)) // block) if i >= size - 5 * block else -1 for i in range(size)]
