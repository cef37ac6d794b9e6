"""Links and components against all pairs, and recall at the threshold."""

import math

import numpy as np
import pytest

from loanframe.llm import embedding_dedup as dedup
from loanframe.llm.common import table
from loanframe.llm.queries import op3_embedding_dedup
from tests.conftest import SMALL
from tests.llm.fixtures import same_rows

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """{id: (n_links, component)} over all pairs of usable vectors."""
    ids = [i for i, v in rows]
    fine = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = np.array([v if f else [1.0] * len(rows[0][1]) for (_, v), f in zip(rows, fine)], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.9) & np.array(fine)[:, None] & np.array(fine)
    np.fill_diagonal(near, False)
    comp = np.array(ids)
    while True:
        low = np.minimum(comp, np.where(near, comp, np.iinfo(np.int64).max).min(1))
        if (low == comp).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), comp)}
        comp = low


def found_in(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    assert found_in(op3_embedding_dedup(spark, folder)) == brute(rows)


def clustered(seed, groups=150, dimension=64, cosine=None):
    """Groups of three: a vector and two at a cosine of ``cosine``, or of 0.9 to 1."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(groups):
        v = rng.normal(size=dimension)
        v /= np.linalg.norm(v)
        out.append(v)
        for _ in range(2):
            w = rng.normal(size=dimension)
            w -= (w @ v) * v
            w /= np.linalg.norm(w)
            c = cosine or rng.uniform(0.9, 1)
            out.append(c * v + np.sqrt(1 - c * c) * w)
    return [(i, [float(x) for x in np.float32(v * rng.uniform(0.1, 9))]) for i, v in enumerate(out)]


@pytest.mark.parametrize("cosine,least", [(0.905, 0.9), (None, 0.95)])
def test_recall(spark, cosine, least):
    rows = clustered(2, cosine=cosine)
    want, got = brute(rows), found_in(dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= least * sum(n for n, _ in want.values())


def test_planned_recall_does_not_depend_on_the_number_of_vectors():
    p = np.arccos(0.9) / np.pi
    for n in (1_000, 20_000, 35_279, 10**6, 10**7, 10**9):
        bits, rotations, near = dedup.plan(n, 64)
        missed = 1 - (1 - p) ** (bits - 1) * (1 - p + bits * p)
        within = sum(math.comb(64, k) * p ** k * (1 - p) ** (64 - k) for k in range(near + 1))
        assert within * (1 - missed ** (rotations * (64 // bits))) >= 0.9995, n
    assert dedup.plan(10**11, 64)[0] > 30


@pytest.mark.parametrize("bits", [12, 16, 20])
def test_recall_of_long_substrings(spark, bits):
    rows = clustered(6, 500, cosine=0.9005)
    want, frame = brute(rows), spark.createDataFrame(rows, SCHEMA)
    got = found_in(dedup.near_duplicates(frame, bits=bits, rotations=dedup.plan(16 << bits, 64)[1]))
    share = sum(n for n, _ in got.values()) / sum(n for n, _ in want.values())
    print(bits, dedup.plan(16 << bits, 64), share)
    assert dedup.plan(16 << bits, 64)[0] == bits and all(got[i][0] <= want[i][0] for i in want)
    assert share >= 0.995


def test_blocks_of_a_full_bucket_change_nothing(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + rng.normal(size=16) * 0.05]) for i in range(300)] + clustered(5, 20, 16)[:0]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole, parted = (found_in(dedup.near_duplicates(frame, block=b)) for b in (4096, 40))
    assert whole == parted == brute(rows)


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v), (4, v), (4, v), (9, [2.0, 4.0, 6.0]), (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]),
            (7, [1.0, float("nan"), 2.0]), (8, [float("inf"), 1.0, 1.0]), (10, [1.0, 2.0]), (None, v), (11, [-1.0, -2.0, -3.0])]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in dedup.near_duplicates(frame).collect())
    alone = [(str(i), 0, str(i)) for i in (1, 2, 3, 6, 7, 8, 10, 11)]
    assert got == sorted(alone + [(str(i), 4, "4") for i in (5, 4, 4, 9, None)])
    more = frame.withColumns({c: F.lit("clash") for c in ("vector", "n", "cls", "least", "root", "label", "codes")})
    assert same_rows(dedup.near_duplicates(frame), dedup.near_duplicates(more))
    assert dedup.near_duplicates(frame.limit(0)).count() == 0
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1]), (3, [5.0, -1.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.1]), (6, [1.0]), (7, [2.0, 2.0, 2.0, 2.0])], SCHEMA)
    assert found_in(dedup.near_duplicates(mixed)) == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7)}
    huge = spark.createDataFrame([(1, [1e200, 1e200]), (2, [1e-200, 1e-200])], "vec_id long, embedding array<double>")
    assert found_in(dedup.near_duplicates(huge)) == {1: (1, 1), 2: (1, 1)}
