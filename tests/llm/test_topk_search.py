"""The impact-ordered index against SQL and against plain integer products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.llm import topk_search
from loanframe.llm.queries import oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(queries()["op11_topk_search"](spark, folder), connect(folder), oracle_sql()["op11_topk_search"]) is None


def plain(rows, k=5, modulus=50):
    """Every row against every other one, with Python's own integers."""
    import math

    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(whole):
        if i is not None and i % modulus == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), math.inf if j is None else j) for m, (j, c) in enumerate(whole) if m != n)
            out += [(i, r + 1, None if j == math.inf else j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(map(repr, out))


def searched(df, **settings):
    return sorted(repr(tuple(r)) for r in topk_search.search(df, F.col("vec_id") % 50 == 0, **settings).collect())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5, 0.25], 1), (50, [-1.0, 0.1, 0.3], 2), (1, None, 0), (2, [1.0, None, 0.0], 0), (3, [nan, 0.0, 0.0], 0), (100, [inf, 1.0, 1.0], 0),
            (4, [], 3), (5, [2.0, 0.5], 1), (6, [1.0, 2.0, 3.0, 4.0], 1), (150, [1.0, 2.0, 3.0, 4.0], 1), (7, [1.0, -0.5, 0.25], 1), (7, [1.0, -0.5, 0.25], 1),
            (None, [1.0, -0.5, 0.25], 1), (0, [1.0, -0.5, 0.25], 1), (8, [1e5, -1e5, 3.3], 1), (200, [], 1), (250, [0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for settings in ({}, {"block": 3, "per_task": 2}):
        assert searched(df, **settings) == plain(rows)
    clash = df.withColumns({c: F.lit("x") for c in ("row", "q", "block", "ask", "score", "rank", "query_id")})
    assert searched(clash) == plain(rows)
    assert searched(df.limit(0)) == [] and searched(df.filter("vec_id = 50")) == []
    assert searched(df.filter("vec_id in (1, 2, 3)")) == []


def test_stops_on_proof_and_stays_exact(spark):
    """Many ties, long and short posting lists, few levels: the same rows, whatever the index looks like."""
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0, 1), 1) for _ in range(12)], 0) for i in range(700)] + [(1000 + i, [0.5] * 12, 0) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    for levels in (1, 7, 300):
        found = topk_search.index(topk_search.dealt(topk_search.quantised(df, "embedding", 256.0).withColumn("row", F.monotonically_increasing_id()), 780, 200, "block"), levels)
        assert found.filter("dim >= 0").agg(F.max(F.size("level"))).first()[0] <= levels + 1
    assert searched(df, block=300, per_task=5) == want


def test_proof_leaves_few_members():
    """A vector close to the query is proven best before all segments are read."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    m = np.floor(rng.normal(size=(4000, 32)) * 256).astype(np.int64)
    m[17] = m[3] * 2
    rows = [(-1, 0, [], [], list(range(4000)), list(range(4000)))]
    for d in range(32):
        width = -(-(int(m[:, d].max()) - int(m[:, d].min()) + 1) // 64)
        level = m[:, d] // width
        order = np.argsort(-level, kind="stable")
        starts = np.flatnonzero(np.diff(level[order], prepend=level[order[0]] + 1))
        rows.append((d, width, level[order[starts]].tolist(), np.diff(np.append(starts, 4000)).tolist(), order.tolist(), m[order, d].tolist()))
    table = pa.table(dict(zip(("dim", "width", "level", "count", "members", "values"), map(list, zip(*rows)))))
    block = topk_search.Block(table)
    assert len(block._possible(m[3], 1, 32, 12)) <= 32
    score = m @ m[3]
    for k in (1, 5):
        want = sorted(((-s, i) for i, s in enumerate(score.tolist()) if i != 3))[:k]
        assert block.search(m[3], 3, k) == [(-s, i) for s, i in want]
