"""Targets, copies and words taken."""

import collections
import re

import pytest

from loanframe.llm import mixing
from loanframe.llm.common import table
from loanframe.llm.queries import oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL
from tests.llm.fixtures import clashing, docs, same_rows


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(queries()["op9_mixing"](spark, folder), connect(folder), oracle_sql()["op9_mixing"]) is None


def poured(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by repeated sharing of what is above the caps."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = (total - sum(full.values())) / max(1e-12, sum(weight[s] for s in open_))
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in open_}
        full |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 20, None: 5}, {"a": 0, "b": 0}, {"x": 7}, {c: 3 ** k for k, c in enumerate("abcdefgh")}])
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert found.keys() == sizes.keys() and all(found[s] == pytest.approx(t, abs=1e-5) for s, t in poured(sizes).items())


def test_mix_comes_near_its_targets(spark):
    frame = table(spark, "/root/testdata/sf0.1", "documents")
    got, goal = collections.Counter(), {}
    for r in mixing.mix_plan(frame.select("doc_id", "source", "text")).collect():
        got[r.source] += r.mix_size * r.mix_copies
        goal[r.source] = r.mix_target
        assert 0 <= r.mix_copies <= 2
    assert all(abs(got[s] - t) <= 0.2 * t for s, t in goal.items())
    assert abs(sum(got.values()) - sum(goal.values())) <= 0.03 * sum(goal.values())


def test_awkward_rows(spark):
    frame = docs(spark)
    for r in mixing.mix_plan(frame.select("doc_id", "source", "text")).collect():
        assert r.mix_size == len(re.findall("[^\x20\x09-\x0D]+", r.text or ""))
    mixed, more = mixing.mix(frame), mixing.mix(clashing(frame))
    assert more.columns == clashing(frame).columns and same_rows(mixed, more) and same_rows(mixed, mixing.mix(frame))
    assert mixing.mix(frame.limit(0)).count() == 0
