"""Filters, groups of equal texts and what stays, against plain versions."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanframe.llm import exact_dedup, fuse_filter
from loanframe.llm.queries import oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL
from tests.llm.fixtures import clashing, docs, same_rows


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_members_are_always_found(keys):
    keys = np.array(sorted(keys), np.int64)
    assert fuse_filter.contains(fuse_filter.build(keys), keys).all()


def test_few_others_pass():
    rng = np.random.default_rng(1)
    keys, others = rng.integers(-(2**63), 2**63 - 1, 50_000), rng.integers(-(2**63), 2**63 - 1, 100_000)
    blob = fuse_filter.build(keys)
    assert fuse_filter.contains(blob, keys).all() and fuse_filter.contains(blob, others).mean() < 0.006
    assert len(blob) < 1.3 * len(keys)


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(queries()["op2_exact_dedup"](spark, folder), connect(folder), oracle_sql()["op2_exact_dedup"]) is None


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.text or "", []).append(r.doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("old", [None, "true", "false", "doc_id > 4"])
def test_awkward_rows(spark, old):
    frame, old = docs(spark), old and F.expr(old)
    want = plain(frame.collect())
    found = exact_dedup.decisions(frame, old).collect()
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in want.items()}
    assert len(found) == frame.count() and all((r.keep_id, r.group_size) == by_digest[bytes(r.digest)] for r in found)
    assert sum(r.kept for r in found) == len(want)
    kept = exact_dedup.deduplicate(clashing(frame), old)
    assert kept.columns == clashing(frame).columns and sorted(r.text or "" for r in kept.collect()) == sorted(want)
    assert exact_dedup.decisions(frame.limit(0), old).count() == 0


def test_texts_that_share_a_digest_stay_apart(spark):
    frame = docs(spark)
    coarse = lambda text: F.substring(exact_dedup.digest(text), 1, 0)  # noqa: E731  one digest for all texts
    want, got = exact_dedup.decisions(frame), exact_dedup.decisions(frame, digest_of=coarse)
    names = ["doc_id", "keep_id", "group_size", "copy", "kept"]
    assert same_rows(want.select(*names), got.select(*names))


@pytest.mark.parametrize("old", [False, True, None])
def test_slots_follow_both_sides(spark, monkeypatch, old):
    """An empty snapshot, an empty batch and both: many slots, the same groups."""
    monkeypatch.setattr(exact_dedup.build_snapshot, "__defaults__", (0, 5))
    rows = [(i, f"text {i % 37}", None, None, 1) for i in range(120)]
    given = docs(spark, rows)
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.decisions(given, None if old is None else F.lit(old)).collect()}
    same = {}
    for i, t, *_ in rows:
        same.setdefault(t, []).append(i)
    assert found == {i: (max(same[t]), len(same[t])) for i, t, *_ in rows}
    digests = given.select("doc_id", exact_dedup.digest("text").alias("digest"))
    assert exact_dedup.build_snapshot(digests.limit(0), 100).slots == 20
