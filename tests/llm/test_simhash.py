"""Fingerprints and components against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash

from loanframe.llm import simhash
from loanframe.llm.common import components, table
from loanframe.llm.queries import op4_simhash_dedup
from tests.conftest import SMALL
from tests.llm.fixtures import clashing, docs, same_rows


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    runs = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id per component for {id: fingerprint}, over all pairs."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    name = list(range(len(ids)))

    def top(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            a, b = sorted((top(i), top(int(j))))
            name[b] = a
    return {ids[i]: ids[top(i)] for i in range(len(ids))}


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in table(spark, folder, "documents").collect()}
    want = plain_components(prints)
    found = op4_simhash_dedup(spark, folder).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted((i, f"{prints[i]:016x}", want[i]) for i in prints)


def near_values(seed, n=400):
    rng, values = random.Random(seed), []
    for _ in range(n):
        v = rng.getrandbits(64)
        values.append(v)
        for _ in range(rng.randrange(4)):
            for _ in range(rng.randrange(1, 5)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
    return sorted(set(values))


@pytest.mark.parametrize("hot", [20_000, 2])
def test_anchors_lose_no_link(spark, hot):
    values = near_values(5)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    joined = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), hot)).collect()
    group = {r.node: r.component for r in joined}
    want = plain_components(dict(enumerate(values)))
    found = {}
    for i, v in enumerate(signed):
        found.setdefault(group.get(v, v), set()).add(i)
    expected = {}
    for i, c in want.items():
        expected.setdefault(c, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_one_crowded_anchor_is_dealt_again(spark):
    rng, base = random.Random(7), random.Random(8).getrandbits(64)
    values = {base}
    while len(values) < 900:                        # all in the lower half of one anchor, far apart in the upper one
        values.add(base & 0xFFFFFFFF | rng.getrandbits(32) << 32)
    values |= {v ^ 1 << rng.randrange(32, 64) for v in list(values)[:50]}
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    whole, dealt = (components(simhash.links(frame, hot)) for hot in (10_000, 100))
    want = plain_components(dict(enumerate(values)))
    assert same_rows(whole, dealt) and len({r.component for r in dealt.collect()}) == len(
        {c for c in want.values() if list(want.values()).count(c) > 1})


def test_awkward_rows(spark):
    given = docs(spark)
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(given).collect()}
    assert found[(3, 0)] == found[(4, 0)] == found[(6, 0)] == 3
    assert same_rows(simhash.near_duplicates(given), simhash.near_duplicates(clashing(given)))
    assert simhash.near_duplicates(given.limit(0)).count() == 0
    kept = simhash.deduplicate(clashing(given))
    assert kept.columns == clashing(given).columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(str(i) for i in [1, 3, 5, 7, None, 9, 10] + [8] * (found[(8, simhash_of(given, 8))] == 8))


def test_rows_that_share_an_id_are_decided_each_on_its_own(spark):
    a, b = " ".join(f"word{i}" for i in range(400)) + " ", " ".join(f"other{i * i}" for i in range(400))
    rows = [(1, a, None, None, 1), (1, b, None, None, 1), (None, a + "extra", None, None, 1), (None, "quite another text without any twin at all here", None, None, 1),
            (None, b, None, None, 1), (2, a, None, None, 1), (2, a, None, None, 1)]
    assert bin(simhash.fingerprint(a) ^ simhash.fingerprint(a + "extra")).count("1") <= 3
    kept = sorted((str(r.doc_id), r.text) for r in simhash.deduplicate(docs(spark, rows)).collect())
    assert kept == sorted([("1", a), ("1", b), ("None", rows[3][1])])
    near_null = docs(spark, [(None, a, None, None, 1), (None, a + "extra", None, None, 1)])
    assert simhash.deduplicate(near_null).count() == 1


def simhash_of(given, doc_id):
    text = given.filter(f"doc_id = {doc_id}").first().text
    return int(np.array([simhash.fingerprint(text)], np.uint64).view(np.int64)[0])


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
