"""Collocations against SQL and against counting with plain dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.llm import collocations
from loanframe.llm.queries import oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string"


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare(queries()["op13_collocations"](spark, folder), connect(folder), oracle_sql()["op13_collocations"]) is None


def plain(rows, threshold, first=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in f.items() if a >= threshold and len(k[1]) > 1}
    out = []
    for (lang, words), a in candidates.items():
        if any(la == lang and len(w) > len(words) and 100 * b >= 80 * a and any(w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1))
               for (la, w), b in candidates.items()):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out.sort()
    found, rank = [], Counter()
    for lang, score, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= first:
            found.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(map(repr, found))


def found(df, **settings):
    return sorted(repr(tuple(r)) for r in collocations.collocations(df, **settings).collect())


def test_awkward_texts(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "B", "b", "é", "É", "x\x1fy", "q" * 70 + "r", "q" * 70 + "s", "don't", "\x00", "of", "the"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\t", "\n", "  ", ";;"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"]))
            for i in range(150)] + [(1, None, "en"), (2, "", None), (3, " .,\n ", "de"), (4, "a b c d " * 400, "es"), (4, "a b c d " * 400, "es"), (None, "In The ZONE " * 50, "en")]
    df = spark.createDataFrame(rows, DOCS)
    for threshold in (3, 30):
        assert found(df, threshold=threshold) == plain(rows, threshold)
    assert found(df, threshold=3, first=4) == plain(rows, 3, 4)
    clash = df.withColumns({c: F.lit(1) for c in ("phrase", "n", "a", "key", "part", "size", "words", "rank")})
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 90)
    monkeypatch.setattr(collocations, "RECENT", 3)
    monkeypatch.setattr(collocations, "PHRASES", 60)
    assert found(clash.repartition(3), threshold=3) == plain(rows, 3)
    assert found(df.limit(0)) == [] and found(df.filter("text is null or text = ''")) == []


def test_summaries_keep_what_is_frequent():
    """Merged in any order and pruned on the way, a summary never loses a key that reaches the threshold."""
    rng = np.random.default_rng(1)
    threshold = 30
    keys = np.concatenate([rng.integers(0, 40_000, 60_000), np.repeat(np.arange(100_000, 100_050), 30), np.repeat(np.arange(200_000, 200_050), 29)]).astype(np.uint64)
    rng.shuffle(keys)
    whole = collocations.Summary(len(keys) // threshold + 1)
    for part in np.array_split(keys, 40):
        whole.add(*np.unique(part, return_counts=True))
    assert len(whole.keys) <= whole.capacity and 0 < whole.error < threshold
    got, n = np.unique(keys, return_counts=True)
    kept = whole.reaching(threshold)
    assert np.isin(got[n >= threshold], kept).all() and not np.isin(got[n + whole.error < threshold], kept).any()


def test_survivors_in_many_partitions(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{min(int(rng.expovariate(0.02)), 300)}" for _ in range(80)), "en") for i in range(200)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    lengths = (1, 2, 3)
    local, mass = collocations.local_counts(df, lengths, held_most=500), collocations.masses(df, 7, lengths)
    assert mass.sum() == 200 * (80 + 79 + 78) == local.agg(F.sum("n")).first()[0]
    want = {r["key"] for r in local.groupBy("key").agg(F.sum("n").alias("n")).filter("n >= 30").collect()}
    assert want and want <= {r["key"] for r in collocations.survivors(local, mass, 3, 30).collect()}
    assert found(df, counters=10) == plain(rows, 30)
