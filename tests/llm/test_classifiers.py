"""Quality and language: held-out accuracy, fitted trees, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.llm import boosting, language, quality
from loanframe.llm.common import table
from loanframe.llm.queries import op1_quality, op7_language
from tests.llm.fixtures import clashing, docs, same_rows

FOLDER = "/root/testdata/sf0.1"


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    found = op1_quality(spark, FOLDER).collect()
    assert len(found) == table(spark, FOLDER, "documents").count()
    held = [r for r in found if r.held_out and labels.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    for value, least in ((0, 0.93), (1, 0.98)):
        own = [r for r in held if labels[r.doc_id] == value]
        assert sum(r.predicted == value for r in own) >= least * len(own) > 0


def test_flattened_trees_equal_a_walk_by_hand():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(800, 5)).round(1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.1)).astype(float)
    trees = boosting.fit(x, y, trees=20, depth=3)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    for row in x[:50]:
        total = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += leaf[node - len(f)]
        assert trees.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_of_awkward_rows(spark):
    frame = docs(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (8, 1), (8, None), (99, 1), (None, 1)], "doc_id long, quality int")
    trees = quality.fit(frame, labels, "quality")
    found = quality.scores(frame, trees)
    assert found.count() == frame.count() and all(0 <= r.score <= 1 for r in found.collect())
    assert same_rows(found, quality.scores(clashing(frame), trees))
    empty = quality.fit(frame, labels.limit(0), "quality")
    assert {r.score for r in quality.scores(frame, empty).collect()} == {0.5}
    assert quality.scores(frame.limit(0), trees).count() == 0


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").select("doc_id", "lang").collect()}
    found = op7_language(spark, FOLDER).collect()
    assert len(found) == len(lang) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.995 * len(held) > 0


def test_language_of_awkward_rows(spark):
    frame = docs(spark)
    found = language.identify(frame, F.lit(True))
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == frame.count()
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (3, 4, 6, 9))
    assert all(by_id[i].lang_pred in {"en", "de", "es", "fr"} for i in (1, 5, 7, None, 10))
    assert same_rows(found, language.identify(clashing(frame), F.lit(True)))
    assert {r.lang_pred for r in language.identify(frame, F.lit(False)).collect()} == {"und"}
    one = language.identify(frame.filter("lang = 'en'"), F.lit(True)).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    assert language.identify(frame.limit(0), F.lit(True)).count() == 0
    kept = language.keep_identified(clashing(frame), F.lit(True))
    assert kept.columns == clashing(frame).columns and kept.count() == frame.count() - 4


def plain_language(text, model):
    """Family and language with dictionaries and plain sums, for one text."""
    counts = {}
    data = f" {text.lower()} ".encode()
    kept = [b if b >= 0x80 or ord("a") <= b <= ord("z") else 32 for b in data]
    for a, b, c in zip(kept, kept[1:], kept[2:]):
        if b != 32:
            place = (((a << 16 | b << 8 | c) * 2654435761) % 2**32) >> 21
            counts[place] = counts.get(place, 0) + 1
    length = sum(counts.values()) ** 0.5
    x = {k: n ** 0.5 / length for k, n in counts.items()}
    margin = lambda machine: sum(v * float(machine[0][k]) for k, v in x.items()) + machine[1]
    sure = lambda m: 1 / (1 + np.exp(-min(50, max(-50, 4 * m))))
    margins = {f: margin(model.families[f]) if len(model.languages) > 1 else 10.0 for f in model.languages}
    best = max(margins, key=margins.get)
    codes = model.languages[best]
    if len(codes) == 1:
        return codes[0], sure(margins[best])
    votes, sums = dict.fromkeys(codes, 0), dict.fromkeys(codes, 0.0)
    for (a, b), machine in model.pairs.items():
        if a in votes:
            m = margin(machine)
            for code, own in ((a, m), (b, -m)):
                votes[code] += own > 0
                sums[code] += min(2, max(-2, own))
    won = max(codes, key=lambda c: votes[c] + 1e-3 * sums[c])
    return won, sure(margins[best]) * sure(sums[won] / (len(codes) - 1))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_language_query_equals_plain_machines(spark, folder):
    from loanframe.llm.common import remainder

    frame = table(spark, folder, "documents")
    model = language.fit(frame.filter(remainder("doc_id", 5) != 0).select("doc_id", "lang", "text"))
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in op7_language(spark, folder).collect():
        text = texts[r.doc_id]
        if not text or not language.LETTER.search(text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        lang, score = plain_language(text, model)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-4), (r, lang, score)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_quality_query_equals_a_walk_by_hand(spark, folder):
    from loanframe.llm.common import remainder

    frame, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    trees = quality.fit(frame, labels.filter(remainder("doc_id", 4) != 2), "quality")
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in op1_quality(spark, folder).collect():
        row, total = quality.statistics(texts[r.doc_id]), float(trees.base)
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += leaf[node - len(f)]
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9) and r.predicted == (r.score >= 0.7)
    text = "One two two.\nOne two two.\n\nA! B"
    own = dict(zip(quality.STATISTICS, quality.statistics(text))) if not isinstance(quality.STATISTICS, int) else {}
    assert len(quality.statistics(text)) == len(quality.STATISTICS) and all(np.isfinite(list(own.values())))


def test_texts_of_one_id_stay_within_the_sample(spark):
    """Labelled ids that stand in many rows, and many rows of one draw, do not exceed the bound."""
    frame = spark.createDataFrame([(1, f"some text number {i}", "en", "a", 3) for i in range(60)] + [(2, "anderer Text hier", "de", "a", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert 0 <= quality.scores(frame, quality.fit(frame, labels, "quality", at_most=5)).first().score <= 1
    assert language.fit(frame, at_most=5) is not None
