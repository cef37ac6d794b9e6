"""Hierarchical language identification: first the family, then one-versus-one linear machines within it.

A text becomes the counts of its hashed letter trigrams, scaled to length one.  One linear support vector machine per
family decides the family; in a family of several languages one machine per pair of them votes.  The machines are
fitted on at most ``at_most`` labelled rows, chosen by a hash of the id and spread over the languages.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is no
labelled row to learn from; a family with one learned language needs no pair; repeated rows get equal answers; an
empty table gives an empty one; lang, source, doc_id and further columns never enter a prediction.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.llm.common import hash_share
from loanframe.llm.linear import fit_svm

BUCKETS = 2048
AT_MOST = 4_000        # labelled rows that the machines are fitted on
UNKNOWN = "und"
# fixed values: language codes by family; any other code is a family of its own
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "pt", "it", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bg", "mk"],
    "turkic": ["tr", "az", "kk", "ky", "uz", "tk"],
    "uralic": ["fi", "et", "hu"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
LETTER = re.compile(r"[^\W\d_]")
# bytes that are no letters part the words; those of longer characters stay
_KEPT = np.array([b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)
STEP = 1 << 20         # bytes that are hashed at a time


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def trigrams(text: str) -> np.ndarray:
    """Counts of the hashed trigrams of the whole text, as a row of length one (or zero)."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(BUCKETS)
    for at in range(0, len(data) - 2, STEP):
        b = _KEPT[data[at:at + STEP + 2]]
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        code = code[(b[1:-1] != 32)]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(21), minlength=BUCKETS)
    counts = np.sqrt(counts)
    return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


@dataclass
class Model:
    """Machines by family and by pair of languages; each is (weights, intercept)."""

    families: dict[str, tuple[np.ndarray, float]]
    languages: dict[str, list[str]]
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of the rows."""
        names = list(self.languages)
        sure = lambda m: 1 / (1 + np.exp(-np.clip(4.0 * m, -50, 50)))
        margin = np.stack([x @ self.families[f][0] + self.families[f][1] for f in names]) if len(names) > 1 else np.full((1, len(x)), 10.0)
        best = margin.argmax(0)
        lang, score = np.empty(len(x), object), sure(margin.max(0))
        for k, f in enumerate(names):
            rows, of = np.flatnonzero(best == k), self.languages[f]
            votes, sums = np.zeros((len(of), len(rows))), np.zeros((len(of), len(rows)))
            for i, j in itertools.combinations(range(len(of)), 2):
                w, c = self.pairs[of[i], of[j]]
                m = x[rows] @ w + c
                for n, s in ((i, m), (j, -m)):
                    votes[n] += s > 0
                    sums[n] += np.clip(s, -2, 2)
            if len(of) > 1 and len(rows):
                win = (votes + 1e-3 * sums).argmax(0)
                lang[rows] = np.array(of, object)[win]
                score[rows] *= sure(sums[win, np.arange(len(rows))] / (len(of) - 1))
            else:
                lang[rows] = of[0]
        return lang.tolist(), np.clip(score, 0, 1)


def training_rows(docs: DataFrame, at_most: int = AT_MOST) -> DataFrame:
    """(lang, text) of about ``at_most`` rows with a language, evenly over the languages where it can be.

    The draw is a number per row, so the last one drawn is found on numbers alone and the texts stay where they are.
    """
    rows = docs.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(at_most).collect()}
    if not counts:
        return rows.select("lang", "text").limit(0)
    each = at_most / len(counts)
    share = F.coalesce(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))])[F.col("lang")], F.lit(0.0))
    draw = hash_share("doc_id", seed=17)
    drawn = rows.filter(draw < share)
    last = drawn.select((draw / share).alias("turn")).orderBy("turn").limit(at_most).agg(F.max("turn")).first()[0]
    return drawn.filter(draw / share <= F.lit(last)).select("lang", "text")


def fit(docs: DataFrame, at_most: int = AT_MOST) -> Model | None:
    """The model of the labelled rows; None if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [trigrams(t).tobytes() if LETTER.search(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary())], names=["lang", "x"])

    found = training_rows(docs, at_most).mapInArrow(run, "lang string, x binary").filter("x is not null").limit(at_most).toPandas()
    if not len(found):
        return None
    x, lang = np.frombuffer(b"".join(found["x"]), np.float32).reshape(len(found), -1), found["lang"].to_numpy(object)
    languages: dict[str, list[str]] = {}
    for code in sorted(set(lang)):
        languages.setdefault(family(code), []).append(code)
    of_family = np.array([family(code) for code in lang], object)
    families = {f: fit_svm(x, of_family == f) for f in languages} if len(languages) > 1 else {}
    pairs = {}
    for codes in languages.values():
        for a, b in itertools.combinations(codes, 2):
            own = (lang == a) | (lang == b)
            pairs[a, b] = fit_svm(x[own], lang[own] == a)
    return Model(families, languages, pairs)


def predict(docs: DataFrame, model: Model | None, carry: list[Column]) -> DataFrame:
    """The ``carry`` columns of every row with lang_pred and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("__text").to_pylist()
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model else []
                if known:
                    names, sure = model.predict(np.stack([trigrams(texts[i]) for i in known]))
                    score[known] = sure
                    for i, name in zip(known, names):
                        lang[i] = name
                kept = [c for c in part.schema.names if c != "__text"]
                columns = [part.column(c) for c in kept] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    rows = docs.select(*carry, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(run, schema + ", lang_pred string, score double")


def identify(docs: DataFrame, learn: Column, at_most: int = AT_MOST) -> DataFrame:
    """doc_id, lang_pred and score of every row; the model learns from the rows where ``learn`` holds."""
    model = fit(docs.filter(learn).select("doc_id", "lang", "text"), at_most)
    return predict(docs, model, [F.col("doc_id")])


def keep_identified(docs: DataFrame, learn: Column, at_most: int = AT_MOST) -> DataFrame:
    """The rows with a letter, with the language found, or the one they had if there is no model."""
    model = fit(docs.filter(learn).select("doc_id", "lang", "text"), at_most)
    if model is None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([bool(t and LETTER.search(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    found = predict(docs, model, [F.struct("*").alias("row")])
    found = found.filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("row", F.col("row").withField("lang", F.col("lang_pred"))).select("row.*")
