"""Quality scores: histogram gradient-boosted trees over statistics of whole texts.

The trees are fitted on at most ``at_most`` labelled rows, chosen by a hash of the id, and flattened into arrays that
score a batch of documents level by level.

Defined results: a null text counts as the empty one and is scored like any other; without labelled rows every score
is 0.5; a document with several labels is several examples, null labels are none; repeated rows get equal scores; an
empty table gives an empty one; only text enters a score, further columns are not read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe.llm import boosting
from loanframe.llm.common import bounded_sample

AT_MOST = 20_000       # labelled documents that the trees are fitted on
GOOD = 0.7             # scores from here on are predicted as class 1
# kinds of bytes: lower, upper, digit, space, line break, common punctuation, other ASCII, part of a longer character
_KIND = np.full(256, 7, np.uint8)
_KIND[:128] = 6
for _kind, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:!?'\"()-"]):
    _KIND[[ord(c) for c in _chars]] = _kind
STATISTICS = [
    "log_words", "word_length", "lower", "upper", "digit", "space", "line_break", "punctuation", "symbol", "wide", "distinct_words",
    "repeated_neighbours", "longest_run", "words_per_line", "distinct_lines", "short_words", "upper_words", "exclamations", "bars", "stops",
    "symbol_words",
]


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of STATISTICS."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=8) / max(1, len(raw))
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n = max(1, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    same = np.fromiter(map(operator.eq, words, words[1:]), bool, max(0, len(words) - 1))
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    last = [w[-1] for w in words]
    return [
        np.log1p(len(words)), length.sum() / n, *kinds, len(set(words)) / n, same.sum() / n, np.log1p(np.diff(breaks).max()),
        len(words) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)), (length <= 3).sum() / n, sum(map(str.isupper, words)) / n,
        text.count("!") / n, text.count("|") / n, text.count(".") / n, sum(c in "#$%&*|" for c in last) / n,
    ]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, label: str, at_most: int = AT_MOST) -> boosting.Trees:
    """Trees for ``label`` (0 or 1) from (doc_id, label) rows and the texts they name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y")], names=["x", "y"])

    named = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    chosen = F.broadcast(bounded_sample(named, at_most, "id", seed=23))          # at_most rows of two numbers
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id")).select("text", "y")
    found = rows.mapInArrow(run, "x binary, y int").limit(at_most).toPandas()    # an id may stand in several rows
    x = np.frombuffer(b"".join(found["x"]), np.float64).reshape(len(found), len(STATISTICS))
    order = np.lexsort([*x.T, found["y"]])                                       # rows arrive in any order
    return boosting.fit(x[order], found["y"].to_numpy(np.float64)[order])


def scores(docs: DataFrame, trees: boosting.Trees) -> DataFrame:
    """doc_id and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = trees.score(_matrix(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
