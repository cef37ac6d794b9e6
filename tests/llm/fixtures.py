"""Small awkward tables for the training-data operators."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 4000
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.", "en", "a", 10),
    (2, "Alpha beta gamma delta epsilon zeta eta theta.", "en", "a", 10),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, LONG, "en", None, None),
    (6, "  \t\n ", "fr", "b", 5),
    (7, "x", None, "c", 1),
    (7, "x", None, "c", 1),
    (8, "Alpha beta gamma delta epsilon zeta eta theta,", "de", "a", 10),
    (None, "no id here at all, none", "es", "c", 3),
    (9, "12345 !!! ???", "en", "b", 4),
    (10, "Ünïcödé ﬁ Ω≈ç √ <|endoftext|> it's we'll\x1fdone end", "de", "b", 4),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["digest", "keep_id", "n", "old", "row", "mix_size", "mix_source", "mix_target", "mix_copies", "length", "offset", "full",
         "sequence_id", "piece", "node", "component", "fingerprint", "score", "kept", "slot", "same", "first", "payload"]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The table with further columns under the names the operators use."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASH})


def same_rows(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))
