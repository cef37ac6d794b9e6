"""The corpus pipeline: what language ID rejects goes, then copies and near copies; the rest is mixed and packed.

Defined results: null and empty texts, and texts without a letter, go in the first stage; a long text is one document and
is read as a whole; of rows equal in text the one with the largest doc_id stays, of near copies the one with the smallest,
rows without id come last in both and rows that share an id are decided by id and text; repeated rows count once from the
second stage on; sources, null ones too, are mixed by what is left of them; an empty table gives an empty result; further
columns pass through all stages but the last, whatever their names, and none of them is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanframe.llm import exact_dedup, language, mixing, packing, simhash
from loanframe.llm.common import new_folder, remainder, table
from loanframe.llm.queries import vocabulary


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language; texts without a letter go."""
    return language.keep_identified(docs, remainder("doc_id", 5) != 0)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language ID", identified),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# language ID and packing cannot be said in SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = new_folder(spark, f"stage{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
