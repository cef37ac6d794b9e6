"""Exact de-duplication against an immutable snapshot that is screened by static binary-fuse filters.

A snapshot keeps one row per digest (its exact buckets) and, per range of hashed digests, one filter of bounded size.
Incoming digests that a filter rejects are new; only the others meet the exact buckets.  Equal digests inside the
incoming batch, and inside the snapshot when it is made, are grouped on their own.  Whatever shares a digest is then
compared byte by byte: its texts are grouped by the text itself, after the copies of each task have been combined.

Defined results: a null text counts as the empty one; the largest doc_id of equal texts stays, a null id only if there
is no other; rows equal in doc_id and text are one row more each in the group, and one of them stays; empty tables give
empty results; further columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.llm import fuse_filter
from loanframe.llm.collocations import filter_bits, passed
from loanframe.llm.common import remainder, sorted_groups, stored

KEYS_PER_FILTER = 50_000


@dataclass
class Snapshot:
    """Exact buckets (digest, slot, keep_id, n) and their filters (slot, filter)."""

    buckets: DataFrame
    filters: DataFrame
    slots: int


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("slot"), "digest"), F.lit(slots)).cast("int")


def by_digest(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of rows (doc_id, digest)."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))


def build_snapshot(rows: DataFrame, incoming: int = 0, keys_per_filter: int = KEYS_PER_FILTER) -> Snapshot:
    """Buckets and filters of rows (doc_id, digest).

    A filter holds about ``keys_per_filter`` digests at most, and is asked for as many of the ``incoming`` ones, at any size.
    """
    buckets = stored(by_digest(rows))
    slots = max(1, math.ceil(max(buckets.count(), incoming) / keys_per_filter))
    buckets = buckets.withColumn("slot", _slot(slots))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at in sorted_groups(batches, ["slot"]):
            slot, key = (part.column(c).to_numpy() for c in ("slot", "key"))
            blobs = [fuse_filter.build(key[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot[at[:-1]], pa.int32()), "filter": pa.array(blobs, pa.binary())})

    keys = buckets.select("slot", F.xxhash64("digest").alias("key")).repartition("slot").sortWithinPartitions("slot")
    return Snapshot(buckets, stored(keys.mapInArrow(build, "slot int, filter binary")), slots)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Incoming digests (digest, keep_id, n) that the snapshot's filters do not reject; none for an empty snapshot."""
    if snapshot.filters.isEmpty():
        return incoming.limit(0)

    def probe(key: tuple, rows: pa.Table, filters: pa.Table) -> pa.Table:
        if not filters.num_rows or not rows.num_rows:
            return rows.slice(0, 0).select(["digest", "keep_id", "n"])
        found = fuse_filter.contains(filters.column("filter")[0].as_py(), rows.column("key").to_numpy())
        return rows.filter(pa.array(found)).select(["digest", "keep_id", "n"])

    rows = incoming.withColumns({"slot": _slot(snapshot.slots), "key": F.xxhash64("digest")})
    kind = {f.name: f.dataType.simpleString() for f in incoming.schema}
    return rows.groupBy("slot").cogroup(snapshot.filters.groupBy("slot")).applyInArrow(
        probe, f"digest binary, keep_id {kind['keep_id']}, n bigint")


def _may_be(digests: DataFrame) -> Callable[[Column], Column]:
    """Whether a digest's hash is among some digests, or nearly so: keeps texts that meet no other from being moved.

    The filter has a bounded size at any number of digests; what it lets pass too much is settled by the join after it.
    """
    bits = digests.sparkSession.sparkContext.broadcast(filter_bits(digests.select(F.xxhash64("digest").alias("key"))))

    @F.pandas_udf("boolean")
    def among(key: pd.Series) -> pd.Series:
        return pd.Series(passed(bits.value, key.to_numpy().view(np.uint64)))

    return among


def equal_texts(docs: DataFrame, old: Column, digest_of: Callable[[str], Column] = digest) -> tuple[DataFrame, bool]:
    """Groups of equal texts with more than one row, and whether different texts share a digest.

    (digest, keep_id, n); with the text as well in the second case, which is then needed to tell the groups apart.
    ``old`` tells the rows of the snapshot from the incoming ones.
    """
    rows = docs.select("doc_id", digest_of("text").alias("digest"), F.coalesce(old, F.lit(False)).alias("old"))
    incoming = stored(by_digest(rows.filter("not old")))
    snapshot = build_snapshot(rows.filter("old"), incoming.count())
    shared = screen(incoming, snapshot).join(snapshot.buckets.select("digest"), "digest", "left_semi").select("digest")
    shared = shared.unionByName(incoming.filter("n > 1").select("digest"))
    shared = stored(shared.unionByName(snapshot.buckets.filter("n > 1").select("digest")).distinct())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest_of("text").alias("digest"))
    texts = texts.filter(_may_be(shared)(F.xxhash64("digest")))
    # grouped by the text alone: the copies of a task are combined first, and Spark may split a hot digest before it
    same = texts.join(shared.hint("shuffle_hash"), "digest").groupBy("text").agg(
        F.first("digest").alias("digest"), F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = stored(same.select("digest", "keep_id", "n"))
    collided = not groups.groupBy("digest").count().filter("count > 1").isEmpty()
    return (same if collided else groups), collided


def decisions(docs: DataFrame, old: Column | None = None, digest_of: Callable[[str], Column] = digest) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, copy, kept.

    ``copy`` numbers the rows that are equal in doc_id and text; only the first of them can be kept.  Without ``old``
    half of the rows, by the remainder of their id, are the snapshot.
    """
    docs = docs.select("doc_id", "text")
    groups, collided = equal_texts(docs, remainder("doc_id", 2) == 0 if old is None else old, digest_of)
    rows = docs.select("doc_id", digest_of("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    on = ["digest", "text"] if collided else ["digest"]
    rows = rows.groupBy("doc_id", *on).agg(F.count(F.lit(1)).alias("same"))
    keep, size = F.coalesce("keep_id", "doc_id"), F.coalesce("n", "same")
    found = rows.join(groups, on, "left").select("doc_id", "digest", keep.alias("keep_id"), size.alias("group_size"), "same")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("same").cast("int")))).drop("same")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))


def deduplicate(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    # a key without nulls, so that the join and the dropping of repeated rows share one deal of the wide rows
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text")
    kept = decisions(docs, old).filter("kept").select("digest", id_text)
    rows = docs.select(digest("text").alias("digest"), id_text, F.struct("*").alias("row"))
    return rows.join(kept, ["digest", "id_text"], "left_semi").dropDuplicates(["digest", "id_text"]).select("row.*")
