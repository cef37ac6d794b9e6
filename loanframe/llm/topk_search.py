"""Exact top-k search by an impact-ordered index, processed score at a time.

Vectors are dealt into blocks of bounded size.  Of each block and dimension the index keeps a posting list ordered by
quantised impact: segments of equal level, from the highest to the lowest, with the members and their exact values.

A query ranks the segments of all dimensions by what they add at least over the dimension's worst, and takes them in that
order.  After each step the k-th best sum so far is a floor; a vector stays possible while its sum and all that the segments
to come could add reach the floor.  The query stops only when few vectors are possible, or all segments are taken; the
possible ones are scored exactly.  Each block gives at most k rows per query.

Defined results: vectors that are null or hold null or non-finite components take no part, neither as query nor as
candidate; an empty vector scores zero; of vectors of different lengths the missing components count as zero; ties go to the
smaller vec_id; a row meets every other row, also one with its own vec_id, and repeated rows each count; null ids sort last
and are no queries; an empty table gives no rows; other columns are not read.  Scores must fit 64 bits, else the search
fails with an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.llm.common import stored

BLOCK = 8192           # vectors of a block of the index
QUERIES = 512          # queries that meet a block in one task
LEVELS = 64            # quantised impacts per dimension and block
FEW = 32               # possible members, in multiples of k, that are scored exactly at once
STEPS = 12             # parts of all postings after which a query looks whether it may stop


def quantised(vectors: DataFrame, column: str, scale: float) -> DataFrame:
    """Rows whose vectors are whole, with integer components floor(scale * x) in ``q``."""
    x = F.transform(column, lambda v: v.cast("double"))
    whole = F.col(column).isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")).alias("q"))


def dealt(rows: DataFrame, n: int, size: int, name: str) -> DataFrame:
    """Rows with a block number; blocks hold about ``size`` rows, by a hash of the row number."""
    blocks = max(1, math.ceil(n / size))
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def index(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per block and dimension: block, dim, level and count of each segment, members and exact values by descending level.

    The row of dimension -1 names the block's vectors: row numbers as members, vec_id as values.
    """
    out = "block int, dim int, width bigint, level array<bigint>, count array<bigint>, members array<bigint>, `values` array<bigint>"

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        m = matrix(table.column("q").combine_chunks())
        rows_out = [(-1, 0, [], [], table.column("row").to_numpy(), table.column("vec_id").to_pylist())]
        for d in range(m.shape[1]):
            width = max(1, -(-(int(m[:, d].max()) - int(m[:, d].min()) + 1) // levels))
            level = m[:, d] // width
            order = np.argsort(-level, kind="stable")
            starts = np.flatnonzero(np.diff(level[order], prepend=level[order[0]] + 1))
            rows_out.append((d, width, level[order[starts]], np.diff(np.append(starts, len(order))), order, m[order, d]))
        columns = list(zip(*rows_out))
        long = pa.list_(pa.int64())
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * len(rows_out), pa.int32()), "dim": pa.array(columns[0], pa.int32()),
                         "width": pa.array(columns[1], pa.int64()), **{name: pa.array(list(c), long) for name, c in zip(("level", "count", "members", "values"), columns[2:])}})

    return rows.groupBy("block").applyInArrow(build, out)


def matrix(lists: pa.ListArray) -> np.ndarray:
    """The lists as rows of one matrix, filled with zeros."""
    size = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out


class Block:
    """The posting segments of one block and the search in them."""

    def __init__(self, table: pa.Table):
        found = {d: i for i, d in enumerate(table.column("dim").to_pylist())}
        column = {name: table.column(name).combine_chunks() for name in ("level", "count", "members", "values")}
        names = found.pop(-1)
        self.row, self.vec_id = column["members"][names].values.to_numpy(), np.array([math.inf if v is None else v for v in column["values"][names].as_py()], object)
        n, dims = len(self.row), len(found)
        self.exact = np.zeros((n, dims), np.int64)
        level, count, member = [], [], []
        width = table.column("width").to_numpy()
        self.width, self.n_segments = np.array([width[found[d]] for d in range(dims)], np.int64), np.zeros(dims, np.int64)
        for d in range(dims):
            at = found[d]
            own = column["members"][at].values.to_numpy()
            self.exact[own, d] = column["values"][at].values.to_numpy()
            level.append(column["level"][at].values.to_numpy()), count.append(column["count"][at].values.to_numpy()), member.append(own)
            self.n_segments[d] = len(level[-1])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.level, self.count, self.member = join(level), join(count), join(member)
        self.dim = np.repeat(np.arange(dims), self.n_segments)
        self.start = np.cumsum(self.count) - self.count
        self.first = np.cumsum(self.n_segments) - self.n_segments
        self.order = sorted(range(n), key=lambda i: self.vec_id[i])      # by id, for ties

    def search(self, query: np.ndarray, own_row: int, k: int, few: int = FEW, steps: int = STEPS) -> list[tuple[int, int]]:
        """(score, place) of the k best members of this block but the query's own row."""
        dims, n = self.exact.shape[1], len(self.row)
        q = np.zeros(dims, np.int64)
        q[:min(dims, len(query))] = query[:dims]
        possible = np.arange(n)
        if dims and n > few * k:
            possible = self._possible(q, k + 1, few, steps)          # one more: the query itself may be among them
        possible = possible[self.row[possible] != own_row]
        score = self.exact[possible] @ q
        if len(possible) > k:
            floor = np.partition(score, len(score) - k)[len(score) - k]
            possible, score = possible[score >= floor], score[score >= floor]
        ranked = sorted(zip((-score).tolist(), [self.vec_id[i] for i in possible], possible.tolist()), key=lambda x: x[:2])
        return [(-s, place) for s, _, place in ranked[:k]]

    def _possible(self, q: np.ndarray, k: int, few: int, steps: int) -> np.ndarray:
        # what a segment adds at least and at most: the values of level l lie in [l * width, (l + 1) * width - 1]
        lowest = q[self.dim] * self.level * self.width[self.dim]
        slack = q * (self.width - 1)
        least = lowest + np.minimum(slack, 0)[self.dim]
        worst = np.minimum.reduceat(least, self.first)
        gain = least - worst[self.dim]
        order = np.argsort(-gain, kind="stable")
        taken = np.cumsum(self.count[order])
        cuts = np.unique(np.searchsorted(taken, np.arange(1, steps + 1) * (taken[-1] / steps)))
        spread = int(np.abs(slack).sum())                            # what exact values may add to the least
        small = float(np.abs(q).astype(float) @ np.abs(self.exact).max(axis=0)) < 2.0 ** 50    # then sums of doubles are exact
        sums, before = np.zeros(len(self.row), float if small else np.int64), 0
        remaining = np.zeros(len(q), np.int64)
        for cut in cuts:
            now = order[before:cut + 1]
            before = cut + 1
            size = self.count[now]
            ends = np.cumsum(size)
            posting = np.arange(ends[-1]) + np.repeat(self.start[now] - ends + size, size)
            if small:
                sums += np.bincount(self.member[posting], np.repeat(gain[now].astype(float), size), minlength=len(sums))
            else:
                np.add.at(sums, self.member[posting], np.repeat(gain[now], size))
            # the best segment of each dimension that is still to come
            later = order[before:]
            remaining[:] = 0
            if len(later):
                np.maximum.at(remaining, self.dim[later], gain[later])
            floor = np.partition(sums, len(sums) - k)[len(sums) - k]
            possible = np.flatnonzero(sums + (int(remaining.sum()) + spread) >= floor)
            if len(possible) <= few * k:
                break
        return possible


def search(vectors: DataFrame, queries: Column, k: int = 5, column: str = "embedding", scale: float = 256.0, block: int = BLOCK, per_task: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row that ``queries`` holds for."""
    rows = stored(quantised(vectors, column, scale).withColumn("row", F.monotonically_increasing_id()))
    n, n_queries, size, top = rows.agg(
        F.count(F.lit(1)), F.count_if(queries), F.max(F.size("q")), F.max(F.aggregate("q", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v.cast("double"))))),
    ).first()
    if n and (size or 0) * (top or 0.0) ** 2 * 4 >= 2.0 ** 62:
        raise ValueError("components are too large for scores of 64 bits")
    groups, blocks = max(1, math.ceil((n_queries or 0) / per_task)), max(1, math.ceil((n or 0) / block))
    posted = stored(index(dealt(rows, n, block, "block")))
    asked = dealt(rows.filter(queries), n_queries, per_task, "ask").groupBy("ask").agg(F.collect_list(F.struct("vec_id", "row", "q")).alias("asked"))
    left = posted.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(key: tuple, segments: pa.Table, questions: pa.Table) -> pa.Table:
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if segments.num_rows and questions.num_rows:
            own = Block(segments)
            for group in questions.column("asked").to_pylist():
                for question in group:
                    for score, place in own.search(np.array(question["q"], np.int64), question["row"], k):
                        found = own.vec_id[place]
                        for name, value in (("query_row", question["row"]), ("query_id", question["vec_id"]), ("vec_id", None if found == math.inf else found), ("score", score)):
                            out[name].append(value)
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})

    near = left.groupBy("block", "ask").cogroup(right.groupBy("block", "ask")).applyInArrow(meet, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").isNull().alias("u"), "vec_id"))), 1, k)
    return near.groupBy("query_row", "query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
