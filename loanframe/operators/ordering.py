"""Exact order-based results without sorting a whole group in one task.

Ranks, quantiles, running sums and seeded samples all need a global order.
A window over a group gives it, but puts the group into one task.  The
operators here first count rows in ranges of the order (a small aggregate with
map-side combine), settle everything the counts already decide, and look at
single rows only inside the one range that is left.
"""

from __future__ import annotations

import math
import re
import sys
import tempfile

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanframe.functions.fields import quoted, shuffle_key

RANGES = 2048            # ranges per refinement pass
SKETCH = 10_000          # accuracy of the sketch that brackets quantiles: ranks are off by a 10 000th of the rows
LEAF_VALUES = 50_000     # distinct values that may be finished in one task
ROWS_PER_RANGE = 1_000_000
SMALL_TABLE = 200_000    # rows up to which a lookup table is broadcast


def checkpoint_folder(spark: SparkSession) -> None:
    """Checkpoints go to the folder that the session names in ``spark.checkpoint.dir``.

    A session on one machine that names none, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = folder or tempfile.mkdtemp(prefix="loanframe-checkpoint-")
        context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def spread_out(df: DataFrame) -> DataFrame:
    """The rows of a stored table in at least as many partitions as there are cores.

    A partition of a file without a row group of its own is empty, so all rows of a small file come in one or two tasks, and
    whatever is computed from them row by row would stay there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt_out(df: DataFrame) -> DataFrame:
    """A persisted table whose rows lie in at least as many partitions as there are cores, itself persisted.

    A table from one small file has one partition, and whatever follows would run in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    spread = df.repartition(cores).persist()
    spread.count()
    df.unpersist()
    return spread


def small_side(df: DataFrame, limit: int = SMALL_TABLE) -> DataFrame:
    """Broadcast hint when the table is proven small, the table as is otherwise."""
    seen = df.limit(limit + 1).count()
    return F.broadcast(df) if seen <= limit else df


# ------------------------------------------------------------------- order statistics


def _scale(x: Column) -> Column:
    """Weakly increasing compression, so heavy tails do not fill one range."""
    return F.signum(x) * F.log1p(F.abs(x))


def _range_number(value: Column, low: Column, high: Column, exact_type: str) -> Column:
    """Weakly increasing range number of ``value`` between ``low`` and ``high``.

    An infinity has the first or the last range to itself, so a pass always parts it from the finite values.
    """
    endless, largest = F.lit(math.inf), F.lit(sys.float_info.max)
    whole = [c.cast("double") for c in (value, low, high)]
    as_double = [F.greatest(F.least(c, largest), -largest) for c in whole]
    near = (F.signum(as_double[1]) == F.signum(as_double[2])) & (
        F.greatest(*[F.abs(c) for c in as_double[1:]])
        < 2 * F.least(*[F.abs(c) for c in as_double[1:]])
    )
    if exact_type == "bigint":
        straight = F.try_divide((value - low).cast("double"), (high - low).cast("double"))
    else:
        straight = F.try_divide(as_double[0] - as_double[1], as_double[2] - as_double[1])
    v, lo, hi = [_scale(c) for c in as_double]
    curved = F.try_divide(v - lo, hi - lo)
    share = F.coalesce(F.when(near, straight).otherwise(curved), straight, F.lit(0.0))
    first = F.when(whole[1] == -endless, 1).otherwise(0)
    last = F.when(whole[2] == endless, RANGES - 2).otherwise(RANGES - 1)
    finite = F.least(F.greatest(F.floor(share * RANGES), first), last).cast("int")
    return F.when(whole[0] == -endless, 0).when(whole[0] == endless, RANGES - 1).otherwise(finite)


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: list[tuple],
    group: str | None = None,
    leaf_values: int = LEAF_VALUES,
) -> dict[tuple, object]:
    """Exact values at zero-based ``ranks`` of ``value`` (NULLs ignored).

    ``ranks`` holds ``(group key, rank)`` pairs; the key is ``None`` without a
    ``group`` column.  Every pass counts rows per range for all open targets at
    once and keeps one range per target.  The driver sees at most
    targets x ranges counts per pass.
    """
    spark = df.sparkSession
    kind = df.schema[value].dataType
    exact = "bigint" if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)) else "double"
    base = df.where(quoted(value).isNotNull()).select(
        (quoted(group) if group else F.lit(0)).alias("g"), quoted(value).cast(exact).alias("v")
    )
    group_type = base.schema["g"].dataType
    if not ranks:
        return {}
    keys = sorted({g for g, _ in ranks if g is not None}, key=str)
    if group:
        base = base.where(F.col("g").isin(keys))

    spans = {
        r["g"]: (r["lo"], r["hi"], r["n"])
        for r in base.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect()
    }
    answers: dict[tuple, object] = {}
    open_targets = []
    for g, rank in dict.fromkeys(ranks):
        span = spans.get(g if group else 0)
        if span is None or not 0 <= rank < span[2]:
            raise ValueError(f"rank {rank} is outside group {g}")
        open_targets.append((g, rank, *span, rank))  # key, rank, lo, hi, n inside, rank inside

    bracket_schema = T.StructType([
        T.StructField("t", T.IntegerType()), T.StructField("tg", group_type),
        T.StructField("lo", T.LongType() if exact == "bigint" else T.DoubleType()),
        T.StructField("hi", T.LongType() if exact == "bigint" else T.DoubleType()),
        T.StructField("leaf", T.BooleanType()),
    ])
    while open_targets:
        still = []
        for target in open_targets:
            if target[2] == target[3]:
                answers[(target[0], target[1])] = target[2]
            else:
                still.append(target)
        if not still:
            break
        brackets = spark.createDataFrame(
            [(i, t[0] if group else 0, t[2], t[3], t[4] <= leaf_values) for i, t in enumerate(still)],
            bracket_schema,
        )
        inside = base.join(
            F.broadcast(brackets), (F.col("g") == F.col("tg")) & F.col("v").between(F.col("lo"), F.col("hi"))
        )
        # a target with few rows left is finished by its distinct values
        part = F.when(F.col("leaf"), F.col("v")).otherwise(F.lit(None))
        number = F.when(F.col("leaf"), 0).otherwise(_range_number(F.col("v"), F.col("lo"), F.col("hi"), exact))
        counted = inside.groupBy("t", number.alias("b"), part.alias("p")).agg(
            F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        ).collect()
        per_target: dict[int, list] = {}
        for row in counted:
            per_target.setdefault(row["t"], []).append(row)
        open_targets = []
        for i, (g, rank, _, _, _, inner) in enumerate(still):
            before = 0
            for row in sorted(per_target[i], key=lambda r: r["lo"]):
                if inner < before + row["n"]:
                    if (row["lo"], row["hi"], row["n"]) == still[i][2:5]:
                        raise ValueError(f"the values of {value} between {row['lo']} and {row['hi']} have no order")
                    open_targets.append((g, rank, row["lo"], row["hi"], row["n"], inner - before))
                    break
                before += row["n"]
    return answers


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    shares: list[float],
    max_values: int = 5_000_000,
    min_rows: int = 1,
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of several columns, all columns together.

    A mergeable sketch brackets every wanted rank in one scan.  A second one counts the rows below and inside each bracket,
    a third keeps the values inside, merged map-side: a few ten-thousandths of the rows per bracket.  What the counts prove
    is exact, whatever the sketch; a bracket that misses its rank, or holds over ``max_values`` rows, is narrowed down range
    by range instead.  A column with fewer than ``min_rows`` values gives ``None``.
    """
    if not columns:
        return {}
    value = [quoted(c).cast("double") for c in columns]
    ends = [min(1.0, max(0.0, s + side * 2.0 / SKETCH)) for s in shares for side in (-1, 1)]
    seen = df.agg(*[f.alias(f"{tag}{i}") for i, v in enumerate(value) for tag, f in (
        ("n", F.count(v)), ("a", F.min(v)), ("z", F.max(v)), ("q", F.percentile_approx(v, F.array(*[F.lit(e) for e in ends]), F.lit(SKETCH))))]).first()
    out: dict[str, list[float] | None] = {c: None for i, c in enumerate(columns) if seen[f"n{i}"] < max(1, min_rows)}
    brackets = []
    for i, c in enumerate(columns):
        for j, s in enumerate(shares if c not in out else []):
            n = seen[f"n{i}"]
            whole = n <= 2 * SKETCH                                   # the slack of the sketch is less than a rank or so
            low = seen[f"a{i}"] if whole or ends[2 * j] <= 0 else seen[f"q{i}"][2 * j]
            high = seen[f"z{i}"] if whole or ends[2 * j + 1] >= 1 else seen[f"q{i}"][2 * j + 1]
            brackets.append((i, j, low, high, s * (n - 1)))
    found: dict[tuple[int, int], float] = {}
    if brackets:
        parts = list(dict.fromkeys((i, low, high) for i, _, low, high, _ in brackets))     # shares of a small column have one
        counts = df.agg(*[f.alias(f"{tag}{k}") for k, (i, low, high) in enumerate(parts) for tag, f in (
            ("b", F.count_if(value[i] < F.lit(low))), ("m", F.count_if((value[i] >= F.lit(low)) & (value[i] <= F.lit(high)))))]).first()
        ranks: dict[int, set[int]] = {}
        for i, j, low, high, position in brackets:
            k = parts.index((i, low, high))
            for r in {math.floor(position), math.ceil(position)}:
                if counts[f"b{k}"] <= r < counts[f"b{k}"] + counts[f"m{k}"] and counts[f"m{k}"] <= max_values:
                    ranks.setdefault(k, set()).add(r)
        found = _values_at(df, value, parts, {k: (counts[f"b{k}"], sorted(r)) for k, r in ranks.items()})
    for i, c in enumerate(columns):
        if c in out:
            continue
        positions = [s * (seen[f"n{i}"] - 1) for s in shares]
        wanted = sorted({r for p in positions for r in (math.floor(p), math.ceil(p))})
        missing = [(None, r) for r in wanted if (i, r) not in found]
        for (_, r), v in (order_statistics(df, c, missing) if missing else {}).items():
            found[i, r] = float(v)
        values = []
        for p in positions:
            low, high = math.floor(p), math.ceil(p)
            a, b = found[i, low], found[i, high]
            values.append(a if low == high or a == b else (high - p) * a + (p - low) * b)
        out[c] = values
    return {c: out[c] for c in columns}


def _values_at(df: DataFrame, value: list[Column], parts: list[tuple], ranks: dict[int, tuple[int, list[int]]]) -> dict[tuple[int, int], float]:
    """The values at the wanted ranks of each bracket (column, lowest, highest value): {(column, rank): value}.

    ``ranks`` has per bracket the rows below it and the ranks.
    """
    if not ranks:
        return {}
    spark = df.sparkSession
    inside = F.filter(F.array(*[
        F.when((value[parts[k][0]] >= F.lit(parts[k][1])) & (value[parts[k][0]] <= F.lit(parts[k][2])), F.struct(F.lit(k).alias("k"), value[parts[k][0]].alias("v")))
        for k in ranks
    ]), lambda x: x.isNotNull())
    merged = df.select(F.explode(inside).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n"))
    wanted = spark.createDataFrame([(k, r, r - before) for k, (before, own) in ranks.items() for r in own], "k int, r bigint, inner bigint")
    so_far = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = merged.withColumn("upto", F.sum("n").over(so_far))
    # as many rows as ranks: a few per column
    hit = totals.join(F.broadcast(wanted), "k").where((F.col("inner") < F.col("upto")) & (F.col("inner") >= F.col("upto") - F.col("n")))
    return {(parts[r["k"]][0], r["r"]): float(r["v"]) for r in hit.select("k", "r", "v").collect()}


# ----------------------------------------------------------------------- running sums


def range_bounds(df: DataFrame, value: str, n_rows: int, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Inner bounds that cut ``value`` into ranges of about equal row counts."""
    parts = math.ceil(n_rows / rows_per_range)
    if parts <= 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(quoted(value).cast("double"), F.array(*[F.lit(s) for s in shares]), F.lit(10 * parts))).first()
    return sorted(set(row[0] or []))


def with_range(df: DataFrame, value: str, bounds: list[float], out: str = "range_no") -> DataFrame:
    """Number of the range a value falls into; equal values share a range."""
    if not bounds:
        return df.withColumn(out, F.lit(0.0))
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="__v", outputCol=out, handleInvalid="keep")
    return cut.transform(df.withColumn("__v", quoted(value).cast("double"))).drop("__v")


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, str],
    bounds: list[float],
    descending: bool = False,
) -> DataFrame:
    """Running totals of ``sums`` (output name -> column) per ``keys``.

    The rows must be distinct in ``keys`` and ``order``.  With bounds, totals
    per range are summed first (at most keys x ranges rows), then each range is
    summed on its own, so no task holds more than one range.
    """
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    if not bounds:
        w = Window.partitionBy(*keys).orderBy(way(order))
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({o: F.sum(c).over(w) for o, c in sums.items()})
    ranged = with_range(df, order, bounds)
    totals = ranged.groupBy(*keys, "range_no").agg(*[F.sum(c).alias(f"__t_{o}") for o, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(way("range_no")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "range_no",
        *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__o_{o}") for o in sums],
    )
    inner = Window.partitionBy(*keys, "range_no").orderBy(way(order))
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(offsets, [*keys, "range_no"])
    return joined.withColumns({
        o: F.sum(c).over(inner) + F.col(f"__o_{o}") for o, c in sums.items()
    }).drop("range_no", *[f"__o_{o}" for o in sums])


# --------------------------------------------------------------------- seeded samples


def quota_edges(df: DataFrame, strata: list[str], quotas: DataFrame, bucket: str) -> DataFrame:
    """Per stratum the bucket in which its quota ends, and the rows to take there."""
    counts = df.groupBy(*strata, bucket).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*strata).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.join(quotas.select(*strata, "quota"), strata)
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("before", F.col("upto") - F.col("n"))
        .where(F.col("before") < F.col("quota"))
        .groupBy(*strata)
        .agg(F.max(bucket).alias("edge"), F.max_by(F.col("quota") - F.col("before"), bucket).alias("edge_rows"))
    )


def rows_up_to_edge(df: DataFrame, strata: list[str], edges: DataFrame, bucket: str, order: list[str], always: Column | None = None) -> DataFrame:
    """Rows in buckets before the edge of their stratum and the first rows at it.

    Rows for which ``always`` holds are kept as well.  Only edge buckets are
    ranked.
    """
    marked = df.join(small_side(edges), strata, "inner" if always is None else "left")
    sampled = F.lit(True) if always is None else ~always
    inside = F.col(bucket) < F.col("edge")
    inside = marked.where(inside if always is None else always | inside)
    at_edge = marked.where(sampled & (F.col(bucket) == F.col("edge")))
    rank = F.row_number().over(Window.partitionBy(*strata, bucket).orderBy(*order))
    at_edge = at_edge.withColumn("__r", rank).where(F.col("__r") <= F.col("edge_rows")).drop("__r")
    return inside.unionByName(at_edge).drop("edge", "edge_rows")


def take_first(df: DataFrame, strata: list[str], quotas: DataFrame, bucket: str, order: list[str]) -> DataFrame:
    """Per stratum the first ``quota`` rows in the order of ``order``.

    ``bucket`` must not decrease along that order, and ``quotas`` has one row
    per stratum.  Rows are counted per stratum and bucket; buckets wholly
    inside the quota pass without a sort and only the bucket on the edge of
    each stratum is ranked.
    """
    return rows_up_to_edge(df, strata, quota_edges(df, strata, quotas, bucket), bucket, order)


def bucket_digits(n_rows: int, rows_per_bucket: int = ROWS_PER_RANGE) -> int:
    """Hexadecimal digits that leave a bucket of ``n_rows`` rows about ``rows_per_bucket`` of them at most."""
    return max(3, math.ceil(math.log(max(1, n_rows) / rows_per_bucket, 16)))


def dealt(df: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    """Adds the shuffle key ``__h`` and its leading ``digits`` as ``__b``; the order is that of the whole key."""
    return df.withColumn("__h", shuffle_key(quoted(key), seed)).withColumn("__b", F.substring("__h", 1, digits))


def take_by_quota(df: DataFrame, strata: str, quotas: DataFrame, key: str, seed: int) -> DataFrame:
    """Per stratum the ``quota`` rows that come first in a seeded shuffle."""
    digits = bucket_digits(df.select(F.lit(1)).count())
    return take_first(dealt(df, key, seed, digits), [strata], quotas, "__b", ["__h", key]).drop("__h", "__b")


def random_sample(df: DataFrame, limit: int | None, seed: int, key: str = "id") -> DataFrame:
    """The first ``limit`` rows of a seeded shuffle; no limit keeps all rows."""
    if limit is None or limit <= 0:
        return df
    spark = df.sparkSession
    quota = spark.createDataFrame([(0, int(limit))], "__all int, quota bigint")
    return take_by_quota(df.withColumn("__all", F.lit(0)), "__all", quota, key, seed).drop("__all")
