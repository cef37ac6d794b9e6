"""Mixing sources to target weights: repetition rates per source, whole copies plus one hash-seeded Bernoulli copy.

Sizes are counted in words.  A source's target follows its weight but stops at ``most`` times its size; what is cut off
is shared again among the others by weight.  A document is taken floor(rate) times, and once more with a probability
equal to the fraction of the rate, decided by a hash of its doc_id, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source of size 0 has
target 0 and rate 0; an empty table gives an empty one; repeated rows draw alike; other columns pass unchanged, and
none of them is read.  Only the table of sources, one row each, meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanframe.llm.common import WORD, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5            # of all words
MOST = 2.0             # times a source's size
SEED = "mix-1"
DRAW = 1 << 52         # a draw is 13 hexadecimal digits
BROADCAST_ROWS = 100_000


def word_count(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def draw(key: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the MD5 of the key; a null key counts as ''."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(DRAW))


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Targets of sources from (source, source_size): water is poured by weight until a source is full at ``most`` times its size.

    With the sources in the order in which they fill, the level at which exactly the first k are full is what is left of
    the total over the weight that is left; the first k whose next source is not full by then settles all targets.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % n
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank + 1).cast("int")))
    w = w.withColumn("cap", F.lit(most) * F.col("source_size").cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = w.withColumns({
        "total": F.lit(share) * F.sum("source_size").over(everything).cast("double"),
        "full": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(rest),
        "place": F.row_number().over(fill),
    })
    w = w.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    settles = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    w = w.withColumn("level", F.min(settles).over(everything)["level"])
    target = F.round(F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))), 6)
    return w.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: float = MOST,
             seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, source, text and more) with mix_size, mix_source_size, mix_target and mix_copies."""
    sized = docs.withColumn("mix_size", word_count("text"))
    sums = docs.select("source", word_count("text").alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    goal = source_targets(sums, share, weights, most).select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    goal = stored(goal)
    if goal.count() <= BROADCAST_ROWS:      # else the shuffled join, whose hot keys the skew join splits
        goal = F.broadcast(goal)
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw("doc_id", seed) < rate - F.floor(rate), 1).otherwise(0)
    joined = sized.join(goal, F.col("source").eqNullSafe(F.col("mix_source")), "left")
    return joined.withColumn("mix_copies", F.least(copies, F.lit(int(most))).cast("long")).drop("mix_source")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed rows: each document as often as it is taken, with the columns of ``docs``."""
    plan = mix_plan(docs.select("doc_id", "source", "text", F.struct("*").alias("row")), **settings).filter("mix_copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select("row.*")
