"""Evaluation of given labels, predictions and class probabilities.

Every metric takes columns, not a model.  Confusion counts are one aggregate;
ROC metrics work on counts per distinct score.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe.functions.fields import quoted
from loanframe.operators.ordering import ROWS_PER_RANGE, range_bounds, running_sums, take_first, with_range

TOP_SHARE = 0.2


# -------------------------------------------------------------------------- confusion


def confusion_counts(df: DataFrame, y: str, pred: str, keys: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys, quoted(y).cast("int").alias("y"), quoted(pred).cast("int").alias("pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, y: str, pred: str, classes: list[int]) -> DataFrame:
    """Counts for every pair of listed classes, zeros included."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "y int, pred int")
    counts = confusion_counts(df, y, pred)
    return grid.join(counts, ["y", "pred"], "left").select("y", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def class_report(confusion: DataFrame, keys: list[str] = (), classes: list[int] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class of confusion counts.

    Labels are those seen as truth or prediction; ``classes`` adds more.
    """
    as_truth = F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                        F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).cast("bigint").alias("hits"))
    as_guess = F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                        F.lit(0).cast("bigint").alias("hits"))
    rows = confusion.select(*keys, F.explode(F.array(as_truth, as_guess)).alias("r")).select(*keys, "r.*")
    if classes:
        empty = F.explode(F.array(*[F.lit(c) for c in classes]))
        groups = confusion.select(*keys).distinct() if keys else confusion.sparkSession.range(1).select()
        more = groups.select(*keys, empty.alias("label"), *[F.lit(0).cast("bigint").alias(c) for c in ("support", "predicted", "hits")])
        rows = rows.unionByName(more)
    totals = rows.groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("predicted") + F.col("support")), F.lit(0.0))
    return totals.withColumns({"precision": precision, "recall": recall, "f1": f1})


def report_summary(report: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Averages over the classes of a report."""
    n = F.sum("support")
    risk = F.col("label") != 0
    seen = (F.col("support") + F.col("predicted")) > 0
    at_zero = F.col("label") == 0

    def weighted(name):
        return F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), n), F.lit(0.0))

    return report.groupBy(*keys).agg(
        n.alias("n_rows"),
        F.coalesce(F.try_divide(F.sum("hits"), n), F.lit(0.0)).alias("accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        F.avg(F.when(seen, F.col("f1"))).alias("macro_f1"),
        F.avg("f1").alias("report_macro_f1"),
        weighted("f1").alias("weighted_f1"),
        F.coalesce(F.max(F.when(at_zero, F.col("precision"))), F.lit(0.0)).alias("normal_precision"),
        F.coalesce(F.avg(F.when(risk, F.col("recall"))), F.lit(0.0)).alias("risk_recall_mean"),
        F.avg(F.when(risk & (F.col("support") > 0), F.col("recall"))).alias("risk_recall_supported"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.coalesce(F.try_divide(F.max(F.when(at_zero, F.col("predicted"))), n), F.lit(0.0)).alias("predicted_normal_ratio"),
        F.try_divide(F.max("predicted"), n).alias("dominant_prediction_ratio"),
    ).withColumn("f1_gap", F.col("weighted_f1") - F.col("macro_f1"))


def summarize(df: DataFrame, y: str, pred: str, classes: list[int] | None = None, keys: list[str] = ()) -> DataFrame:
    return report_summary(class_report(confusion_counts(df, y, pred, keys), keys, classes), keys)


def degeneration(report: DataFrame) -> DataFrame:
    """Warning signs of a model that has collapsed onto the normal class."""
    signs = report.agg(
        F.array_sort(F.collect_list(F.when(F.col("recall") == 0, F.col("label")))).alias("zero_recall_classes"),
        F.max(F.when(F.col("label") != 0, F.col("recall"))).alias("top_risk_recall"),
    )
    return report_summary(report).crossJoin(F.broadcast(signs)).select(
        F.concat_ws(",", F.col("zero_recall_classes").cast("array<string>")).alias("zero_recall_classes"),
        (F.size("zero_recall_classes") > 0).alias("has_zero_recall"),
        F.coalesce((F.col("predicted_normal_ratio") > 0.9) & (F.col("top_risk_recall") < 0.1), F.lit(False)).alias("lazy_normal"),
        (F.abs("f1_gap") > 0.3).alias("wide_f1_gap"),
    )


# -------------------------------------------------------------------------------- ROC


def _pairs_of(df: DataFrame, items: list[Column], keep: Column | None = None) -> DataFrame:
    rows = df.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    return rows.where(keep) if keep is not None else rows


def _score_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "score").agg(F.sum("hit").alias("pos"), F.count("*").alias("n"))


def _curve(rows: DataFrame, keys: list[str], rows_per_range: int) -> DataFrame:
    """Counts per distinct score with running sums by falling score."""
    counts = _score_counts(rows, keys)
    bounds = range_bounds(rows, "score", rows.count(), rows_per_range)
    ranked = running_sums(counts, keys, "score", {"cum_pos": "pos", "cum_n": "n"}, bounds, descending=True)
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("all_pos"), F.sum("n").alias("all_n"))
    # keys are classes or class pairs, so this side has a handful of rows
    return ranked.join(F.broadcast(totals), keys)


def _hit(is_hit: Column) -> Column:
    return F.when(is_hit, 1).otherwise(0).cast("bigint")


def class_scores(df: DataFrame, y: str, probs: list[str], classes: list[int], extra: list[str] = ()) -> DataFrame:
    """One row per loan and class: score and whether the loan has that class."""
    items = [
        F.struct(*[quoted(e).alias(e) for e in extra], F.lit(c).alias("label"), quoted(p).cast("double").alias("score"),
                 _hit(quoted(y) == c).alias("hit"))
        for p, c in zip(probs, classes)
    ]
    return _pairs_of(df, items)


def _auc() -> Column:
    neg = F.col("n") - F.col("pos")
    area = F.sum(neg.cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0))
    pairs = F.max("all_pos").cast("double") * F.max(F.col("all_n") - F.col("all_pos"))
    return F.try_divide(area, pairs)


def rank_metrics(
    df: DataFrame, y: str, probs: list[str], classes: list[int], rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One-vs-rest AUC and KS per class, NULL where one side is empty.

    Above ``rows_per_range`` rows the distinct scores are cut into ranges that
    are summed in parallel.
    """
    curve = _curve(class_scores(df, y, probs, classes), ["label"], rows_per_range)
    return curve.groupBy("label").agg(_auc().alias("auc"), _ks().alias("ks"))


def _ks() -> Column:
    gap = F.try_divide("cum_pos", "all_pos") - F.try_divide(
        F.col("cum_n") - F.col("cum_pos"), F.col("all_n") - F.col("all_pos")
    )
    both = (F.max("all_pos") > 0) & (F.max("all_pos") < F.max("all_n"))
    return F.when(both, F.greatest(F.max(gap), F.lit(0.0)))


def pair_auc(
    df: DataFrame, y: str, probs: list[str], classes: list[int], rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One-vs-one AUC of every class pair with the rows of the pair."""
    items = []
    for (pa, a), (pb, b) in combinations(list(zip(probs, classes)), 2):
        for p, c in ((pa, a), (pb, b)):
            items.append(F.struct(
                quoted(y).cast("int").alias("truth"), F.lit(a).alias("left"), F.lit(b).alias("right"), F.lit(c).alias("side"),
                quoted(p).cast("double").alias("score"), _hit(quoted(y) == c).alias("hit"),
            ))
    rows = _pairs_of(df, items, (F.col("truth") == F.col("left")) | (F.col("truth") == F.col("right")))
    curve = _curve(rows.drop("truth"), ["left", "right", "side"], rows_per_range)
    per_side = curve.groupBy("left", "right", "side").agg(_auc().alias("auc"), F.max("all_n").alias("n_pair"))
    return per_side.groupBy("left", "right").agg(F.avg("auc").alias("auc"), F.max("n_pair").alias("n_pair"))


def ovo_auc(
    df: DataFrame, y: str, probs: list[str], classes: list[int], rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Mean one-vs-one AUC, plain and weighted by the rows of each pair."""
    if len(classes) == 2:
        one = rank_metrics(df, y, probs, classes, rows_per_range).where(F.col("label") == classes[1])
        return one.select(F.col("auc").alias("auc_ovo_macro"), F.col("auc").alias("auc_ovo_weighted"))
    return pair_auc(df, y, probs, classes, rows_per_range).agg(
        F.avg("auc").alias("auc_ovo_macro"),
        F.try_divide(F.sum(F.col("auc") * F.col("n_pair")), F.sum("n_pair")).alias("auc_ovo_weighted"),
    )


def pair_curves(
    df: DataFrame, y: str, probs: list[str], classes: list[int], rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """ROC points per class pair for the share of the right class in the pair."""
    items = []
    for (pa, a), (pb, b) in combinations(list(zip(probs, classes)), 2):
        share = quoted(pb) / F.greatest(quoted(pa) + quoted(pb), F.lit(1e-12))
        items.append(F.struct(
            quoted(y).cast("int").alias("truth"), F.lit(a).alias("left"), F.lit(b).alias("right"),
            share.alias("score"), _hit(quoted(y) == b).alias("hit"),
        ))
    rows = _pairs_of(df, items, (F.col("truth") == F.col("left")) | (F.col("truth") == F.col("right")))
    curve = _curve(rows.drop("truth"), ["left", "right"], rows_per_range)
    return curve.where((F.col("all_pos") > 0) & (F.col("all_pos") < F.col("all_n"))).select(
        "left", "right", "score", "pos", "n", "all_pos", "all_n", "cum_pos", "cum_n",
        F.try_divide(F.col("cum_n") - F.col("cum_pos"), F.col("all_n") - F.col("all_pos")).alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )


def _edge(share: float) -> Column:
    """The score at which the top share of rows ends, with the counts there."""
    top = F.greatest(F.floor(F.col("all_n") * F.lit(float(share))), F.lit(1))
    before = F.col("cum_n") - F.col("n")
    at_edge = (before < top) & (F.col("cum_n") >= top)
    return F.max(F.when(at_edge, F.struct(
        "score", "pos", "n", (F.col("cum_pos") - F.col("pos")).alias("pos_before"), (top - before).alias("quota"), "all_pos",
    )))


def _captured(df: DataFrame, y: str, probs: list[str], classes: list[int], key: str, edges: dict, rows_per_range: int) -> dict[int, int]:
    """Rows of each class above the edge, plus those of the edge score that
    come first by key."""
    found, open_edges = {}, []
    for label, e in edges.items():
        if e["quota"] == e["n"] or e["pos"] in (0, e["n"]):
            share = 0 if e["pos"] == 0 else e["quota"] if e["pos"] == e["n"] else e["pos"]
            found[label] = e["pos_before"] + share
        else:
            open_edges.append((label, e["score"], e["quota"]))
    if open_edges:
        # one row per class
        edge = df.sparkSession.createDataFrame(open_edges, "label int, edge_score double, quota bigint")
        rows = class_scores(df, y, probs, classes, [key])
        tied = rows.join(F.broadcast(edge.drop("quota")), "label").where(F.col("score") == F.col("edge_score"))
        bounds = range_bounds(df, key, df.count(), rows_per_range)
        taken = take_first(with_range(tied, key, bounds), ["label"], edge, "range_no", [key])
        hits = {r["label"]: r["hits"] for r in taken.groupBy("label").agg(F.sum("hit").alias("hits")).collect()}
        found.update({label: edges[label]["pos_before"] + hits.get(label, 0) for label, _, _ in open_edges})
    return found


CAPTURE_SCHEMA = "label int, n_class bigint, n_captured bigint, capture double"


def bad_capture(
    df: DataFrame, y: str, probs: list[str], classes: list[int], key: str = "id",
    share: float = TOP_SHARE, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Part of each class found in the top share of rows by its score.

    Equal scores are taken in key order.  The score at the edge comes from
    running sums over distinct scores; only rows with exactly that score are
    looked at again, however many they are, by ranges of the key.
    """
    curve = _curve(class_scores(df, y, probs, classes), ["label"], rows_per_range)
    edges = {r["label"]: r["edge"] for r in curve.groupBy("label").agg(_edge(share).alias("edge")).collect()}
    found = _captured(df, y, probs, classes, key, edges, rows_per_range)
    rows = [
        (label, e["all_pos"], found[label], found[label] / e["all_pos"] if e["all_pos"] else None)
        for label, e in edges.items()
    ]
    return df.sparkSession.createDataFrame(rows, CAPTURE_SCHEMA)


METRIC_SCHEMA = "model string, scope string, label int, metric string, value double"


def diagnose(
    df: DataFrame, y: str, pred: str, probs: list[str], classes: list[int], key: str = "id",
    model: str = "model", rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """All classification metrics as (model, scope, label, metric, value) rows.

    The scored columns are kept while the metrics are computed, so that a model
    runs once.  The result has a few dozen rows.
    """
    slim = df.select(quoted(key), quoted(y), quoted(pred), *[quoted(p) for p in probs]).persist()
    report = class_report(confusion_counts(slim, y, pred), classes=classes)
    curve = _curve(class_scores(slim, y, probs, classes), ["label"], rows_per_range)
    ranks = curve.groupBy("label").agg(_auc().alias("auc"), _ks().alias("ks"), _edge(TOP_SHARE).alias("edge")).collect()
    edges = {r["label"]: r["edge"] for r in ranks}
    found = _captured(slim, y, probs, classes, key, edges, rows_per_range)
    capture = [
        {"label": c, "capture": found[c] / e["all_pos"] if e["all_pos"] else None} for c, e in edges.items()
    ]
    pairs = ovo_auc(slim, y, probs, classes, rows_per_range).first()
    per_class, overall = report.collect(), report_summary(report).first()
    slim.unpersist()

    rows = []
    for part, names in (
        (per_class, ["precision", "recall", "f1", "support", "predicted"]), (ranks, ["auc", "ks"]), (capture, ["capture"]),
    ):
        rows += [(model, "class", r["label"], n, r[n]) for r in part for n in names]
    rows += [(model, "all", None, n, v) for n, v in overall.asDict().items() if n != "n_rows"]
    rows += [(model, "all", None, n, v) for n, v in pairs.asDict().items()]
    for part, name in ((ranks, "auc"), (ranks, "ks"), (capture, "capture")):
        known = [r[name] for r in part if r[name] is not None]
        rows.append((model, "all", None, f"{name}_mean", sum(known) / len(known) if known else None))
    tidy = [(m, s, lab, n, None if v is None else float(v)) for m, s, lab, n, v in rows]
    return df.sparkSession.createDataFrame(tidy, METRIC_SCHEMA)


def headline(metrics: DataFrame) -> dict[str, float | None]:
    """The overall values of a metric table by name (a few dozen)."""
    rows = metrics.where(F.col("scope") == "all").collect()
    return {r["metric"]: r["value"] for r in rows}


def align_probabilities(probs: Column, own: list[int], wanted: list[int]) -> Column:
    """Probability array over ``wanted`` classes, zero for unknown ones."""
    return F.array(*[
        F.coalesce(F.try_element_at(probs, F.lit(own.index(c) + 1)), F.lit(0.0)) if c in own else F.lit(0.0)
        for c in wanted
    ])


def rank_models(results: DataFrame, metrics: list[str] = ("macro_f1", "high_risk_recall", "normal_precision"), name: str = "model") -> DataFrame:
    """Model rows from best to worst by the metrics in turn, then by name."""
    return results.orderBy(*[F.desc(F.round(m, 9)) for m in metrics], F.asc(name))


# ------------------------------------------------------------------------- regression


def regression_metrics(df: DataFrame, y: str, pred: str, keys: list[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (over targets away from zero) in one aggregate."""
    base = df.select(*keys, quoted(y).cast("double").alias("y"), quoted(pred).cast("double").alias("p"))
    err = F.col("y") - F.col("p")
    away = F.abs("y") > 1e-8
    sums = base.groupBy(*keys).agg(
        F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"), F.var_pop("y").alias("var"),
        F.avg(F.when(away, F.abs(F.try_divide(err, F.col("y"))))).alias("mape"),
    )
    flat = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return sums.select(
        *keys, "mae", F.sqrt("mse").alias("rmse"),
        F.when(F.col("var") > 0, 1.0 - F.try_divide("mse", "var")).otherwise(flat).alias("r2"),
        F.coalesce("mape", F.lit(0.0)).alias("mape"),
    )


def residual_histogram(df: DataFrame, y: str, pred: str, bins: int = 30) -> DataFrame:
    """Counts of ``pred - y`` in equal bins over their range, the last one closed."""
    residual = df.select((quoted(pred).cast("double") - quoted(y).cast("double")).alias("e"))
    span = residual.agg(F.min("e").alias("lo"), F.max("e").alias("hi"))
    span = span.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.least(F.floor((F.col("e") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = residual.crossJoin(F.broadcast(span)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = span.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return every.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def name_counts(df: DataFrame, column: str, missing: str) -> DataFrame:
    return df.groupBy(F.coalesce(quoted(column), F.lit(missing)).alias("risk_level")).agg(F.count("*").alias("n"))


def mean_abs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean absolute value per column, in long form."""
    sums = df.agg(*[F.avg(F.abs(quoted(c))).alias(f"m{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("value")) for i, c in enumerate(columns)]))
    return sums.select(rows.alias("r")).select("r.*")
