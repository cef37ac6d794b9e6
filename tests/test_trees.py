"""Tree learners against plain versions that look at every cut of every node."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanframe.operators.blocks import binned, feature_cuts, make_blocks
from loanframe.operators.boosting import BUNDLE, Fit, bundled, bundles, fit_boosted, node_histograms, rows_histogram, walked
from loanframe.operators import forest
from loanframe.operators.spread_forest import SpreadForest
from loanframe.operators.forest import Forest, fit_forest, forest_gains, gini_gain, grow
from loanframe.operators.treemodel import TreeModel

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(900, 3)), 1)
    x[:, 2] = rng.integers(0, 2, 900)
    y = ((x[:, 0] + 0.3 * rng.normal(size=900) > 0).astype(int) + (x[:, 1] * (x[:, 2] + 0.5) > 0.4)).astype(int)
    fold = np.arange(900) % 3
    df = spark.createDataFrame([(*map(float, r), int(c), int(f)) for r, c, f in zip(x, y, fold)], "a double, b double, c double, y int, fold int").repartition(3)
    blocks = make_blocks(df, COLUMNS, F.col("y"), F.col("fold"), rows_per_block=128)
    yield x, y, fold, df, blocks
    blocks.release()


def test_cuts_part_values_evenly():
    assert feature_cuts(np.array([1.0, 2.0, 2.0, np.nan, 4.0])).tolist() == [1.5, 3.0] and len(feature_cuts(np.array([np.nan]))) == 0
    many = feature_cuts(np.arange(10_000.0) ** 2)
    x = binned([np.arange(10_000.0) ** 2], [many])[0]
    assert len(many) <= 254 and np.bincount(x).max() <= 45 and (np.diff(x.astype(int)) >= 0).all()
    near = np.array([1.0, np.nextafter(1.0, 2)])
    assert binned([near], [feature_cuts(near)])[0].tolist() == [0, 1]


def plain_boosted(x, y, w, used_of, fit, rounds):
    """Second-order boosting, leaf by leaf, each split found by trying every value."""
    k, n = fit.n_out, len(y)
    if fit.loss == "squared":
        init = np.array([(w * y).sum() / w.sum()])
    else:
        p = np.bincount(y, w, fit.n_classes) / w.sum()
        init = np.zeros(k) if not fit.start_at_mean else np.array([np.log(p[1] / p[0])]) if fit.loss == "logistic" else np.log(p)
    margin = np.tile(init, (n, 1)).astype(float)
    for r in range(rounds):
        if fit.loss == "squared":
            g, h = (w * (margin[:, 0] - y))[:, None], w[:, None].astype(float)
        elif fit.loss == "logistic":
            p = 1 / (1 + np.exp(-margin[:, 0]))
            g, h = (w * (p - y))[:, None], (w * p * (1 - p))[:, None]
        else:
            e = np.exp(margin - margin.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            factor = fit.n_classes / (fit.n_classes - 1) if fit.start_at_mean else 2.0
            g, h = w[:, None] * (p - (y[:, None] == np.arange(k))), w[:, None] * factor * p * (1 - p)
        used = used_of(r)
        step = np.zeros_like(margin)
        for o in range(k):
            score = lambda m: g[m, o].sum() ** 2 / (h[m, o].sum() + fit.penalty)

            def best(mask):
                found, inside = None, mask & used
                for f in range(x.shape[1]):
                    for v in np.unique(x[:, f])[:-1]:
                        left, right = inside & (x[:, f] <= v), inside & (x[:, f] > v)
                        if min(left.sum(), right.sum()) < fit.least_rows or min(h[left, o].sum(), h[right, o].sum()) < fit.least_hessian:
                            continue
                        gain = score(left) + score(right) - score(inside)
                        if gain > 1e-10 and (found is None or gain > found[0] + 1e-9):
                            found = (gain, f, v)
                return found

            leaves = [(np.ones(n, bool), 0, best(np.ones(n, bool)))]
            while fit.leaves is None or len(leaves) < fit.leaves:
                open_ = [i for i, (_, d, s) in enumerate(leaves) if s and d < fit.depth]
                if not open_:
                    break
                i = max(open_, key=lambda i: leaves[i][2][0])
                mask, d, (_, f, v) = leaves.pop(i)
                for side in (mask & (x[:, f] <= v), mask & (x[:, f] > v)):
                    leaves.append((side, d + 1, best(side)))
            for mask, _, _ in leaves:
                m = mask & used
                step[mask, o] = -g[m, o].sum() / (h[m, o].sum() + fit.penalty) * fit.rate
        margin = margin + step
    return margin


@pytest.mark.parametrize("fit", [
    Fit("softmax", 3, rounds=3, depth=4, leaves=6, rate=0.3), Fit("softmax", 3, [1.0, 2.5, 0.5], rounds=2, depth=2, leaves=None, rate=0.3, penalty=1.0, least_rows=1, least_hessian=1.0, start_at_mean=False),
    Fit("logistic", 2, rounds=3, depth=3, leaves=5, relabel=[0, 1, 1]), Fit("squared", rounds=3, depth=5, leaves=9, rate=0.5), Fit("softmax", 3, rounds=2, depth=3, fold_below=2),
    Fit("softmax", 3, rounds=2, depth=3, leaves=4, fold_from=1),
])
def test_boosted_trees_equal_a_plain_version(table, fit):
    x, y, fold, _, blocks = table
    own = np.asarray(fit.relabel)[y] if fit.relabel else y
    w = np.ones(len(y)) if fit.class_weights is None else np.asarray(fit.class_weights)[y]
    w = w * (fold >= (fit.fold_from or 0)) * (fold < (fit.fold_below or 9))
    want = plain_boosted(x, own, w, lambda r: w > 0, fit, fit.rounds)
    for rows in (10**6, 300, 0):                    # whole trees in tasks, only small nodes, passes over all rows alone
        model = fit_boosted(blocks, COLUMNS, [replace(fit, task_rows=rows)])[0]
        np.testing.assert_allclose(model.margins(binned(list(x.T), model.cuts)), want, rtol=1e-9, atol=1e-9)


def test_fits_grow_together_as_alone(table):
    x, _, _, _, blocks = table
    fits = [Fit("softmax", 3, rounds=4, depth=3, row_share=0.7, feature_share=0.7), Fit("softmax", 3, [1.0, 3.0, 1.0], rounds=2, depth=5), Fit("logistic", 2, [0.0, 1.0, 1.0], rounds=3, relabel=[0, 0, 1])]
    cells = binned(list(x.T), blocks.cuts)
    together = fit_boosted(blocks, COLUMNS, fits)
    for fit, model in zip(fits, together):
        np.testing.assert_allclose(model.margins(cells), fit_boosted(blocks, COLUMNS, [fit])[0].margins(cells), rtol=1e-12)
    shorter = fit_boosted(blocks, COLUMNS, [Fit("softmax", 3, rounds=2, depth=3, row_share=0.7, feature_share=0.7)])[0]
    np.testing.assert_allclose(together[0].margins(cells, 2), shorter.margins(cells), rtol=1e-12)


def test_parts_add_up_to_the_margin(spark, table, tmp_path):
    x, _, _, df, blocks = table
    model = fit_boosted(blocks, COLUMNS, [Fit("softmax", 3, rounds=5)])[0]
    cells = binned(list(x.T), model.cuts)
    np.testing.assert_allclose(model.parts(cells).sum(axis=2), model.margins(cells), rtol=1e-9)
    assert abs(model.importance().sum() - 1) < 1e-12
    model.save(str(tmp_path / "m"))
    again = TreeModel.load(str(tmp_path / "m"))
    np.testing.assert_array_equal(again.margins(cells), model.margins(cells))
    scored = df.withColumn("p", again.probability_column(df)).withColumn("parts", model.parts_column(df)).toPandas()
    np.testing.assert_allclose(np.stack(scored["p"]).sum(axis=1), 1.0)
    want = model.margins(binned([scored[c].to_numpy() for c in COLUMNS], model.cuts))
    np.testing.assert_allclose(np.stack(scored["parts"]).reshape(-1, 3, 4).sum(axis=2), want, rtol=1e-9)


def plain_tree(x, y, w, k, depth, least):
    """Leaf shares per row of a tree that looks at every cut; ties go to the first feature in turn, then the lowest cut."""
    shares = np.bincount(y, w, k) / w.sum()
    if depth == 0 or (np.bincount(y, w, k) > 0).sum() < 2 or len(y) < 2 * least:
        return lambda rows: np.tile(shares, (len(rows), 1))
    best = None
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            if min(left.sum(), (~left).sum()) >= least:
                gain = float(gini_gain(np.bincount(y[left], w[left], k), np.bincount(y[~left], w[~left], k)))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, v)
    if best is None:
        return lambda rows: np.tile(shares, (len(rows), 1))
    _, f, v = best
    left = x[:, f] <= v
    low, high = plain_tree(x[left], y[left], w[left], k, depth - 1, least), plain_tree(x[~left], y[~left], w[~left], k, depth - 1, least)
    return lambda rows: np.where((rows[:, f] <= v)[:, None], low(rows), high(rows))


@pytest.mark.parametrize("depth,least", [(1, 1), (3, 1), (3, 20)])
def test_a_tree_equals_a_plain_version(table, depth, least):
    x, y, _, _, blocks = table
    model = fit_forest(blocks, COLUMNS, Forest(3, 1, depth, least, 3, False, [1.0, 2.0, 1.5]))
    w = np.array([1.0, 2.0, 1.5])[y]
    got = model.margins(binned(list(x.T), model.cuts))
    np.testing.assert_allclose(got, plain_tree(x, y, w, 3, depth, least)(x), rtol=1e-9)


def test_unbounded_forest_is_the_same_wherever_nodes_are_finished(table):
    x, y, _, _, blocks = table
    cells = binned(list(x.T), blocks.cuts)
    whole = fit_forest(blocks, COLUMNS, Forest(3, 5))
    for rows in (10**6, 40):
        np.testing.assert_allclose(forest_gains(blocks, 3, Forest(3, 5, task_rows=rows)), whole.importance(), rtol=1e-5)
    for rows in (300, 40, 5):
        other = fit_forest(blocks, COLUMNS, Forest(3, 5, task_rows=rows))
        np.testing.assert_allclose(other.margins(cells), whole.margins(cells))
        np.testing.assert_allclose(other.importance(), whole.importance(), rtol=1e-5)
    single = fit_forest(blocks, COLUMNS, Forest(3, 1, features=3, bootstrap=False))
    pure = single.margins(cells).max(axis=1) == 1
    same = np.array([len({c for v, c in zip(map(tuple, x), y) if v == tuple(r)}) == 1 for r in x])
    np.testing.assert_array_equal(pure, same)          # grown until rows are equal or of one class


def test_a_spread_forest_says_the_same_without_its_nodes_on_the_driver(spark, table, tmp_path, monkeypatch):
    _, _, _, df, blocks = table
    monkeypatch.setattr(forest, "_assembled", None)
    for rows in (10**6, 60):                        # whole trees in tasks, and subtrees below nodes split by passes
        fit = Forest(3, 7, task_rows=rows)
        spread = fit_forest(blocks, COLUMNS, fit, gathered=0)
        assert isinstance(spread, SpreadForest) and (len(spread.uppers[0][0]) > 1) == (rows == 60)
        monkeypatch.undo()
        whole = fit_forest(blocks, COLUMNS, fit)
        np.testing.assert_allclose(spread.importance(), whole.importance(), rtol=1e-5)
        spread.save(str(tmp_path / f"m{rows}"))
        for model in (spread, SpreadForest.load(str(tmp_path / f"m{rows}"))):
            got = model.with_probabilities(df.withColumn("want", whole.probability_column(df))).select("want", "__p", "a").toPandas()
            assert len(got) == 900
            np.testing.assert_allclose(np.stack(got["__p"]), np.stack(got["want"]), rtol=1e-9, atol=1e-12)
    assert forest.GATHERED < 300 * 623_504 * 2      # a forest of 300 trees on so many rows stays spread


def test_grow_on_awkward_rows():
    fit = Forest(2, 1, features=1, bootstrap=False)
    one = grow(np.zeros((2, 4), np.uint8), np.array([0, 1, 0, 1]), np.ones(4), fit, 0, 1, 0)
    assert one["left"].tolist() == [-1] and one["shares"].tolist() == [[0.5, 0.5]]
    xor = np.array([[0, 0, 1, 1], [0, 1, 0, 1]], np.uint8)
    done = grow(xor, np.array([0, 1, 1, 0]), np.ones(4), fit, 0, 1, 0)
    assert (done["left"] < 0).sum() == 4 and set(done["shares"][done["left"] < 0].max(axis=1)) == {1.0}


def test_grow_does_not_depend_on_the_order_of_rows():
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, b, 4000) for b in (250, 2, 7, 2, 90)]).astype(np.uint8)
    y, w = rng.integers(0, 3, 4000), rng.integers(1, 4, 4000) * np.array([0.1, 1 / 3, 2.7])[rng.integers(0, 3, 4000)]
    one, turn = grow(x, y, w, Forest(3), 4, 1, 0), rng.permutation(4000)
    other = grow(x[:, turn], y[turn], w[turn], Forest(3), 4, 1, 0)
    assert all(np.array_equal(one[name], other[name]) for name in one)


def test_rows_of_a_child_lie_together():
    rng = np.random.default_rng(7)
    many, side = np.array([5, 0, 300, 1, 40]), rng.random(346) < 0.4
    order, counts = forest.side_by_side(side, many)
    child = 2 * np.repeat(np.arange(5), many) + side
    np.testing.assert_array_equal(order, np.argsort(child, kind="stable"))
    np.testing.assert_array_equal(counts, np.bincount(child, minlength=10))
    bins, y, w = rng.integers(0, 60, 346), rng.integers(0, 3, 346), rng.integers(1, 9, 346) / 4
    of, at, sums, seen = forest.filled_bins(many, bins, y, w, 3, np.array([60, 60, 60, 60, 20]) + 40)      # sorted, empty, counted, sorted, sorted
    place = np.repeat(np.arange(5), many) * 100 + bins
    np.testing.assert_array_equal(np.sort(of * 100 + at), np.unique(place))
    for o, b, s, n in zip(of, at, sums, seen):
        hit = place == o * 100 + b
        assert n == hit.sum() and s.tolist() == np.bincount(y[hit], w[hit], 3).tolist()


def test_bundled_histograms_equal_those_of_single_features():
    rng = np.random.default_rng(6)
    bins = np.array([2, 255, 2, 6, 2, 256, 1, 14, 2, 2, 2, 2])
    x = np.stack([rng.integers(0, b, 3000) for b in bins]).astype(np.uint8)
    g, h, node, used = rng.normal(size=3000), rng.random(3000), rng.integers(0, 5, 3000), rng.random(3000) < 0.8
    parts = bundles(bins)
    assert sorted(f for p in parts for f in p) == list(range(len(bins))) and len(parts) < len(bins) / 2
    assert all(len(p) == 1 or np.prod(bins[p]) <= BUNDLE for p in parts)
    got = node_histograms(x, g, h, node, used, [1, 3, 4], 5, bins)
    want = np.zeros(got.shape)
    for i, n in enumerate((1, 3, 4)):
        at = 0
        for f, b in enumerate(bins.tolist()):
            rows = (node == n) & used
            want[:, i, at:at + b] = [np.bincount(x[f, rows], v[rows], b) for v in (g, h, np.ones(3000))]
            at += b
    np.testing.assert_allclose(got, want, rtol=1e-10, atol=1e-10)


def test_a_walk_goes_on_from_where_rows_have_been():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 9, (2, 500)).astype(np.uint8)
    small = (np.array([0, 0, 0]), np.array([4, 0, 0]), np.array([1, -1, -1]))
    large = (np.array([0, 0, 1, 0, 0]), np.array([4, 0, 2, 0, 0]), np.array([1, -1, 3, -1, -1]))
    np.testing.assert_array_equal(walked(x, large, walked(x, small)), walked(x, large))


def test_small_tables_are_dealt_out_before_they_are_scored(spark):
    from loanframe.operators.ordering import dealt_out

    one = spark.range(100).coalesce(1).persist()
    cores = spark.sparkContext.defaultParallelism
    spread = dealt_out(one)
    assert spread.rdd.getNumPartitions() >= cores and sorted(r.id for r in spread.collect()) == list(range(100))
    many = spark.range(100).repartition(cores).persist()
    assert dealt_out(many) is many
    spread.unpersist(), many.unpersist()


def test_cores_are_dealt_about_as_many_rows(spark):
    """Blocks of an uneven table go to all cores alike, and those of a partition are few."""
    n = 50_000
    rows = spark.range(0, n, 1, 3).select((F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 5).alias("y"))
    blocks = make_blocks(rows, ["a"], F.col("y"))
    held = blocks.rdd.mapPartitions(lambda part: [[len(b["y"]) for b in part]]).collect()
    whole = sorted((b["x"][0].tobytes(), b["y"].tobytes()) for b in blocks.rdd.collect())
    blocks.release()
    dealt = [sum(p) for p in held]
    assert sum(dealt) == n and max(map(len, held)) == 1
    assert len(dealt) == spark.sparkContext.defaultParallelism and max(dealt) <= 1.35 * n / len(dealt)
    y = np.sort(np.concatenate([np.frombuffer(b, float) for _, b in whole]))
    np.testing.assert_array_equal(y, np.sort(np.arange(n) % 5))


def test_a_round_over_a_bounded_table_takes_one_job(spark):
    """Rounds over 250 000 rows once took a job per level; the rows of a node of that size are finished in one task."""
    df = spark.range(250_000, numPartitions=4).select(*[((F.col("id") * m) % 97).cast("double").alias(c) for c, m in zip(COLUMNS, (7, 31, 53))])
    blocks = make_blocks(df, COLUMNS, F.col("a") + F.col("b") * 2)
    spark.sparkContext.setJobGroup("rounds", "rounds")
    fit_boosted(blocks, COLUMNS, [Fit("squared", rounds=3)])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    blocks.release()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) <= 5


@pytest.mark.parametrize("plain", [True, False])
def test_histograms_of_listed_rows(plain):
    rng = np.random.default_rng(4)
    bins = np.array([255, 2, 6, 2, 14])
    x = np.stack([rng.integers(0, b, 3000) for b in bins]).astype(np.uint8)
    g, h = rng.normal(size=3000), np.ones(3000) if plain else rng.random(3000)
    some = np.sort(rng.choice(3000, 1100, replace=False))
    for rows in (None, some):
        used = np.ones(3000, bool) if rows is None else np.isin(np.arange(3000), rows)
        wanted = node_histograms(x, g, h, np.zeros(3000, np.int64), used, [0], 1, bins)[:, 0]
        assert np.allclose(rows_histogram(bundled(x, bins), g, h, rows, bins), wanted, rtol=0, atol=1e-9)
