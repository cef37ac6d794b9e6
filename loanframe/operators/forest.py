"""Forests and single trees without a depth limit, over blocks of bins.

A node with many rows is split by histograms of all blocks.  As soon as a node's rows fit a bounded task, they are sent there,
by tree and node, and its whole subtree is finished in that task.  Trees with bootstrap weigh each row by a Poisson number that
depends on the row's key and the tree.  A node tries its features in an order of its own, so many at a time as the forest
looks at, until one of them can split it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe.operators.blocks import Blocks, mixed, share, summed, unpacked
from loanframe.operators.boosting import targets, walked
from loanframe.operators.ordering import durable
from loanframe.operators.spread_forest import SpreadForest
from loanframe.operators.treemodel import TreeModel

TASK_ROWS = 500_000         # rows of a node that one task finishes
PASS_BYTES = 64 << 20       # histograms of one pass
GROUP_BYTES = 32 << 20      # rows sent per task, about
GATHERED = 8_000_000        # nodes that may meet on the driver; a forest that may have more stays spread
DENSE = 2                   # bins per row up to which a node's bins are counted in a table
TOGETHER = 4                # levels after which the bins of a node's rows are put together


@dataclass
class Forest:
    """Settings of a forest; a single tree has one tree, no bootstrap and looks at all features."""

    n_classes: int
    n_trees: int = 300
    depth: int | None = None
    least_rows: int = 1
    features: int | None = None          # looked at per node; the square root of all, if not given
    bootstrap: bool = True
    class_weights: list[float] | None = None
    fold_from: int | None = None
    fold_below: int | None = None
    relabel: list[int] | None = None     # class in this fit of each class of the blocks
    seed: int = 42
    task_rows: int = TASK_ROWS


def times(key: np.ndarray, fit: Forest, tree: int) -> np.ndarray:
    """How often a tree takes each row: Poisson with mean one."""
    if not fit.bootstrap:
        return np.ones(len(key), np.int64)
    return np.searchsorted(np.cumsum(np.exp(-1.0) / np.cumprod(np.append(1.0, np.arange(1.0, 18.0)))), share(key, fit.seed, 7, tree), side="right")


def turns(tree: int, paths: np.ndarray, n_features: int, seed: int) -> np.ndarray:
    """Per node, named by its path, the order in which its features are tried."""
    own = mixed(paths.astype(np.uint64), seed, 3, tree)
    return np.argsort(mixed((own[:, None] ^ (np.arange(n_features, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]).ravel(), 5).reshape(len(paths), -1), axis=1)


def purity(s: np.ndarray) -> np.ndarray:
    """Squares of the class weights over their sum (last axis)."""
    return np.einsum("...c,...c->...", s, s) / np.maximum(np.einsum("...c->...", s), 1e-300)


def gini_gain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Weighted decrease of impurity, from class weights on both sides (last axis)."""
    return purity(left) + purity(right) - purity(left + right)


# ------------------------------------------------------------------- a node's rows in one task


def filled_bins(many: np.ndarray, bins: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node, bin, class weights and rows of every bin that has rows, by node and bin.

    The rows lie node after node, ``many`` of each; ``width`` is the number of bins of each node's feature.  Nodes with about
    as many rows as bins are counted in one table of all their bins; the rows of smaller ones are sorted, so that neither the
    many bins nor the many rows are looked at in vain.
    """
    dense = (many > 0) & (width <= DENSE * many)
    parts = []
    if dense.any():
        own = np.where(dense, width, 0)
        ends = np.cumsum(own)
        size, start = int(ends[-1]), ends - own
        whole = bool(dense[many > 0].all())
        mine = slice(None) if whole else np.flatnonzero(np.repeat(dense, many))
        place = np.repeat(start[dense], many[dense]) + bins[mine]
        rows = np.bincount(place, minlength=size)
        at = np.flatnonzero(rows)
        place *= k
        place += y[mine]
        sums = np.bincount(place, w[mine], size * k).reshape(size, k)
        owner = np.repeat(np.arange(len(width)), own)[at]
        parts.append((owner, at - start[owner], sums[at], rows[at]))
    if not dense[many > 0].all():
        rare = np.where(dense, 0, many)
        mine = np.flatnonzero(np.repeat(~dense, many))
        key = np.sort((np.repeat(np.arange(len(many)), rare) << 8 | bins[mine]) << 32 | np.arange(len(mine)))
        who, group = mine[key & 0xFFFFFFFF], key >> 32
        new = np.append(True, group[1:] != group[:-1])
        first, number = np.flatnonzero(new), np.cumsum(new) - 1
        sums = np.bincount(number * k + y[who], w[who], len(first) * k).reshape(-1, k)
        parts.append((group[first] >> 8, group[first] & 255, sums, np.diff(np.append(first, len(group)))))
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(p) for p in zip(*parts))


def side_by_side(side: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that lie node after node, put child after child: their new order, and the rows of each child."""
    left, right = np.flatnonzero(~side), np.flatnonzero(side)
    ends = np.cumsum(many)
    n_left = np.diff(np.searchsorted(left, ends), prepend=0)
    counts = np.stack([n_left, many - n_left], axis=1).ravel()
    start = np.cumsum(counts) - counts
    order = np.empty(len(side), np.int64)
    for own, n, at in ((left, n_left, start[::2]), (right, many - n_left, start[1::2])):
        order[np.arange(len(own)) + np.repeat(at - np.cumsum(n) + n, n)] = own
    return order, counts


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, fit: Forest, tree: int, path: int, depth: int) -> dict[str, np.ndarray]:
    """The subtree of some rows: feature, bin, left (-1: leaf), shares of the classes, gain, cover.

    All nodes of a level are split together: the class weights of their bins, added up, give every cut's gain.  Weights are
    rounded to multiples of a power of two that leave all sums exact, so that neither the order of the rows nor what lies
    before a node decides between equal cuts.  The rows lie node after node, and now and then their bins are put so as well:
    what is read and counted for a node is then close together.
    """
    n_features, k = len(x), fit.n_classes
    look = fit.features or max(1, int(np.sqrt(n_features)))
    widths, flat, size = x.max(axis=1).astype(np.int64) + 1, np.ascontiguousarray(x).ravel(), x.shape[1]
    rows, y, many = np.arange(size), y.astype(np.int64), np.array([size])
    fine = 2.0 ** (51 - np.frexp(max(w.sum(), 1e-300))[1])
    w = np.maximum(np.rint(w * fine), w > 0) / fine
    out = {name: [] for name in ("feature", "bin", "left", "gain")}
    total, paths, base = [np.bincount(y, w, k)[None]], np.array([path], np.uint64), 0
    while len(paths):
        count = len(paths)
        open_ = ((total[-1] > 0).sum(axis=1) > 1) & (many >= 2 * fit.least_rows)
        if fit.depth is not None and depth >= fit.depth:
            open_[:] = False
        if not open_.all():
            stay = np.repeat(open_, many)
            rows, y, w, many = rows[stay], y[stay], w[stay], np.where(open_, many, 0)
        best, whole = np.full(count, -np.inf), purity(total[-1])
        feature, cut = np.zeros(count, np.int64), np.zeros(count, np.int64)
        order, at = np.zeros((count, n_features), np.int64), 0
        if open_.any():
            order[open_] = turns(tree, paths[open_], n_features, fit.seed)
        waiting = open_.copy()
        while waiting.any() and at < n_features:
            own_rows, own_y, own_w, own_many = rows, y, w, many
            if at:
                mine = np.flatnonzero(np.repeat(waiting, many))
                own_rows, own_y, own_w, own_many = rows[mine], y[mine], w[mine], np.where(waiting, many, 0)
            for j in range(at, min(at + look, n_features)):
                tried = order[:, j]
                of, bins, sums, seen = filled_bins(own_many, flat.take(np.repeat(tried * size, own_many) + own_rows), own_y, own_w, k, widths[tried])
                starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))            # first bin of each node
                place = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(of))))
                left, seen = np.cumsum(sums, axis=0), np.cumsum(seen)
                left, seen = left - (left[starts] - sums[starts])[place], seen - np.append(0, seen[starts[1:] - 1])[place]
                valid = np.flatnonzero(np.append(of[1:] == of[:-1], False) & (seen >= fit.least_rows) & (many[of] - seen >= fit.least_rows))
                if not len(valid):
                    continue
                of, bins, left = of[valid], bins[valid], left[valid]
                gain = purity(left) + purity(total[-1][of] - left) - whole[of]
                starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                place = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(of))))
                hit = np.flatnonzero(gain == np.maximum.reduceat(gain, starts)[place])
                hit = hit[np.append(True, place[hit[1:]] != place[hit[:-1]])]          # the first of equal cuts
                nodes = of[hit]
                known = np.where(np.isfinite(best[nodes]), best[nodes], 0.0)
                better = ~np.isfinite(best[nodes]) | (gain[hit] > known + 1e-12 * np.abs(known))
                nodes, hit = nodes[better], hit[better]
                best[nodes], feature[nodes], cut[nodes] = gain[hit], order[nodes, j], bins[hit]
            at += look
            waiting &= ~np.isfinite(best)
        split = np.isfinite(best)
        number = np.cumsum(split) - 1
        out["feature"].append(feature), out["bin"].append(cut), out["gain"].append(np.where(split, best, 0.0))
        out["left"].append(np.where(split, base + count + 2 * number, -1))
        if not split.all():
            stay = np.repeat(split, many)
            rows, y, w = rows[stay], y[stay], w[stay]
        made = np.flatnonzero(split)
        own = many[made]
        turn, many = side_by_side(flat.take(np.repeat(feature[made] * size, own) + rows) > np.repeat(cut[made], own), own)
        rows, y, w = rows[turn], y[turn], w[turn]
        base, depth = base + count, depth + 1
        paths = np.stack([paths[made] * np.uint64(2), paths[made] * np.uint64(2) + np.uint64(1)], axis=1).ravel()
        if len(made):
            total.append(np.bincount(np.repeat(np.arange(2 * len(made)) * k, many) + y, w, 2 * len(made) * k).reshape(-1, k))
            if (len(total) - 1) % TOGETHER == 0:
                flat, size = flat.reshape(n_features, size).take(rows, axis=1).ravel(), len(rows)
                rows = np.arange(size)
    done = {name: np.concatenate(v) for name, v in out.items()}
    cover = np.concatenate(total)
    return done | {"cover": cover.sum(axis=1), "shares": cover / np.maximum(cover.sum(axis=1, keepdims=True), 1e-300)}


# ------------------------------------------------------------------- nodes with more rows


class Upper:
    """The nodes of a tree that are split by passes over the blocks."""

    def __init__(self):
        self.feature, self.bin, self.left, self.gain, self.path, self.depth, self.tried, self.total, self.seen = [], [], [], [], [], [], [], [], []

    def add(self, path: int, depth: int, total: np.ndarray | None, seen: int) -> None:
        for held, v in zip((self.feature, self.bin, self.left, self.gain, self.path, self.depth, self.tried, self.total, self.seen), (0, 0, -1, 0.0, path, depth, 0, total, seen)):
            held.append(v)

    def arrays(self):
        return np.array(self.feature, np.int64), np.array(self.bin, np.int64), np.array(self.left, np.int64)


def _weights(b: dict, fit: Forest, tree: int) -> np.ndarray:
    w = times(b["key"], fit, tree).astype(float)
    if fit.class_weights is not None:
        w *= np.asarray(fit.class_weights)[b["y"].astype(np.int64)]
    if fit.fold_from is not None:
        w *= b["fold"] >= fit.fold_from
    return w if fit.fold_below is None else w * (b["fold"] < fit.fold_below)


def _grow_upper(blocks: Blocks, fit: Forest) -> list[Upper]:
    """Splits every node with more rows than a task may finish."""
    bins, k, trees = blocks.bins, fit.n_classes, [Upper() for _ in range(fit.n_trees)]
    look = fit.features or max(1, int(np.sqrt(len(bins))))
    roots = summed(blocks.rdd, lambda b: np.stack([np.append(np.bincount(targets(b, fit).astype(np.int64), w, k), np.count_nonzero(w)) for w in (_weights(b, fit, t) for t in range(fit.n_trees))]))
    for tree, own in zip(trees, roots if roots is not None else np.zeros((fit.n_trees, k + 1))):
        tree.add(1, 0, own[:k], int(own[k]))
    per_pass = max(1, PASS_BYTES // (look * 256 * (k + 1) * 8))
    open_ = [(t, 0) for t, tree in enumerate(trees) if tree.seen[0] > fit.task_rows and (tree.total[0] > 0).sum() > 1]
    while open_:
        now, open_ = open_[:per_pass], open_[per_pass:]
        asked: dict[int, list[tuple[int, np.ndarray]]] = {}
        for t, i in now:
            tree = trees[t]
            order = turns(t, np.array([tree.path[i]], np.uint64), len(bins), fit.seed)[0]
            asked.setdefault(t, []).append((i, order[tree.tried[i]:tree.tried[i] + look]))
        held = {t: trees[t].arrays() for t in asked}

        def counted(b: dict) -> np.ndarray:
            out = []
            for t, nodes in asked.items():
                w, at, y = _weights(b, fit, t), walked(b["x"], held[t]), targets(b, fit).astype(np.int64)
                for i, tried in nodes:
                    rows = np.flatnonzero((at == i) & (w > 0))
                    for f in range(look):
                        own = b["x"][tried[f], rows].astype(np.int64) if f < len(tried) else np.zeros(len(rows), np.int64)
                        out += [np.bincount(own * k + y[rows], w[rows], 256 * k), np.bincount(own, minlength=256).astype(float)]
            return np.concatenate(out)

        found = summed(blocks.rdd, counted).reshape(-1, look, 256 * (k + 1))
        at = 0
        for t, nodes in asked.items():
            for i, tried in nodes:
                open_ += _split_upper(trees[t], t, i, tried, found[at], fit, len(bins))
                at += 1
    return trees


def _split_upper(tree: Upper, t: int, i: int, tried: np.ndarray, found: np.ndarray, fit: Forest, n_features: int) -> list[tuple[int, int]]:
    k, best = fit.n_classes, None
    for j, f in enumerate(tried.tolist()):
        left = np.cumsum(found[j, :256 * k].reshape(256, k), axis=0)
        seen = np.cumsum(found[j, 256 * k:])
        valid = (found[j, 256 * k:] > 0) & (seen >= fit.least_rows) & (tree.seen[i] - seen >= max(fit.least_rows, 1))
        gain = np.where(valid, gini_gain(left, tree.total[i] - left), -np.inf)
        at = int(gain.argmax())
        if np.isfinite(gain[at]) and (best is None or gain[at] > best[0] + 1e-12 * abs(best[0])):
            best = (float(gain[at]), f, at, left[at], int(seen[at]))
    if best is None:
        tree.tried[i] += len(tried)
        return [(t, i)] if tree.tried[i] < n_features else []
    tree.gain[i], tree.feature[i], tree.bin[i], tree.left[i] = best[0], best[1], best[2], len(tree.left)
    tree.add((2 * tree.path[i]) & 0xFFFFFFFFFFFFFFFF, tree.depth[i] + 1, best[3], best[4])
    tree.add((2 * tree.path[i] + 1) & 0xFFFFFFFFFFFFFFFF, tree.depth[i] + 1, tree.total[i] - best[3], tree.seen[i] - best[4])
    return [(t, c) for c in (tree.left[i], tree.left[i] + 1)
            if tree.seen[c] > fit.task_rows and (tree.total[c] > 1e-9).sum() > 1 and (fit.depth is None or tree.depth[c] < fit.depth)]


# ------------------------------------------------------------------- both together


def fit_forest(blocks: Blocks, features: list[str], fit: Forest, gathered: int = GATHERED) -> TreeModel | SpreadForest:
    """The whole forest: gathered on the driver, or, if it may have more nodes than that, in the checkpoint folder.

    An unbounded tree has at most two nodes per row that it takes.
    """
    most = 2 * blocks.n if fit.depth is None else min(2 * blocks.n, 2 ** (fit.depth + 1))
    if most * fit.n_trees <= gathered:
        trees, grown = _grown(blocks, len(features), fit)
        return _assembled({(r["tree"], r["node"]): r for r in grown.collect()}, trees, blocks, features, fit)
    trees, grown = _grown(blocks, len(features), fit, NODES)
    grown = durable(grown)
    gains, nodes, seen = _upper_gains(trees, len(features)), 0, set()
    for r in grown.select("tree", "node", "gain", F.length("bin").alias("n")).collect():
        gains[r["tree"]] += np.frombuffer(r["gain"])
        nodes, seen = nodes + r["n"], seen | {(r["tree"], r["node"])}
    uppers = [tree.arrays() for tree in trees]
    empty = [(t, i) for t, upper in enumerate(uppers) for i in np.flatnonzero(upper[2] < 0).tolist() if (t, i) not in seen]
    if empty:                                            # no row has come there: even shares
        leaf = [np.full(1, -1, np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.full((1, fit.n_classes), 1.0 / fit.n_classes), np.zeros(len(features))]
        grown = grown.unionByName(grown.sparkSession.createDataFrame([(t, i, *(bytearray(v.tobytes()) for v in leaf)) for t, i in empty], grown.schema))
    return SpreadForest(features, blocks.cuts, fit.n_classes, uppers, grown, nodes, _shares_of(gains))


def forest_gains(blocks: Blocks, n_features: int, fit: Forest) -> np.ndarray:
    """Share of the gain per feature, averaged over the trees: what is left of the nodes are sums of bounded size."""
    trees, grown = _grown(blocks, n_features, fit, GAINS)
    gains = _upper_gains(trees, n_features)
    for r in grown.collect():
        gains[r["tree"]] += np.frombuffer(r["gain"])
    return _shares_of(gains)


def _upper_gains(trees: list[Upper], n_features: int) -> np.ndarray:
    gains = np.zeros((len(trees), n_features))
    for t, tree in enumerate(trees):
        np.add.at(gains[t], np.array(tree.feature, np.int64), np.where(np.array(tree.left) >= 0, np.array(tree.gain), 0.0))
    return gains


def _shares_of(gains: np.ndarray) -> np.ndarray:
    """The share of each feature, from its gain in each tree."""
    split = gains[gains.sum(axis=1) > 0]
    shares = (split / split.sum(axis=1, keepdims=True)).sum(axis=0)
    return shares / shares.sum() if len(split) else shares


GAINS = ("gain",)                                            # per feature
NODES = ("feature", "bin", "value", "leaves", "gain")        # per node what scoring needs, gains per feature
WHOLE = ("feature", "bin", "left", "value", "gain", "cover", "leaves")


def _grown(blocks: Blocks, n_features: int, fit: Forest, names: tuple[str, ...] = WHOLE) -> tuple[list[Upper], DataFrame]:
    """The upper nodes of all trees, and the finished subtrees as rows: tree, node and what ``names`` asks for."""
    trees = _grow_upper(blocks, fit)
    uppers = [tree.arrays() for tree in trees]
    paths = [(np.array(tree.path, np.uint64), np.array(tree.depth, np.int64)) for tree in trees]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each open node, and how often the tree takes them."""
        for batch in batches:
            for row in batch.to_pylist():
                b = unpacked(row)
                for t, upper in enumerate(uppers):
                    w, at = _weights(b, fit, t), walked(b["x"], upper)
                    took = np.flatnonzero(w > 0)
                    took = took[np.argsort(at[took], kind="stable")]
                    for own in np.split(took, np.flatnonzero(np.diff(at[took])) + 1) if len(took) else []:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([t], pa.int32()), pa.array([at[own[0]]], pa.int32()), pa.array([len(own)]), pa.array([b["x"][:, own].tobytes()], pa.binary()),
                             pa.array([targets(b, fit)[own].astype(np.uint8).tobytes()], pa.binary()), pa.array([w[own].tobytes()], pa.binary())], names=["tree", "node", "n", "x", "y", "w"])

    def finish(table: pa.Table) -> pa.Table:
        t, i = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        parts = sorted(zip(*(table.column(c).to_pylist() for c in ("n", "x", "y", "w"))), key=lambda p: p[1:])
        x = np.concatenate([np.frombuffer(p[1], np.uint8).reshape(n_features, p[0]) for p in parts], axis=1)
        y, w = np.concatenate([np.frombuffer(p[2], np.uint8) for p in parts]), np.concatenate([np.frombuffer(p[3], float) for p in parts])
        own = grow(x, y.astype(np.int64), w, fit, t, int(paths[t][0][i]), int(paths[t][1][i]))
        key = {"tree": pa.array([t], pa.int32()), "node": pa.array([i], pa.int32())}
        leaf = own["left"] < 0
        held = {}
        if names != WHOLE:
            held["gain"] = np.bincount(own["feature"][~leaf], own["gain"][~leaf], n_features).astype(float)
        if names == GAINS:
            return pa.table(key | {"gain": pa.array([held["gain"].tobytes()], pa.binary())})
        distinct, which = np.unique(own["shares"][leaf], axis=0, return_inverse=True)
        value = np.zeros(len(leaf), np.int32)
        value[leaf] = which.ravel()
        feature = own["feature"].astype(np.int16)
        if names == NODES:                                   # children follow each other: which nodes are leaves says where they are
            feature[leaf] = -1
            value = value[leaf]
        held = {"feature": feature, "bin": own["bin"].astype(np.uint8), "left": own["left"].astype(np.int32), "value": value,
                "gain": own["gain"].astype(np.float32), "cover": own["cover"].astype(np.float32), "leaves": distinct, **held}
        return pa.table({**key, **{name: pa.array([held[name].tobytes()], pa.binary()) for name in names}})

    spark = blocks.frame.sparkSession
    sent = blocks.frame.mapInArrow(send, "tree int, node int, n bigint, x binary, y binary, w binary")
    tasks = max(1, min(sum(int((u[2] < 0).sum()) for u in uppers), max(4 * spark.sparkContext.defaultParallelism, blocks.n * fit.n_trees * (n_features + 9) // GROUP_BYTES)))
    rows = sent.repartition(tasks, "tree", "node").groupBy("tree", "node")
    return trees, rows.applyInArrow(finish, "tree int, node int, " + ", ".join(f"{n} binary" for n in names))


TYPES = {"feature": np.int16, "bin": np.uint8, "left": np.int32, "value": np.int32, "gain": np.float32, "cover": np.float32}


def _assembled(grown: dict, trees: list[Upper], blocks: Blocks, features: list[str], fit: Forest) -> TreeModel:
    """One set of arrays: each tree's upper nodes, with the finished subtrees in place of their open ones."""
    arrays = {name: [] for name in TYPES}
    root, base, leaves, n_leaves = [], 0, [], 0
    k = fit.n_classes
    for t, tree in enumerate(trees):
        upper = {"feature": np.array(tree.feature), "bin": np.array(tree.bin), "left": np.array(tree.left, np.int64), "gain": np.array(tree.gain), "value": np.zeros(len(tree.left), np.int64),
                 "cover": np.array([s.sum() for s in tree.total])}
        root.append(base)
        size = len(tree.left)
        parts = [upper]
        upper["left"] = np.where(upper["left"] >= 0, upper["left"] + base, -1)
        at = base + size
        for i in np.flatnonzero(np.array(tree.left) < 0).tolist():
            own = grown.get((t, i))
            sub = {name: np.frombuffer(own[name], kind).astype(np.int64 if name in ("left", "value") else kind) for name, kind in TYPES.items()} if own else None
            if sub is None:                                  # no row has come here: even shares
                leaves.append(np.full((1, k), 1.0 / k))
                upper["value"][i] = n_leaves
                n_leaves += 1
                continue
            shares = np.frombuffer(own["leaves"]).reshape(-1, k)
            sub["value"] = sub["value"] + n_leaves
            leaves.append(shares)
            n_leaves += len(shares)
            # the subtree's root takes the open node's place, its other nodes follow
            sub["left"] = np.where(sub["left"] >= 0, sub["left"] - 1 + at, -1)
            for name in TYPES:
                upper[name][i] = sub[name][0]
            parts.append({name: v[1:] for name, v in sub.items()})
            at += len(sub["left"]) - 1
        base = at
        for name in TYPES:
            arrays[name].append(np.concatenate([p[name] for p in parts]))
    distinct, which = np.unique(np.concatenate(leaves), axis=0, return_inverse=True)
    flat = {name: np.concatenate(v) for name, v in arrays.items()}
    flat["value"] = which.ravel()[np.minimum(flat["value"], len(which) - 1)].astype(np.int32)
    flat = {name: v.astype(np.int64 if name == "left" else TYPES[name]) for name, v in flat.items()}
    flat |= {"root": np.array(root, np.int64), "out": np.zeros(len(root), np.int64), "round": np.arange(len(root)), "init": np.zeros(k)}
    return TreeModel("forest", features, blocks.cuts, flat, distinct)
