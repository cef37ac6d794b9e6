"""Gradient-boosted trees over blocks of bins.

All classes of a fit, and several fits side by side, grow in the same passes: a pass gives the gradient histograms of the
nodes that may still be split, and only of the smaller one of two siblings, the other is what is left of their parent.  Trees
grow leaf by leaf, best gain first.  As a node's split does not depend on other nodes, a pass splits all nodes of a depth that
the order of gains can still reach, so a tree takes as many passes as it is deep at most, whatever its leaves.  Nodes whose
rows fit a bounded task are not passed over again: their rows are sent to one task, by tree and node, which finishes the
subtree in the same order of gains.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import SparkSession

from loanframe.operators.blocks import Blocks, share, summed
from loanframe.operators.ordering import checkpoint_folder
from loanframe.operators.treemodel import TreeModel

CUT_EVERY = 40          # rounds after which the margins' lineage is cut
TASK_ROWS = 1_000_000   # rows of a node whose subtree one task finishes; a pass over all rows costs more than such a task
BUNDLE = 1_024          # bins of features that are counted together


@dataclass
class Fit:
    """Settings of one fit; ``loss`` is softmax, logistic or squared."""

    loss: str
    n_classes: int = 0
    class_weights: list[float] | None = None
    fold_below: int | None = None           # learns from rows of earlier folds only
    fold_from: int | None = None            # and from none before this one
    relabel: list[int] | None = None        # class in this fit of each class of the blocks; those without weight may have any
    rounds: int = 200
    depth: int = 7
    leaves: int | None = 31
    rate: float = 0.05
    row_share: float = 1.0
    feature_share: float = 1.0
    penalty: float = 0.0
    least_rows: int = 20
    least_hessian: float = 1e-3
    start_at_mean: bool = True
    seed: int = 42
    task_rows: int = TASK_ROWS

    @property
    def n_out(self) -> int:
        return self.n_classes if self.loss == "softmax" else 1


@dataclass
class Growing:
    """A tree while it grows: nodes in order of creation, the right child follows the left one."""

    stats: list[tuple[float, float, int]] = field(default_factory=list)     # gradient, hessian, rows
    depth: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)                           # made children, else -1
    split: dict[int, tuple | None] = field(default_factory=dict)            # gain, feature, bin, statistics of the left side
    histogram: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, stats: tuple[float, float, int], depth: int) -> int:
        self.stats.append(stats), self.depth.append(depth), self.left.append(-1)
        return len(self.left) - 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        made = [self.split[i] if l >= 0 else None for i, l in enumerate(self.left)]
        return (np.array([s[1] if s else 0 for s in made], np.int64), np.array([s[2] if s else 0 for s in made], np.int64), np.array(self.left, np.int64))

    def graft(self, at: int, sub: "Growing") -> None:
        """A grown subtree in place of a node."""
        place = {0: at}
        if at == 0:
            self.stats[0] = sub.stats[0]
        for i in range(len(sub.left)):
            self.split[place[i]] = sub.split.get(i)
            if sub.left[i] >= 0:
                l = sub.left[i]
                place[l], place[l + 1] = self.add(sub.stats[l], sub.depth[l]), self.add(sub.stats[l + 1], sub.depth[l + 1])
                self.left[place[i]] = place[l]

    def chosen(self, leaves: int | None) -> list[int]:
        """Nodes that are split when the best known gain goes first, until there are ``leaves`` leaves."""
        queue = [(-self.split[0][0], 0)] if self.split.get(0) else []
        out: list[int] = []
        while queue and (leaves is None or len(out) < leaves - 1):
            _, i = heapq.heappop(queue)
            out.append(i)
            if self.left[i] >= 0:
                for child in (self.left[i], self.left[i] + 1):
                    if self.split.get(child):
                        heapq.heappush(queue, (-self.split[child][0], child))
        return out


def walked(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray], node: np.ndarray | None = None) -> np.ndarray:
    """The node each row has come to; ``node`` says where rows have been found before, when the tree was smaller."""
    feature, at, left = tree
    node = np.zeros(x.shape[1], np.int64) if node is None else node.copy()
    flat, size = np.ascontiguousarray(x).ravel(), x.shape[1]
    going = np.flatnonzero(left[node] >= 0)
    while len(going):
        here = node[going]
        here = left[here] + (flat.take(feature[here] * size + going) > at[here])
        node[going] = here
        going = going[left[here] >= 0]
    return node


def row_weights(block: dict, fit: Fit) -> np.ndarray:
    y = block["y"]
    w = np.ones(len(y)) if fit.class_weights is None else np.asarray(fit.class_weights)[y.astype(np.int64)]
    if fit.fold_from is not None:
        w = w * (block["fold"] >= fit.fold_from)
    return w if fit.fold_below is None else w * (block["fold"] < fit.fold_below)


def targets(block: dict, fit: Fit) -> np.ndarray:
    return block["y"] if fit.relabel is None else np.asarray(fit.relabel, float)[block["y"].astype(np.int64)]


def gradients(block: dict, fit: Fit, margin: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient and hessian (outputs x rows), and the rows of this round."""
    y, w = targets(block, fit), row_weights(block, fit)
    used = w > 0
    if fit.row_share < 1:
        used &= share(block["key"], fit.seed, number) < fit.row_share
    if fit.loss == "squared":
        return (w * (margin[0] - y))[None], w[None], used
    if fit.loss == "logistic":
        p = 1.0 / (1.0 + np.exp(-margin[0]))
        return (w * (p - y))[None], (w * np.maximum(p * (1 - p), 1e-16))[None], used
    e = np.exp(margin - margin.max(axis=0))
    p = e / e.sum(axis=0)
    hit = np.arange(fit.n_classes)[:, None] == y[None, :]
    factor = fit.n_classes / (fit.n_classes - 1) if fit.start_at_mean else 2.0
    return w * (p - hit), w * np.maximum(factor * p * (1 - p), 1e-16), used


def per_output(block: dict, fits: list[Fit], number: int, wanted: list) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Output, gradient, hessian and used rows, for the outputs that anything is wanted of."""
    o = 0
    for fit in fits:
        if any(wanted[o:o + fit.n_out]):
            g, h, used = gradients(block, fit, block["margin"][o:o + fit.n_out], number)
            for k in range(fit.n_out):
                if wanted[o + k]:
                    yield o + k, g[k], h[k], used
        o += fit.n_out


def bundles(bins: np.ndarray) -> list[list[int]]:
    """Features that are counted by one number for all their bins together: few of few bins, else each alone."""
    out: list[list[int]] = []
    held, size = [], 1
    for f in np.argsort(bins, kind="stable").tolist():
        if held and size * bins[f] > BUNDLE:
            out, held, size = [*out, held], [], 1
        held, size = [*held, f], size * int(bins[f])
    return [*out, held] if held else out


def node_histograms(x: np.ndarray, g: np.ndarray, h: np.ndarray, node: np.ndarray, used: np.ndarray, wanted: list[int], n_nodes: int, bins: np.ndarray) -> np.ndarray:
    """Gradient, hessian and rows of every bin of the wanted nodes (3 x nodes x bins).

    One bundle of features at a time, so that what is worked on stays small; a bundle's counts are added up per feature.
    """
    total, start, many = int(bins.sum()), np.cumsum(bins) - bins, len(wanted)
    slot = np.full(n_nodes, -1, np.int64)
    slot[wanted] = np.arange(many)
    own = slot[node]
    rows = np.flatnonzero((own >= 0) & used)
    whole = len(rows) == len(node)
    own, g, h = (own, g, h) if whole else (own[rows], g[rows], h[rows])
    out = np.zeros((3, many, total))
    for bundle in bundles(bins):
        place = own
        for f in bundle:
            place = place * int(bins[f]) + (x[f] if whole else x[f].take(rows))
        shape = (many, *(int(bins[f]) for f in bundle))
        size = int(np.prod(shape))
        for i, found in enumerate((np.bincount(place, g, size), np.bincount(place, h, size), np.bincount(place, minlength=size))):
            for j, f in enumerate(bundle):
                out[i, :, start[f]:start[f] + bins[f]] = found.reshape(many, int(np.prod(shape[1:j + 1])), int(bins[f]), -1).sum(axis=(1, 3))
    return out


def histograms(block: dict, fits: list[Fit], trees: list, wanted: list[list[int]], bins: np.ndarray, number: int) -> np.ndarray:
    """The histograms of the wanted nodes of all outputs, one after the other."""
    return np.concatenate([
        node_histograms(block["x"], g, h, walked(block["x"], trees[o]), used, wanted[o], len(trees[o][2]), bins).ravel()
        for o, g, h, used in per_output(block, fits, number, wanted)])


def sent_rows(block: dict, fits: list[Fit], trees: list, local: list[list[int]], number: int) -> Iterator[tuple[tuple[int, int], tuple]]:
    """The rows of nodes that are finished in one task: bins, gradient, hessian, by output and node."""
    for o, g, h, used in per_output(block, fits, number, local):
        node = walked(block["x"], trees[o])
        for i in local[o]:
            rows = np.flatnonzero((node == i) & used)
            if len(rows) == len(node):
                yield (o, i), (block["x"], g, h)
            elif len(rows):
                yield (o, i), (block["x"].take(rows, axis=1), g[rows], h[rows])


def bundled(x: np.ndarray, bins: np.ndarray) -> list[tuple[list[int], np.ndarray]]:
    """The features of each bundle, and one number per row for all their bins."""
    out = []
    for bundle in bundles(bins):
        place = x[bundle[0]]
        for f in bundle[1:]:
            place = place.astype(np.uint16) * np.uint16(bins[f]) + x[f]
        out.append((bundle, place))
    return out


def rows_histogram(columns: list[tuple[list[int], np.ndarray]], g: np.ndarray, h: np.ndarray, rows: np.ndarray | None, bins: np.ndarray) -> np.ndarray:
    """Gradient, hessian and rows of every bin (3 x bins) of some rows, all if not given; ``columns`` come from ``bundled``."""
    start, out = np.cumsum(bins) - bins, np.empty((3, int(bins.sum())))
    g, h = (g, h) if rows is None else (g.take(rows), h.take(rows))
    plain = bool((h == 1.0).all())
    for bundle, place in columns:
        shape = [int(bins[f]) for f in bundle]
        size = int(np.prod(shape))
        place = (place if rows is None else place.take(rows)).astype(np.int64)
        n = np.bincount(place, minlength=size).astype(float)
        for i, found in enumerate((np.bincount(place, g, size), n if plain else np.bincount(place, h, size), n)):
            for j, f in enumerate(bundle):
                out[i, start[f]:start[f] + bins[f]] = found.reshape(int(np.prod(shape[:j])), shape[j], -1).sum(axis=(0, 2))
    return out


def subtree(parts: list[tuple], fit: Fit, bins: np.ndarray, allowed: np.ndarray, depth: int) -> "Growing":
    """Grows from some rows down, all of them in memory; parts are put in an order of their own, as sums depend on it.

    Each node knows its rows, so that a split looks at these alone.
    """
    parts = sorted(parts, key=lambda p: (p[0].shape[1], p[0].tobytes(), p[1].tobytes()))
    x, g, h = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    t, wanted, columns = Growing(), [0], bundled(x, bins)
    rows: dict[int, np.ndarray | None] = {0: None}
    t.add((0.0, 0.0, 0), depth)
    while wanted:
        own = np.stack([rows_histogram(columns, g, h, rows[i], bins) for i in wanted])
        wanted = _next_nodes(t, wanted, own, fit, bins, allowed)
        needed = {c for i in wanted for c in (i, i - 1 if i % 2 == 0 else i + 1)}
        for i in [i for i in rows if t.left[i] >= 0]:
            held, l = rows.pop(i), t.left[i]
            if l in needed:
                _, f, at, _ = t.split[i]
                side = (x[f] if held is None else x[f].take(held)) > at
                rows[l], rows[l + 1] = (np.flatnonzero(~side), np.flatnonzero(side)) if held is None else (held[~side], held[side])
    t.histogram.clear()
    return t


def best_splits(hist: np.ndarray, stats: np.ndarray, bins: np.ndarray, allowed: np.ndarray, fit: Fit) -> list[tuple | None]:
    """The best split of each node from its histogram (nodes x 3 x bins), or None."""
    ends = np.cumsum(bins)
    first = ends - bins
    sums = np.cumsum(hist, axis=2)
    before = np.concatenate([np.zeros((*sums.shape[:2], 1)), sums], axis=2)[:, :, np.repeat(first, bins)]
    left = sums - before
    right = stats[:, :, None] - left
    whole = stats[:, 0] ** 2 / (stats[:, 1] + fit.penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[:, 0] ** 2 / (left[:, 1] + fit.penalty) + right[:, 0] ** 2 / (right[:, 1] + fit.penalty) - whole[:, None]
    fine = allowed[np.repeat(np.arange(len(bins)), bins)][None, :] & (left[:, 2] >= fit.least_rows - 0.5) & (right[:, 2] >= fit.least_rows - 0.5)
    fine &= (left[:, 1] >= fit.least_hessian) & (right[:, 1] >= fit.least_hessian)
    fine[:, ends - 1] = False
    gain = np.where(fine & np.isfinite(gain), gain, -np.inf)
    out: list[tuple | None] = []
    for n, at in enumerate(gain.argmax(axis=1).tolist()):
        if not gain[n, at] > 1e-10:
            out.append(None)
            continue
        feature = int(np.searchsorted(ends, at, side="right"))
        out.append((float(gain[n, at]), feature, at - int(first[feature]), tuple(left[n, :, at].tolist())))
    return out


def _allowed(fit: Fit, n: int, number: int) -> np.ndarray:
    """The features of a round."""
    if fit.feature_share >= 1:
        return np.ones(n, bool)
    kept = np.argsort(share(np.arange(n, dtype=np.uint64), fit.seed, number, 1))[:max(1, int(fit.feature_share * n))]
    return np.isin(np.arange(n), kept)


def fit_boosted(blocks: Blocks, features: list[str], fits: list[Fit]) -> list[TreeModel]:
    """One model per fit, all grown in the same passes over the blocks."""
    bins, outs = blocks.bins, [f for f, fit in enumerate(fits) for _ in range(fit.n_out)]
    init = _start(blocks, fits)
    start = np.concatenate(init) if init else np.zeros(0)
    trees: list[list[Growing]] = [[] for _ in outs]
    state = blocks.rdd.map(lambda b: b | {"margin": np.tile(start[:, None], (1, len(b["y"])))}).persist(StorageLevel.MEMORY_AND_DISK)
    former = None
    for number in range(max((fit.rounds for fit in fits), default=0)):
        live = [number < fits[f].rounds for f in outs]
        grown = _round(state, blocks, fits, outs, live, number)
        if former is not None:
            former.unpersist()
        steps = [_finished(t, fits[f]) if t is not None else None for t, f in zip(grown, outs)]
        for o, t in enumerate(steps):
            if t is not None:
                trees[o].append(t)
        former, state = state, _moved(state, steps, number)
    state.unpersist()
    if former is not None:
        former.unpersist()
    return [_model(fit, features, blocks, init[f], [trees[o] for o in range(len(outs)) if outs[o] == f]) for f, fit in enumerate(fits)]


def _start(blocks: Blocks, fits: list[Fit]) -> list[np.ndarray]:
    """Start margins: log shares of the weighted classes, or the mean."""
    def sums(b):
        out = []
        for fit in fits:
            w = row_weights(b, fit)
            out += [np.array([w.sum(), (w * b["y"]).sum()])] if fit.loss == "squared" else [np.bincount(targets(b, fit).astype(np.int64), w, fit.n_classes)]
        return np.concatenate(out)

    total = summed(blocks.rdd, sums)
    out, at = [], 0
    for fit in fits:
        size = 2 if fit.loss == "squared" else fit.n_classes
        own, at = total[at:at + size], at + size
        if not fit.start_at_mean:
            out.append(np.zeros(fit.n_out))
        elif fit.loss == "squared":
            out.append(np.array([own[1] / own[0] if own[0] else 0.0]))
        else:
            p = np.clip(own / max(own.sum(), 1e-300), 1e-15, 1 - 1e-15)
            out.append(np.array([np.log(p[1] / p[0])]) if fit.loss == "logistic" else np.log(p))
    return out


def _round(state, blocks: Blocks, fits: list[Fit], outs: list[int], live: list[bool], number: int) -> list[Growing | None]:
    """One tree per output."""
    bins = blocks.bins
    total = int(bins.sum())
    trees = [Growing() if on else None for on in live]
    nothing = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, -1, np.int64))
    allowed = [_allowed(fit, len(bins), number) for fit in fits]
    wanted: list[list[int]] = [[] for _ in trees]
    local: list[list[int]] = [[] for _ in trees]
    for o, t in enumerate(trees):
        if t is not None:
            t.add((0.0, 0.0, 0), 0)
            (local if blocks.n <= fits[outs[o]].task_rows else wanted)[o].append(0)
    while any(wanted):
        now = [t.arrays() if t is not None else nothing for t in trees]
        asked = [list(w) for w in wanted]
        found = summed(state, lambda b: histograms(b, fits, now, asked, bins, number))
        at, wanted = 0, [[] for _ in trees]
        for o, t in enumerate(trees):
            if asked[o]:
                n, fit = len(asked[o]), fits[outs[o]]
                own = found[at:at + 3 * n * total].reshape(3, n, total).transpose(1, 0, 2)
                at += 3 * n * total
                wanted[o] = _next_nodes(t, asked[o], own, fit, bins, allowed[outs[o]], local[o])
    if any(local):
        now = [t.arrays() if t is not None else nothing for t in trees]
        depth = {(o, i): trees[o].depth[i] for o, own in enumerate(local) for i in own}
        rows = state.flatMap(lambda b: sent_rows(b, fits, now, local, number))
        # the largest nodes are dealt out first, each to a task of its own as far as there are tasks
        tasks = min(len(depth), max(blocks.rdd.getNumPartitions(), 2 * state.context.defaultParallelism))
        task = {key: n % tasks for n, key in enumerate(sorted(depth, key=lambda key: (-trees[key[0]].stats[key[1]][2], key)))}
        grown = rows.groupByKey(tasks, lambda key: task[key]).map(
            lambda kv: (kv[0], subtree(list(kv[1]), fits[outs[kv[0][0]]], bins, allowed[outs[kv[0][0]]], depth[kv[0]]))).collect()
        for (o, i), sub in sorted(grown, key=lambda kv: kv[0]):
            trees[o].graft(i, sub)
    return trees


def _next_nodes(
    t: Growing, asked: list[int], own: np.ndarray, fit: Fit, bins: np.ndarray, allowed: np.ndarray, local: list[int] | None = None,
) -> list[int]:
    """Takes in the histograms of ``asked`` and their siblings, splits what can still be reached; the nodes to ask for next.

    With ``local``, nodes that a task can finish are put there instead.
    """
    ready: list[int] = []
    for n, node in enumerate(asked):
        t.histogram[node] = own[n]
        ready.append(node)
        if node:
            sibling = node - 1 if node % 2 == 0 else node + 1       # children are made in pairs after the root
            parent = next(p for p, l in enumerate(t.left) if l == min(node, sibling))
            t.histogram[sibling] = t.histogram[parent] - own[n]
            ready.append(sibling)
    if local:
        ready = [i for i in ready if i not in local]
    if t.stats[0] == (0.0, 0.0, 0):
        t.stats[0] = tuple(t.histogram[0][:, :int(bins[0])].sum(axis=1).tolist())
    ready = [i for i in ready if i not in t.split]
    hist, stats = np.stack([t.histogram[i] for i in ready]), np.array([t.stats[i] for i in ready], float)
    for i, s in zip(ready, best_splits(hist, stats, bins, allowed, fit)):
        t.split[i] = s
    used = {p for p in range(len(t.left)) if t.left[p] >= 0}
    for p in used:
        t.histogram.pop(p, None)
    fresh = [i for i in t.chosen(fit.leaves) if t.left[i] < 0]
    ask: list[int] = []
    for i in fresh:
        _, _, _, left = t.split[i]
        right = tuple(a - b for a, b in zip(t.stats[i], left))
        t.left[i] = t.add(left, t.depth[i] + 1)
        t.add(right, t.depth[i] + 1)
        pair = (t.left[i], t.left[i] + 1)
        open_ = [c for c in pair if t.depth[c] < fit.depth and t.stats[c][2] >= 2 * fit.least_rows - 0.5 and t.stats[c][1] >= 2 * fit.least_hessian]
        for c in pair:
            if c not in open_:
                t.split[c] = None
        small = [] if local is None else [c for c in open_ if t.stats[c][2] <= fit.task_rows]
        if small:
            local += small
        if len(small) < len(open_):
            ask.append(min(pair, key=lambda c: t.stats[c][2]))
    return ask


def _finished(t: Growing, fit: Fit) -> dict[str, np.ndarray]:
    """The chosen part of a tree as arrays; leaves and inner nodes have the value they would give as a leaf."""
    kept = set(t.chosen(fit.leaves))
    order, left = [0], []
    for i in order:                                                 # grows while it is read
        left.append(len(order) if i in kept else -1)
        if i in kept:
            order += [t.left[i], t.left[i] + 1]
    split = [t.split[i] if i in kept else (0.0, 0, 0) for i in order]
    g, h, n = (np.array([t.stats[i][k] for i in order], float) for k in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(h + fit.penalty > 0, -g / (h + fit.penalty), 0.0) * fit.rate
    return {"feature": np.array([s[1] for s in split], np.int16), "bin": np.array([s[2] for s in split], np.int16), "left": np.array(left, np.int64),
            "value": value, "gain": np.array([s[0] for s in split]), "cover": n}


def _moved(state, steps: list[dict | None], number: int):
    """The margins after a round, computed and kept by the first pass of the next one."""
    short = [None if s is None else ((s["feature"].astype(np.int64), s["bin"].astype(np.int64), s["left"]), s["value"]) for s in steps]

    def move(b: dict) -> dict:
        margin = b["margin"].copy()
        for o, s in enumerate(short):
            if s is not None:
                margin[o] += s[1][walked(b["x"], s[0])]
        return b | {"margin": margin}

    after = state.map(move).persist(StorageLevel.MEMORY_AND_DISK)
    if (number + 1) % CUT_EVERY == 0:
        checkpoint_folder(SparkSession.getActiveSession())
        after.checkpoint()
    return after


def _model(fit: Fit, features: list[str], blocks: Blocks, init: np.ndarray, trees: list[list[dict]]) -> TreeModel:
    flat = [(o, r, t) for o, own in enumerate(trees) for r, t in enumerate(own)]
    size = np.array([len(t["left"]) for _, _, t in flat], np.int64)
    root = np.cumsum(size) - size
    join = lambda name: np.concatenate([t[name] for _, _, t in flat]) if flat else np.zeros(0)
    left = np.concatenate([np.where(t["left"] >= 0, t["left"] + r, -1) for (_, _, t), r in zip(flat, root)]) if flat else np.zeros(0, np.int64)
    arrays = {name: join(name) for name in ("feature", "bin", "value", "gain", "cover")} | {
        "left": left, "root": root, "out": np.array([o for o, _, _ in flat], np.int64), "round": np.array([r for _, r, _ in flat], np.int64), "init": init}
    return TreeModel(fit.loss, features, blocks.cuts, arrays)
