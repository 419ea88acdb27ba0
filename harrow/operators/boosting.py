"""Gradient boosting of class scores with a softmax loss: second-order gradients, histograms, depth-wise or leaf-wise trees.

Features are cut into at most `MAX_BIN` bins once. Per pass every task routes its rows through the unfinished trees of all classes,
adds up gradients per (class, node, feature, bin) and sends these sums, whose size depends on the model and not on the rows. Sums are
whole numbers in fixed point, so they do not depend on the order of rows or on the number of partitions, and a node's larger child is
exactly its parent minus the smaller one: with many rows, only the smaller child's are added up. The driver holds the trees and the best split per node.

Depth-wise growth splits all nodes of a level; leaf-wise growth splits the leaf with the largest gain until `leaves` are there. Both
ask for the children of several nodes per pass: a leaf's gain does not depend on when it is found, so the order of growth
is replayed from what is known, and a pass asks for what the replay is missing.

Class scores of the rows are kept in the shared folder and brought up to date every few rounds; a lost executor costs a re-read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import written

MAX_BIN = 255
#: Bin of a missing value in the stored rows; the last bin of a histogram.
MISSING = 255
ROWS_A_TASK = 50_000
#: From so many rows on, sums are kept so that a larger child is its parent less the smaller one; below that, both are added up.
KEEP_SUMS_FROM = 1_000_000
#: Rounds whose trees are applied anew in every pass before the stored scores are renewed.
ROUNDS_KEPT = 8
#: Features of one histogram record.
BLOCK = 32
#: Bytes of histograms that a task may hold; more nodes are done in several passes.
HELD_BYTES = 128 << 20
DEEPEST = 60
#: Rows added up at once, few enough for sums in doubles to be exact.
CHUNK = 1 << 16
LEAST_HESSIAN = 1e-16


@dataclass(frozen=True)
class Rules:
    """How trees grow. `leaves` 0 is depth-wise; a fraction of 1 takes all; `bag_every` 0 draws no rows."""

    rounds: int
    rate: float
    l1: float
    l2: float
    max_step: float
    min_gain: float
    min_hessian: float
    min_rows: int
    max_depth: int
    leaves: int
    bag: float
    bag_every: int
    tree_cols: float
    level_cols: float
    seed: int
    scale_hessian: bool
    from_prior: bool

    @staticmethod
    def depth_wise(p: dict) -> Rules:
        """n_estimators, learning_rate, reg_alpha, reg_lambda, max_delta_step, min_split_loss, min_child_weight, max_depth, subsample, colsample_bytree, colsample_bylevel, random_state."""
        deep = int(p.get("max_depth", 6)) or DEEPEST
        return Rules(
            int(p.get("n_estimators", 100)), float(p.get("learning_rate", 0.3)), float(p.get("reg_alpha", 0.0)), float(p.get("reg_lambda", 1.0)),
            float(p.get("max_delta_step", 0.0)), float(p.get("min_split_loss", 0.0)), float(p.get("min_child_weight", 1.0)), 1, deep, 0,
            float(p.get("subsample", 1.0)), 1, float(p.get("colsample_bytree", 1.0)), float(p.get("colsample_bylevel", 1.0)),
            int(p.get("random_state", 42)), False, False,
        )

    @staticmethod
    def leaf_wise(p: dict) -> Rules:
        """n_estimators, learning_rate, lambda_l1, lambda_l2, max_delta_step, min_split_gain, min_child_weight, min_child_samples, max_depth, num_leaves, bagging_fraction, bagging_freq, feature_fraction, boost_from_average, random_state."""
        deep = int(p.get("max_depth", -1))
        return Rules(
            int(p.get("n_estimators", 100)), float(p.get("learning_rate", 0.1)), float(p.get("lambda_l1", 0.0)), float(p.get("lambda_l2", 0.0)),
            float(p.get("max_delta_step", 0.0)), float(p.get("min_split_gain", 0.0)), float(p.get("min_child_weight", 1e-3)),
            int(p.get("min_child_samples", 20)), deep if deep > 0 else DEEPEST, int(p.get("num_leaves", 31)), float(p.get("bagging_fraction", 1.0)),
            int(p.get("bagging_freq", 0)), float(p.get("feature_fraction", 1.0)), 1.0, int(p.get("random_state", 42)), True,
            str(p.get("boost_from_average", True)) != "False",
        )

    def checked(self) -> Rules:
        if self.max_depth > DEEPEST:
            raise ValueError(f"max_depth {self.max_depth} is beyond {DEEPEST}")
        if self.leaves == 1:
            raise ValueError("num_leaves is at least 2")
        return self


@dataclass
class Tree:
    """Nodes as parallel lists, the root first; feature -1 marks a leaf. Values up to `threshold` go left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    node: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, node: int, value: float = 0.0) -> int:
        for name, x in asdict(Tree()).items():
            getattr(self, name).append({"feature": -1, "left": -1, "right": -1, "node": node, "value": value}.get(name, 0))
        return len(self.node) - 1

    def _walk(self, n: int, goes_left) -> np.ndarray:
        at, feature, left, right = np.zeros(n, np.int64), np.array(self.feature), np.array(self.left), np.array(self.right)
        rows = np.arange(n)
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(goes_left(rows, here, feature[here]), left[here], right[here])
        return at

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Position of the leaf of every row of binned features."""
        cut, missing = np.array(self.bin), np.array(self.missing_left, bool)

        def goes_left(rows, here, feature):
            b = bins[rows, feature]
            return np.where(b == MISSING, missing[here], b <= cut[here])

        return self._walk(len(bins), goes_left)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Value of the leaf of every row of plain features."""
        cut, missing = np.array(self.threshold), np.array(self.missing_left, bool)

        def goes_left(rows, here, feature):
            v = x[rows, feature]
            return np.where(np.isnan(v), missing[here], v <= cut[here])

        return np.array(self.value)[self._walk(len(x), goes_left)]


# Features


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; absent values, and a null or shorter list's rest, are NaN."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.full((len(col), width), np.nan)
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(col)), size)
    at = np.arange(len(flat)) - start[row]
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def cut_points(df: DataFrame, width: int, max_bin: int = MAX_BIN) -> list[list[float]]:
    """Cuts per feature: between all values where a feature has at most `max_bin`, else at approximate quantiles. At most width * max_bin numbers."""
    cells = df.select(F.posexplode("features").alias("feature", "value")).where("value is not null and not isnan(value)")
    shares = [i / max_bin for i in range(1, max_bin)]
    found = cells.groupBy("feature").agg(F.approx_count_distinct("value", 0.02).alias("kinds"), F.percentile_approx("value", shares, 100 * max_bin).alias("q"))
    cuts: list[list[float]] = [[] for _ in range(width)]
    few = []
    for r in found.collect():
        cuts[r["feature"]] = sorted(set(r["q"]))
        if r["kinds"] <= 1.25 * max_bin:
            few.append(r["feature"])
    if few:
        values: dict[int, list[float]] = {f: [] for f in few}
        for r in cells.where(F.col("feature").isin(few)).distinct().collect():
            values[r["feature"]].append(r["value"])
        for f, vs in values.items():
            vs = sorted(set(vs))
            if len(vs) <= max_bin:
                cuts[f] = [m if math.isfinite(m := a + (b - a) / 2) and m < b else a for a, b in zip(vs, vs[1:])]
    return cuts


_ROWS = pa.schema([("row", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("bins", pa.binary()), ("scores", pa.binary())])
_ROWS_SQL = "row long, label int, weight double, bins binary, scores binary"


def _packed(a: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    a = np.ascontiguousarray(a)
    offsets = np.arange(len(a) + 1, dtype=np.int32) * (a.itemsize * a.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(a)])


def _unpacked(col: pa.Array, dtype, width: int) -> np.ndarray:
    _, off, data = col.buffers()
    at = np.frombuffer(off, np.int32)[col.offset]
    return np.frombuffer(data, dtype, len(col) * width, at).reshape(len(col), width) if width else np.empty((len(col), 0), dtype)


def _binned(cuts: list[list[float]], base: list[float]):
    def run(batches):
        edges = [np.array(c) for c in cuts]
        for b in batches:
            x = matrix(b.column(3), len(edges))
            bins = np.empty(x.shape, np.uint8)
            for j, e in enumerate(edges):
                bins[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(e, x[:, j], "left"))
            scores = np.tile(np.array(base), (len(x), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _packed(bins), _packed(scores)], schema=_ROWS)

    return run


# Gradients


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _key(*parts) -> int:
    return int.from_bytes(hashlib.md5("|".join(map(str, parts)).encode()).digest()[:8], "little")


def bagged(rows: np.ndarray, rules: Rules, round_: int) -> np.ndarray:
    """Which rows take part in a round: by a hash of row and bag, so whatever the partitioning."""
    if rules.bag >= 1.0 or rules.bag_every <= 0:
        return np.ones(len(rows), bool)
    u = _mixed(rows.view(np.uint64) ^ np.uint64(_key(rules.seed, "bag", round_ // rules.bag_every)))
    return (u >> np.uint64(11)).astype(np.float64) < rules.bag * 2.0**53


def drawn(features: list[int], share: float, *key) -> list[int]:
    """A share of the features, at least one, by a hash of the key."""
    if share >= 1.0:
        return features
    n = max(1, int(share * len(features)))
    return sorted(sorted(features, key=lambda f: _key(*key, f))[:n])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(scores: np.ndarray, label: np.ndarray, weight: np.ndarray, scale_hessian: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss by class score; the second times 2, or k / (k - 1) if `scale_hessian`."""
    p = softmax(scores)
    k = p.shape[1]
    factor = k / (k - 1) if scale_hessian and k > 1 else 2.0
    g = p.copy()
    g[np.arange(len(label)), label] -= 1.0
    h = np.maximum(factor * p * (1.0 - p), LEAST_HESSIAN)
    return g * weight[:, None], h * weight[:, None]


_SUMS = pa.schema([("cls", pa.int32()), ("node", pa.int64()), ("block", pa.int32()), ("kind", pa.int32()), ("hist", pa.binary())])
_SUMS_SQL = "cls int, node long, block int, kind int, hist binary"


@dataclass
class Pass:
    """What tasks need: trees to bring scores up to date, unfinished trees, and the nodes to add up per class with the node they are sent for."""

    round_: int
    recent: list[list[Tree]]
    open_trees: list[Tree]
    build: list[dict[int, int]]
    features: list[list[int]]
    bins: int
    bits: int


def _sums(job: Pass, rules: Rules, classes: int, width: int):
    """Gradient sums per (class, node, block of features): int64 [count, gradient, hessian] x feature x bin."""

    def run(batches):
        held: list[np.ndarray | None] = [None] * classes
        lots = job.bins + 1
        slots = [{n: i for i, n in enumerate(b)} for b in job.build]
        for b in batches:
            rows = b.column(0).to_numpy()
            label, weight = b.column(1).to_numpy(), b.column(2).to_numpy()
            bins_all, scores_all = _unpacked(b.column(3), np.uint8, width), _unpacked(b.column(4), np.float64, classes).copy()
            for s in range(0, len(rows), CHUNK):
                part = slice(s, s + CHUNK)
                bins, scores = bins_all[part], scores_all[part]
                _add_trees(scores, bins, job.recent)
                g, h = gradients(scores, label[part], weight[part], rules.scale_hessian)
                inside = bagged(rows[part], rules, job.round_)
                for c in range(classes):
                    if not slots[c]:
                        continue
                    tree = job.open_trees[c]
                    slot_of = np.array([slots[c].get(n, -1) for n in tree.node])
                    # Rows of an inner node that is added up are in its subtree.
                    slot = slot_of[tree.places(bins)]
                    take = np.flatnonzero(inside & (slot >= 0))
                    cols = np.array(job.features[c])
                    if held[c] is None:
                        held[c] = np.zeros((3, len(slots[c]), len(cols), lots), np.int64)
                    if not len(take):
                        continue
                    where = np.minimum(bins[np.ix_(take, cols)].astype(np.int64), job.bins)
                    where += (slot[take][:, None] * len(cols) + np.arange(len(cols))[None, :]) * lots
                    where, size = where.ravel(), held[c][0].size
                    held[c][0] += np.bincount(where, minlength=size).reshape(held[c][0].shape)
                    for i, v in ((1, g[take, c]), (2, h[take, c])):
                        whole = np.rint(np.ldexp(v, job.bits))
                        held[c][i] += np.bincount(where, np.repeat(whole, len(cols)), size).astype(np.int64).reshape(held[c][i].shape)
        out: list[list] = [[] for _ in _SUMS]
        for c, h in enumerate(held):
            if h is None:
                continue
            for (_, sent_for), i in zip(job.build[c].items(), range(h.shape[1])):
                for block, s in enumerate(range(0, h.shape[2], BLOCK)):
                    for col, v in zip(out, (c, sent_for, block, 0, np.ascontiguousarray(h[:, i, s : s + BLOCK]).tobytes())):
                        col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _SUMS)], schema=_SUMS)

    return run


def _add_trees(scores: np.ndarray, bins: np.ndarray, rounds: list[list[Tree]]) -> None:
    for trees in rounds:
        for c, t in enumerate(trees):
            scores[:, c] += np.array(t.value)[t.places(bins)]


def _rescored(recent: list[list[Tree]], classes: int, width: int):
    def run(batches):
        for b in batches:
            scores = _unpacked(b.column(4), np.float64, classes).copy()
            _add_trees(scores, _unpacked(b.column(3), np.uint8, width), recent)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], _packed(scores)], schema=_ROWS)

    return run


# Splits


def leaf_value(g, h, rules: Rules):
    """Newton step with an L1 threshold and an L2 term, at most max_step long."""
    w = -np.sign(g) * np.maximum(np.abs(g) - rules.l1, 0.0) / np.maximum(h + rules.l2, LEAST_HESSIAN)
    return np.clip(w, -rules.max_step, rules.max_step) if rules.max_step > 0 else w


def merit(g, h, rules: Rules):
    """Twice the loss that a leaf's value saves."""
    if rules.max_step > 0:
        w = leaf_value(g, h, rules)
        return -(2.0 * g * w + (h + rules.l2) * w * w + 2.0 * rules.l1 * np.abs(w))
    t = np.maximum(np.abs(g) - rules.l1, 0.0)
    return t * t / np.maximum(h + rules.l2, LEAST_HESSIAN)


def best_split(hist: np.ndarray, features: np.ndarray, cuts: np.ndarray, allowed: np.ndarray, bits: int, rules: Rules):
    """Best split of a node over a block of features, or None: (gain, feature, bin, missing_left, sums left, sums right).

    `hist` is [3, feature, bin], missing last; `cuts` counts each feature's cuts. Ties: smallest feature, then bin, then missing right.
    """
    missing = hist[:, :, -1:]
    left = np.cumsum(hist[:, :, :-1], axis=2)
    total = left[:, :, -1:] + missing
    sides = np.stack([left, left + missing], axis=-1)  # [3, feature, bin, missing left]
    rest = total[..., None] - sides
    gl, hl, gr, hr = (np.ldexp(x.astype(np.float64), -bits) for x in (sides[1], sides[2], rest[1], rest[2]))
    whole = merit(np.ldexp(total[1].astype(np.float64), -bits), np.ldexp(total[2].astype(np.float64), -bits), rules)
    gain = merit(gl, hl, rules) + merit(gr, hr, rules) - whole[..., None]
    at_cut = np.arange(left.shape[2])[None, :] <= cuts[:, None]
    ok = at_cut[..., None] & (sides[0] >= max(1, rules.min_rows)) & (rest[0] >= max(1, rules.min_rows)) & (hl >= rules.min_hessian) & (hr >= rules.min_hessian)
    ok &= np.isin(features, allowed)[:, None, None] & (gain > 1e-12)
    # Nobody missing: both directions are the same split.
    ok[..., 1] &= missing[0] > 0
    if not ok.any():
        return None
    gain = np.where(ok, gain, -np.inf)
    f, b, m = np.unravel_index(int(gain.argmax()), gain.shape)
    sl, sr = sides[:, f, b, m], rest[:, f, b, m]
    goes_left = bool(m) if missing[0, f, 0] else bool(sl[0] >= sr[0])
    return float(gain[f, b, m]), int(features[f]), int(b), goes_left, sl, sr


_SPLIT = [("cls", "int"), ("node", "long"), ("block", "int"), ("gain", "double"), ("feature", "int"), ("cut", "int"), ("missing_left", "boolean")]
_SPLIT += [(f"{s}{x}", "long") for s in "lr" for x in "ngh"] + [(x, "long") for x in ("n", "g", "h")] + [("hist", "binary")]
_SPLIT_SQL = ", ".join(f"{n} {t}" for n, t in _SPLIT)
_ARROW_TYPES = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
_SPLITS = pa.schema([(n, _ARROW_TYPES[t]) for n, t in _SPLIT])


def _splits(small: dict[tuple[int, int], int], features: list[list[int]], cuts: list[int], allowed, lots: int, bits: int, rules: Rules):
    """Sums the parts of a node's records, sorted together, and finds the best splits of the node, or of its two children."""

    def run(batches):
        now, part, parent = None, None, None
        out: list[list] = [[] for _ in _SPLITS]

        def close():
            cls, node, block = now
            cols = np.array(features[cls][block * BLOCK : (block + 1) * BLOCK])
            child = small.get((cls, node))
            if part is None:
                return
            nodes = [(node, part)] if child is None else [(child, part), (child ^ 1, parent - part)]
            for which, hist in nodes:
                total = hist[:, 0].sum(1)
                best = best_split(hist, cols, np.array([cuts[f] for f in cols]), np.array(allowed(cls, which)), bits, rules)
                row = (best[0], best[1], best[2], best[3], *best[4].tolist(), *best[5].tolist()) if best else (None,) * 10
                for col, v in zip(out, (cls, which, block, *row, *total.tolist(), hist.tobytes())):
                    col.append(v)

        for b in batches:
            for cls, node, block, kind, data in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (cls, node, block) != now:
                    if now is not None:
                        close()
                    now, part, parent = (cls, node, block), None, None
                hist = np.frombuffer(data, np.int64).reshape(3, -1, lots)
                if kind:
                    parent = hist
                else:
                    part = hist if part is None else part + hist
        if now is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _SPLITS)], schema=_SPLITS)

    return run


@dataclass
class _Found:
    """A node's best split, and its sums."""

    n: int
    g: int
    h: int
    split: tuple | None = None  # (gain, feature, bin, missing_left, (n, g, h) left, (n, g, h) right)


def _depth(node: int) -> int:
    return node.bit_length() - 1


class _Growth:
    """One class's tree of a round: nodes known so far by heap number (root 1, children 2n and 2n + 1)."""

    def __init__(self, rules: Rules):
        self.rules, self.known = rules, {}

    def _may_split(self, node: int) -> bool:
        found = self.known.get(node)
        return found is not None and found.split is not None and _depth(node) < self.rules.max_depth

    def _asks(self, node: int) -> bool:
        """Whether the children's best splits are wanted and not known."""
        return _depth(node) + 1 < self.rules.max_depth and 2 * node not in self.known

    def replay(self) -> tuple[list[int], list[int]]:
        """(nodes that split, in order; nodes whose children's splits must be found before that is certain)."""
        if self.rules.leaves == 0:
            inner = [n for n in sorted(self.known) if self._may_split(n)]
            asked = [n for n in inner if self._asks(n)]
            return ([] if asked else self._pruned(inner)), asked
        inner, asked = [], []
        heap = [(-self.known[1].split[0], 1)] if self._may_split(1) and self._enough(1) else []
        while heap and len(inner) + 1 < self.rules.leaves:
            _, node = heapq.heappop(heap)
            inner.append(node)
            if self._asks(node):
                asked.append(node)
            for child in (2 * node, 2 * node + 1):
                if self._may_split(child) and self._enough(child):
                    heapq.heappush(heap, (-self.known[child].split[0], child))
        # A node asked for as the very last split needs no children.
        if asked == inner[-1:] and len(inner) + 1 == self.rules.leaves:
            asked = []
        return inner, asked

    def _enough(self, node: int) -> bool:
        return self.known[node].split[0] > self.rules.min_gain

    def _pruned(self, inner: list[int]) -> list[int]:
        """Bottom up, a split without splits below it goes if its gain is below min_gain."""
        left = set(inner)
        for node in reversed(inner):
            if self.known[node].split[0] < self.rules.min_gain and 2 * node not in left and 2 * node + 1 not in left:
                left.discard(node)
        return [n for n in inner if n in left]

    def tree(self, inner: list[int], cuts: list[list[float]], bits: int) -> Tree:
        """The tree with these inner nodes; every other node is a leaf with its value."""
        tree, chosen = Tree(), set(inner)
        root = self.known[1]

        def grow(node: int, sums) -> int:
            g, h = (math.ldexp(float(x), -bits) for x in sums[1:])
            at = tree.add(node, float(leaf_value(g, h, self.rules)) * self.rules.rate)
            if node in chosen:
                gain, f, b, missing_left, left, right = self.known[node].split
                tree.feature[at], tree.bin[at], tree.missing_left[at], tree.gain[at] = f, b, missing_left, gain
                tree.threshold[at] = cuts[f][b] if b < len(cuts[f]) else math.inf
                tree.left[at] = grow(2 * node, left)
                tree.right[at] = grow(2 * node + 1, right)
            return at

        grow(1, (root.n, root.g, root.h))
        return tree


# Fitting


@dataclass
class FittedBoost:
    """A fitted booster: start scores and the trees of every round, one per class."""

    kind: str
    params: dict
    base: list[float]
    rounds: list[list[Tree]]
    width: int

    def __call__(self, df: DataFrame) -> DataFrame:
        scored = self.scores(df, "_scores")
        # The first position of the maximum is the lowest class.
        return scored.select(*df.columns, (F.array_position("_scores", F.array_max("_scores")) - 1).cast("int").alias("pred"))

    def raw(self, x: np.ndarray, rounds: int | None = None) -> np.ndarray:
        """Class scores before the softmax."""
        out = np.tile(np.array(self.base), (len(x), 1))
        for trees in self.rounds[:rounds]:
            for c, t in enumerate(trees):
                out[:, c] += t.scores(x)
        return out

    def scores(self, df: DataFrame, out: str) -> DataFrame:
        """The input rows plus class probabilities; absent features count as missing."""
        width = self.width

        @F.pandas_udf("array<double>")
        def probabilities(features: pd.Series) -> pd.Series:
            return pd.Series(list(softmax(self.raw(matrix(pa.array(features, pa.list_(pa.float64())), width)))))

        return df.select(*df.columns, probabilities(F.col("features").cast("array<double>")).alias(out))

    def log_loss(self, df: DataFrame) -> DataFrame:
        """(round, loss): mean log loss of the labelled rows after each round, 0 before the first."""
        width, n = self.width, len(self.rounds)

        def run(batches):
            total, rows = np.zeros(n + 1), 0
            for b in batches:
                x, label = matrix(b.column(0), width), b.column(1).to_numpy()
                scores = np.tile(np.array(self.base), (len(x), 1))
                for r in range(n + 1):
                    if r:
                        for c, t in enumerate(self.rounds[r - 1]):
                            scores[:, c] += t.scores(x)
                    total[r] -= np.log(np.maximum(softmax(scores)[np.arange(len(x)), label], 1e-300)).sum()
                rows += len(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 1), pa.int32()), pa.array(total), pa.array([rows] * (n + 1), pa.int64())], names=["round", "loss", "n"])

        known = df.where("label is not null").select(F.col("features").cast("array<double>"), F.col("label").cast("int"))
        parts = known.mapInArrow(run, "round int, loss double, n long")
        return parts.groupBy("round").agg((F.sum("loss") / F.sum("n")).alias("loss"))

    def trees(self, spark: SparkSession) -> DataFrame:
        """One row per node: round, cls, node (heap number), feature (null in leaves), threshold, gain, value."""
        rows = [
            (r, c, t.node[i], f if (f := t.feature[i]) >= 0 else None, t.threshold[i] if f >= 0 else None, t.gain[i] if f >= 0 else None, t.value[i])
            for r, trees in enumerate(self.rounds)
            for c, t in enumerate(trees)
            for i in range(len(t.node))
        ]
        return spark.createDataFrame(rows, "round int, cls int, node long, feature int, threshold double, gain double, value double")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FittedBoost:
        d = json.loads(text)
        return FittedBoost(d["kind"], d["params"], d["base"], [[Tree(**t) for t in trees] for trees in d["rounds"]], d["width"])


def fit(df: DataFrame, rules: Rules, kind: str, params: dict | None = None, classes: int | None = None, weight: str | None = None) -> FittedBoost:
    """Boosts class scores of `df` (features array<double>, label int from 0, optional weight column).

    Rows with a null label are left out; null and NaN features are missing and go the way that gains most. Rows are drawn
    by a hash of their features and label, so equal rows are drawn together. Under one seed the result is the same whatever the partitions.
    """
    rules.checked()
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where("label is not null").select(
        F.xxhash64("features", "label").alias("row"), F.col("label").cast("int").alias("label"), w.alias("weight"), F.col("features").cast("array<double>").alias("features")
    )
    seen = rows.agg(F.max(F.size("features")).alias("d"), F.max("label").alias("k"), F.min("label").alias("low"), F.sum("weight").alias("w"), F.max("weight").alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not seen["n"]:
        raise ValueError("no labelled rows")
    if seen["low"] < 0:
        raise ValueError("labels count from 0")
    width, classes = max(0, seen["d"] or 0), max(int(classes or 0), seen["k"] + 1)
    cuts = cut_points(rows, width)
    base = [0.0] * classes
    if rules.from_prior:
        held = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        base = [math.log(max(held.get(c, 0.0) / seen["w"], 1e-15)) for c in range(classes)]
    parts = max(1, math.ceil(seen["n"] / ROWS_A_TASK))
    state = written(rows.repartition(parts, "row").mapInArrow(_binned(cuts, base), _ROWS_SQL), "boost_rows")
    # Sums of all rows fit 62 bits, those of a chunk 52.
    bits = min(36 - math.ceil(math.log2(max(1.0, seen["top"]))), 60 - math.ceil(math.log2(max(2.0, seen["w"]))))
    model = FittedBoost(kind, params or {}, base, [], width)
    recent: list[list[Tree]] = []
    for r in range(rules.rounds):
        trees = _round(state, r, recent, rules, cuts, classes, width, bits, seen["n"] >= KEEP_SUMS_FROM)
        model.rounds.append(trees)
        recent.append(trees)
        if len(recent) == ROUNDS_KEPT and r + 1 < rules.rounds:
            state = written(state.mapInArrow(_rescored(recent, classes, width), _ROWS_SQL), "boost_rows")
            recent = []
    return model


def _round(state: DataFrame, round_: int, recent: list[list[Tree]], rules: Rules, cuts: list[list[float]], classes: int, width: int, bits: int, keep_sums: bool) -> list[Tree]:
    features = [drawn(list(range(width)), rules.tree_cols, rules.seed, "tree", round_, c) for c in range(classes)]
    bins = max([len(c) for c in cuts], default=0) + 1
    growth = [_Growth(rules) for _ in range(classes)]
    kept: dict[tuple[int, int], DataFrame] = {}
    n_cuts = [len(c) for c in cuts]
    seed, share = rules.seed, rules.level_cols
    at_once = max(1, HELD_BYTES // max(1, classes * width * (bins + 1) * 48))

    def allowed(cls: int, node: int) -> list[int]:
        return drawn(features[cls], share, seed, "level", round_, cls, _depth(node))

    asked: list[list[int]] = [[0]] * classes  # 0 stands for "above the root"
    while width and any(asked):
        lot = [a[:at_once] for a in asked]
        build: list[dict[int, int]] = [{} for _ in range(classes)]
        small: dict[tuple[int, int], int] = {}
        open_trees = []
        for c, nodes in enumerate(lot):
            known = growth[c].known
            for node in nodes:
                if node == 0:
                    build[c][1] = 1
                    continue
                left, right = known[node].split[4:]
                if (c, node) in kept:
                    child = 2 * node + (left[0] > right[0])
                    small[c, node] = child
                    build[c][child] = node
                else:
                    build[c] |= {2 * node: 2 * node, 2 * node + 1: 2 * node + 1}
            open_trees.append(_open_tree(growth[c], set(nodes)))
        job = Pass(round_, recent, open_trees, build, features, bins, bits)
        sums = state.mapInArrow(_sums(job, rules, classes, width), _SUMS_SQL)
        for t in {id(kept[at]): kept[at] for at in small}.values():
            wanted = F.struct("cls", "node").isin([F.struct(F.lit(c), F.lit(n).cast("long")) for c, n in small if kept[c, n] is t])
            sums = sums.unionByName(t.where(wanted).select("cls", "node", "block", F.lit(1).alias("kind"), "hist"))
        placed = sums.repartition("cls", "node", "block").sortWithinPartitions("cls", "node", "block")
        found = placed.mapInArrow(_splits(small, features, n_cuts, allowed, bins + 1, bits, rules), _SPLIT_SQL)
        # Sums are kept for nodes whose children may be looked at later.
        keep = keep_sums and any((_depth(n) + 1 if n else 0) + 1 < rules.max_depth for nodes in lot for n in nodes)
        if keep:
            found = written(found, "boost_splits")
        best: dict[tuple[int, int], tuple] = {}
        for row in found.drop("hist").collect():  # classes x nodes x blocks
            at = (row["cls"], row["node"])
            if at not in best or (row["gain"] is not None and (best[at]["gain"] is None or (-row["gain"], row["feature"]) < (-best[at]["gain"], best[at]["feature"]))):
                best[at] = row
        for (c, node), row in best.items():
            split = None
            if row["gain"] is not None:
                sides = [tuple(row[f"{s}{x}"] for x in "ngh") for s in "lr"]
                split = (row["gain"], row["feature"], row["cut"], row["missing_left"], *sides)
            if keep:
                kept[c, node] = found
            growth[c].known[node] = _Found(row["n"], row["g"], row["h"], split)
        # A class whose bag is empty has no root.
        asked = [g.replay()[1] if 1 in g.known else [] for g in growth]
    out = []
    for g in growth:
        if 1 not in g.known:
            t = Tree()
            t.add(1)
            out.append(t)
        else:
            out.append(g.tree(g.replay()[0], cuts, bits))
    return out


def _open_tree(growth: _Growth, asked: set[int]) -> Tree:
    """Routes rows to the children of the asked nodes; what leads nowhere near them ends early."""
    if asked <= {0}:
        tree = Tree()
        tree.add(1)
        return tree
    inner = set()
    for node in asked:
        while node:
            inner.add(node)
            node //= 2
    tree = Tree()

    def grow(node: int) -> int:
        at = tree.add(node)
        if node in inner:
            _, f, b, missing_left, _, _ = growth.known[node].split
            tree.feature[at], tree.bin[at], tree.missing_left[at] = f, b, missing_left
            tree.left[at] = grow(2 * node)
            tree.right[at] = grow(2 * node + 1)
        return at

    grow(1)
    return tree
