"""Boosted trees against a brute-force version that sums the rows of every node anew."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harrow.operators import boosting as B
from harrow.operators import models as L
from harrow.session import scratch_path

LEVELS = (2, 5, 9, 40)


def _data(seed, n=400, classes=3, missing=False):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, k, n) * 1.5 for k in LEVELS], axis=1).astype(float)
    y = ((x[:, 1] > 3).astype(int) + (x[:, 2] + 4 * x[:, 0] > 8) + (rng.random(n) < 0.15)) % classes
    if missing:
        x[rng.random(x.shape) < 0.1] = np.nan
    return x, y


def _frame(spark, x, y, parts=3):
    rows = [(i, [None if math.isnan(v) and i % 2 else float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(parts)


def _cuts(x):
    known = [np.unique(v[~np.isnan(v)]) for v in x.T]
    return [[*((k[:-1] + k[1:]) / 2), np.inf] for k in known]


def _brute_split(x, g, h, rules, cuts):
    best = None
    whole = B.merit(g.sum(), h.sum(), rules)
    for f in range(x.shape[1]):
        v = x[:, f]
        for c in cuts[f]:
            for missing_left in (False, True) if np.isnan(v).any() else (False,):
                left = np.where(np.isnan(v), missing_left, v <= c)
                sides = [left, ~left]
                if any(s.sum() < max(1, rules.min_rows) or h[s].sum() < rules.min_hessian for s in sides):
                    continue
                gain = sum(B.merit(g[s].sum(), h[s].sum(), rules) for s in sides) - whole
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, c, left)
    return best


def _brute_tree(x, g, h, rules):
    """{heap number: (feature, threshold) or None} and each row's value."""
    rows, cuts = {1: np.arange(len(x))}, _cuts(x)
    split = {1: _brute_split(x, g, h, rules, cuts)}

    def grow(node):
        _, _, _, left = split[node]
        for child, side in ((2 * node, left), (2 * node + 1, ~left)):
            rows[child] = rows[node][side]
            r = rows[child]
            split[child] = _brute_split(x[r], g[r], h[r], rules, cuts) if child.bit_length() - 1 < rules.max_depth else None

    inner = []
    if rules.leaves:
        heap = [(-split[1][0], 1)] if split[1] and split[1][0] > rules.min_gain else []
        while heap and len(inner) + 1 < rules.leaves:
            _, node = heapq.heappop(heap)
            inner.append(node)
            grow(node)
            for child in (2 * node, 2 * node + 1):
                if split[child] and split[child][0] > rules.min_gain:
                    heapq.heappush(heap, (-split[child][0], child))
    else:
        todo = [1]
        while todo:
            node = todo.pop(0)
            if split[node]:
                inner.append(node)
                grow(node)
                todo += [2 * node, 2 * node + 1]
        for node in sorted(inner, reverse=True):
            if split[node][0] < rules.min_gain and 2 * node not in inner and 2 * node + 1 not in inner:
                inner.remove(node)
    value = np.zeros(len(x))
    nodes = {}
    for node in sorted(rows):
        if node == 1 or node // 2 in inner:
            nodes[node] = (split[node][1], split[node][2]) if node in inner else None
            if node not in inner:
                value[rows[node]] = rules.rate * B.leaf_value(g[rows[node]].sum(), h[rows[node]].sum(), rules)
    return nodes, value


def _brute_boost(x, y, rules, classes, base):
    scores, out = np.tile(base, (len(x), 1)), []
    for _ in range(rules.rounds):
        g, h = B.gradients(scores, y, np.ones(len(y)), rules.scale_hessian)
        trees = [_brute_tree(x, g[:, c], h[:, c], rules) for c in range(classes)]
        for c, (_, value) in enumerate(trees):
            scores[:, c] += value
        out.append([nodes for nodes, _ in trees])
    return out, scores


CASES = {
    "plain": ("depth", {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5}),
    "penalised": ("depth", {"n_estimators": 2, "max_depth": 3, "reg_alpha": 2.0, "reg_lambda": 3.0, "min_split_loss": 1.0, "min_child_weight": 4.0}),
    "stepped": ("depth", {"n_estimators": 2, "max_depth": 2, "max_delta_step": 0.3, "reg_alpha": 0.5}),
    "deep": ("depth", {"n_estimators": 10, "max_depth": 1, "learning_rate": 0.4}),
    "leaves": ("leaf", {"n_estimators": 3, "num_leaves": 6, "min_child_samples": 5, "learning_rate": 0.4}),
    "leaves_capped": ("leaf", {"n_estimators": 2, "num_leaves": 12, "max_depth": 3, "min_child_samples": 3, "lambda_l1": 0.5, "lambda_l2": 1.0, "min_split_gain": 0.5}),
    "few_leaves": ("leaf", {"n_estimators": 2, "num_leaves": 2, "boost_from_average": False}),
}


@pytest.mark.parametrize("missing", (False, True))
@pytest.mark.parametrize("name", CASES)
def test_trees_equal_brute_force(spark, name, missing, monkeypatch):
    monkeypatch.setattr(B, "KEEP_SUMS_FROM", 0 if missing or name == "leaves" else 10**9)
    flavour, params = CASES[name]
    x, y = _data(len(name), missing=missing)
    rules = B.Rules.leaf_wise(params) if flavour == "leaf" else B.Rules.depth_wise(params)
    model = L.fit_gbt(_frame(spark, x, y), params, flavour)
    trees, scores = _brute_boost(x, y, rules, 3, np.array(model.base))
    for got, want in zip(model.rounds, trees, strict=True):
        for t, nodes in zip(got, want, strict=True):
            assert {n: (f, c) if f >= 0 else None for n, f, c in zip(t.node, t.feature, t.threshold)} == nodes
    assert np.allclose(model.raw(x), scores, atol=1e-6)
    if flavour == "leaf":
        assert all(sum(f < 0 for f in t.feature) <= params["num_leaves"] for r in model.rounds for t in r)


def test_seeded_result_does_not_depend_on_partitions(spark):
    x, y = _data(9, 600)
    for flavour, params in (
        ("depth", {"n_estimators": 3, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.7, "colsample_bylevel": 0.7, "class_weight": "balanced", "random_state": 3}),
        ("leaf", {"n_estimators": 4, "num_leaves": 7, "bagging_fraction": 0.6, "bagging_freq": 2, "feature_fraction": 0.6}),
    ):
        models = [L.fit_gbt(_frame(spark, x, y, parts), params, flavour).to_json() for parts in (1, 7)]
        assert models[0] == models[1]
        other = L.fit_gbt(_frame(spark, x, y), params | {"random_state": 4}, flavour).to_json()
        assert other != models[0].replace('"random_state": 3', '"random_state": 4')


def test_bags_and_draws():
    rules = B.Rules.leaf_wise({"bagging_fraction": 0.3, "bagging_freq": 2})
    rows = np.random.default_rng(1).integers(-(2**63), 2**63, 20_000)
    bags = [B.bagged(rows, rules, r) for r in range(4)]
    assert (bags[0] == bags[1]).all() and (bags[2] == bags[3]).all() and (bags[0] != bags[2]).any()
    assert all(abs(b.mean() - 0.3) < 0.02 for b in bags)
    assert B.bagged(rows, B.Rules.leaf_wise({"bagging_fraction": 0.3}), 0).all()
    assert B.drawn(list(range(10)), 0.01, 1) == B.drawn(list(range(10)), 0.01, 1) and len(B.drawn(list(range(10)), 0.35, 1)) == 3


def test_children_of_several_passes(spark, monkeypatch):
    """Too many nodes for one pass: the same trees in more passes."""
    x, y = _data(4)
    params = {"n_estimators": 1, "num_leaves": 9, "min_child_samples": 3}
    whole = L.fit_gbt(_frame(spark, x, y), params, "leaf").to_json()
    monkeypatch.setattr(B, "KEEP_SUMS_FROM", 0)
    monkeypatch.setattr(B, "HELD_BYTES", 1)
    assert L.fit_gbt(_frame(spark, x, y), params, "leaf").to_json() == whole


def test_loss_falls_every_round_and_scores_add_up(spark):
    x, y = _data(2, missing=True)
    df = _frame(spark, x, y)
    model = L.fit_gbt(df, {"n_estimators": 10, "max_depth": 2, "learning_rate": 0.3, "num_class": 4})
    loss = [r["loss"] for r in model.log_loss(df).orderBy("round").collect()]
    assert loss[0] == pytest.approx(math.log(4)) and all(a > b for a, b in zip(loss, loss[1:])) and len(loss) == 11
    rows = model.scores(df, "p").collect()
    assert all(sum(r["p"]) == pytest.approx(1.0) and len(r["p"]) == 4 for r in rows)
    assert {r["id"]: r["pred"] for r in model(df).collect()} == {r["id"]: int(np.argmax(r["p"])) for r in rows}
    table = model.trees(spark)
    assert table.where("feature is null").count() == table.where("feature is not null").count() + 40


def test_odd_rows(spark):
    rows = [(0, None, 0), (1, [1.0, None], 1), (2, [2.0, 5.0], 0), (3, [], 1), (4, [float("nan"), 1.0, 7.0], 0), (5, [1.0, 2.0], None)] * 4
    df = spark.createDataFrame(rows, "id long, features array<double>, label int").withColumn("row", F.lit("clash")).withColumn("bins", F.lit(1))
    model = L.fit_gbt(df, {"n_estimators": 2, "max_depth": 2, "min_child_weight": 0.0})
    assert model(df).count() == 24 and model.width == 3
    with pytest.raises(ValueError, match="no labelled rows"):
        L.fit_gbt(df.where("label is null"), {})
    one = L.fit_gbt(df.where("label = 0"), {"n_estimators": 1})
    assert one(df).select("pred").distinct().collect() == [(0,)]


def test_many_values_use_quantiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v), float(i % 3)], int(v > 0.4)) for i, v in enumerate(rng.normal(size=3000))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    cuts = B.cut_points(df, 2, 64)
    assert 40 <= len(cuts[0]) <= 64 and cuts[1] == [0.5, 1.5]
    model = L.fit_gbt(df, {"n_estimators": 3, "max_depth": 2, "learning_rate": 1.0})
    assert model(df).where("pred <> label").count() < 60


def test_saved_boosters_predict_the_same(spark):
    x, y = _data(6)
    df = _frame(spark, x, y)
    model = L.fit_gbt(df, {"n_estimators": 2, "num_leaves": 5}, "leaf")
    root = scratch_path(spark, "models")
    L.save_model(model, root, "boost")
    loaded = L.load_model(spark, root, "boost")
    assert loaded == model and {r["id"]: r["pred"] for r in L.predict(df, loaded, "m").collect()} == {r["id"]: r["pred"] for r in model(df).collect()}
