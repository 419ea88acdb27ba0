"""Estimators: better than guessing on separable data, same result under the same seed, save and load."""

import json

import pytest
from pyspark.sql import functions as F

from harrow.functions.values import unit_hash
from harrow.operators import clustering as C
from harrow.operators import folds as K
from harrow.operators import models as L
from harrow.operators import runs as R
from harrow.operators import search as H
from harrow.session import scratch_path
from harrow.sources import runtree as T


@pytest.fixture(scope="module")
def blobs(spark):
    """Three classes around three centres."""
    label = (F.col("id") % 3).cast("int")
    noise = lambda k: (unit_hash(F.lit(k), F.col("id")) - 0.5) * 2.0
    centre = lambda a, b, c: F.when(label == 0, a).when(label == 1, b).otherwise(c)
    feats = F.array(centre(0.0, 4.0, 0.0) + noise("a"), centre(0.0, 0.0, 4.0) + noise("b"), noise("c"))
    df = spark.range(240).select("id", feats.alias("features"), label.alias("label"))
    return K.stratified_folds(df, "label", 3, ["id"]).cache()


FITS = {
    "rf": (L.fit_rf, {"n_estimators": 5, "max_depth": 4, "class_weight": "balanced"}),
    "gbt": (L.fit_gbt, {"n_estimators": 3, "max_depth": 3, "num_class": 3}),
    "lgbm": (lambda d, p: L.fit_gbt(d, p, "leaf"), {"n_estimators": 3, "num_leaves": 8, "min_child_samples": 2}),
    "svc": (L.fit_svc, {"kernel": "linear", "C": 10.0, "class_weight": "balanced", "max_iter": 10}),
    "svc_rbf": (L.fit_svc, {"kernel": "rbf", "C": 10.0, "gamma": "scale", "max_iter": 10}),
    "svc_poly": (L.fit_svc, {"kernel": "poly", "degree": 2, "C": 10.0, "max_iter": 10}),
    "mlp": (L.fit_mlp, {"hidden_layer_sizes": (6,), "max_iter": 40}),
}


@pytest.mark.parametrize("name", FITS)
def test_learns(blobs, name):
    fit, params = FITS[name]
    train, held = blobs.where("fold <> 1"), blobs.where("fold = 1")
    pred = fit(train, params)(held)
    assert pred.agg(F.avg((F.col("label") == F.col("pred")).cast("int"))).first()[0] > 0.9


@pytest.mark.parametrize("how", ["soft", "hard"])
def test_vote(blobs, how):
    params = {"svc": {"kernel": "linear", "max_iter": 10}, "rf": {"n_estimators": 3, "max_depth": 3}, "mlp": {"hidden_layer_sizes": 5, "max_iter": 20}}
    pred = L.fit_vote(blobs, params, how, {"rf": 2.0})(blobs)
    assert pred.agg(F.avg((F.col("label") == F.col("pred")).cast("int"))).first()[0] > 0.9


def test_search_is_repeatable_and_complete(spark, blobs):
    space = {"n_estimators": ("int", 2, 4), "max_depth": ("int", 2, 3)}
    a = H.run_search(blobs, space, 3, 3, L.fit_rf, seed=5)
    rows = a.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == [0, 1, 2] and all(r["folds"] == 3 for r in rows)
    assert all(r["f1"] > 0.8 for r in rows)
    b = H.run_search(blobs, space, 3, 3, L.fit_rf, seed=5).orderBy("trial").collect()
    assert [(r["params"], r["accuracy"]) for r in rows] == [(r["params"], r["accuracy"]) for r in b]
    assert set(H.best_config(a)) == {"n_estimators", "max_depth"}


def test_samples_stay_in_their_space(spark):
    space = {"u": ("uniform", -1.0, 2.0), "l": ("loguniform", 0.001, 10.0), "i": ("int", 3, 5), "c": ("choice", ["x", "y"])}
    rows = H.search(spark, space, 500, 9).collect()
    assert all(-1 <= r["u"] <= 2 and 0.001 <= r["l"] <= 10 and r["i"] in (3, 4, 5) and r["c"] in "xy" for r in rows)
    assert {r["i"] for r in rows} == {3, 4, 5} and {r["c"] for r in rows} == {"x", "y"}
    assert 180 < sum(r["l"] < 0.1 for r in rows) < 320


def test_save_and_load_keeps_the_feature_map(spark, blobs):
    model = L.fit_svc(blobs, {"kernel": "rbf", "C": 10.0, "max_iter": 5})
    root = scratch_path(spark, "models")
    L.save_model(model, root, "svc")
    loaded = L.load_model(spark, root, "svc")
    a = {r["id"]: r["pred"] for r in model(blobs).collect()}
    named = L.predict(blobs, loaded, "svc", "fp")
    assert {r["id"]: r["pred"] for r in named.collect()} == a
    assert named.select("model", "model_fp").distinct().collect() == [("svc", "fp")]


def test_save_and_load_an_ensemble(spark, blobs):
    vote = L.fit_vote(blobs, {"svc": {"kernel": "linear", "max_iter": 5}, "rf": {"n_estimators": 3, "max_depth": 3}}, "hard", {"rf": 2.0})
    root = scratch_path(spark, "models")
    L.save_model(vote, root, "both")
    loaded = L.load_model(spark, root, "both")
    assert list(loaded.members) == ["svc", "rf"] and loaded.how == "hard" and loaded.weights == {"rf": 2.0}
    assert {r["id"]: r["pred"] for r in loaded(blobs).collect()} == {r["id"]: r["pred"] for r in vote(blobs).collect()}


def test_save_and_load_centres(spark):
    root, centres = scratch_path(spark, "models"), [[0.0, 1.5], [2.0, 3.0, 4.0]]
    C.save_centres(spark, centres, root, "k")
    assert C.load_centres(spark, root, "k") == centres


def test_search_log_agrees_with_the_trials(spark, blobs):
    space, root = {"n_estimators": ("int", 2, 4)}, scratch_path(spark, "log")
    H.log_search(blobs, space, 2, 3, L.fit_rf, root, "e", seed=5)
    trials = {f"e-{r['trial']}": r for r in H.run_search(blobs, space, 2, 3, L.fit_rf, seed=5).collect()}
    means = R.fold_mean(R.decode_keys(T.read_runs(spark, f"{root}/metrics", "e")).where("fold is not null")).collect()
    assert len(means) == 12 and all(m["folds"] == 3 for m in means)
    for m in means:
        if m["split"] == "val":
            assert m["mean"] == pytest.approx(trials[m["run"]][m["metric"]])
    logged = {(r["run"], r["key"]): r["value"] for r in T.read_runs(spark, f"{root}/params").collect()}
    assert logged["e-0", "n_estimators"] == str(json.loads(trials["e-0"]["params"])["n_estimators"]) and ("e-search", "n_estimators") in logged
    assert {(r["run"], r["value"]) for r in T.read_runs(spark, f"{root}/tags").collect()} == {("e-0", "e-search"), ("e-1", "e-search")}


def test_training_scores(blobs):
    s = K.cross_validate(blobs, lambda t: L.fit_rf(t, {"n_estimators": 3, "max_depth": 3}), 3, train_scores=True)
    assert sorted((r["split"], r["fold"]) for r in s.collect()) == [("train", 1), ("train", 2), ("train", 3), ("val", 1), ("val", 2), ("val", 3)]


def test_scaling_fitted_elsewhere(spark):
    fit = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    rows = K.standard_scale(spark.createDataFrame([(5.0,)], "x double"), ["x"], fit_on=fit).first()
    assert rows["x_scaled"] == pytest.approx(3.0)
