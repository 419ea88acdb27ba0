"""Estimators, search, stored models. Fits have no SQL counterpart; their rows are checked by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import folds as K
from harrow.operators import models as L
from harrow.operators import runs as R
from harrow.operators import search as H
from harrow.operators.metrics import vote
from harrow.plans import fixtures as X
from harrow.plans.registry import query, rounded
from harrow.session import scratch_path, written
from harrow.sources import runtree as T


def _predicted(df, model):
    return L.predict(df, model).select("vec_id", "label", "pred")


@query("M1")
def fit_rf(spark, sf):
    df = X.training_table(spark, sf)
    params = {"n_estimators": 20, "criterion": "entropy", "max_depth": 5, "max_features": "sqrt", "class_weight": "balanced", "random_state": 42}
    return _predicted(df, L.fit_rf(df, params))


def _four_classes(spark, sf):
    return X.training_table(spark, sf).withColumn("label", F.col("label") % 4)


@query("M2")
def fit_gbt_depth(spark, sf):
    df = _four_classes(spark, sf)
    params = {"num_class": 4, "n_estimators": 10, "learning_rate": 0.12, "max_depth": 4, "min_split_loss": 0.5, "max_delta_step": 3.0, "reg_alpha": 0.5, "reg_lambda": 1.6, "subsample": 0.9, "colsample_bytree": 0.8, "colsample_bylevel": 0.9}
    return _predicted(df, L.fit_gbt(df, params))


@query("M3")
def fit_gbt_leaf(spark, sf):
    df = X.training_table(spark, sf).withColumn("label", F.col("label") % 3)
    params = {"num_class": 3, "n_estimators": 8, "learning_rate": 0.12, "num_leaves": 12, "min_child_samples": 7, "lambda_l1": 0.1, "lambda_l2": 0.5, "bagging_fraction": 0.9, "bagging_freq": 3, "feature_fraction": 0.9}
    return _predicted(df, L.fit_gbt(df, params, flavour="leaf"))


def _boost_sums(rows: str, by: str, hessian: str) -> str:
    """SQL of all splits of groups of rows (cls, `by`, features, label) on the first round, where each of four classes has probability 1 / 4."""
    return f"""SELECT cls, {by}, feature, x, sum(n) OVER upto AS nl, sum(g) OVER upto AS gl, {hessian} * sum(n) OVER upto AS hl,
          sum(n) OVER all_of AS n, sum(g) OVER all_of AS g, {hessian} * sum(n) OVER all_of AS h
        FROM (SELECT cls, {by}, feature, x, count(*) AS n, 0.25::DOUBLE * count(*) - count(*) FILTER (label = cls) AS g
          FROM (SELECT cls, {by}, label, unnest(features) AS x, unnest([0, 1, 2, 3]) AS feature FROM {rows}) GROUP BY ALL)
        WINDOW upto AS (PARTITION BY cls, {by}, feature ORDER BY x), all_of AS (PARTITION BY cls, {by}, feature)"""


def _boost_best(sums: str, by: str, l1: float, l2: float, least: str) -> str:
    """SQL of the best of these splits per (cls, `by`), with the cut between neighbouring values of the whole table."""
    merit = lambda g, h: f"greatest(abs({g}) - {l1}, 0) * greatest(abs({g}) - {l1}, 0) / ({h} + {l2}::DOUBLE)"
    return f"""SELECT *, {merit("gl", "hl")} + {merit("(g - gl)", "(h - hl)")} - {merit("g", "h")} AS gain FROM {sums} JOIN cuts USING (feature, x)
        WHERE {least} AND gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY cls, {by} ORDER BY gain DESC, feature, x) = 1"""


_CUTS = "cuts AS (SELECT feature, x, x + (lead(x) OVER (PARTITION BY feature ORDER BY x) - x) / 2 AS threshold FROM (SELECT DISTINCT unnest(features) AS x, unnest([0, 1, 2, 3]) AS feature FROM v_graded) QUALIFY threshold IS NOT NULL)"
_EACH = "each AS (SELECT cls, 1 AS node, features, label FROM v_graded, range(4) c(cls))"


def _boost_nodes(tables: str, l1: float, l2: float, rate: float) -> str:
    value = f"-sign(g) * greatest(abs(g) - {l1}, 0) / (h + {l2}::DOUBLE) * {rate}::DOUBLE"
    return f"""SELECT CAST(0 AS INTEGER) AS round, CAST(cls AS INTEGER) AS cls, CAST(node AS BIGINT) AS node, CAST(feature AS INTEGER) AS feature,
        round(threshold, 6) AS threshold, round(gain, 6) AS gain, round({value}, 6) AS value FROM ({tables})"""


@query(
    "M2",
    f""", {_EACH}, {_CUTS}, s AS ({_boost_sums("each", "node", "0.375::DOUBLE")}),
      b AS ({_boost_best("s", "node", 2.0, 1.5, "hl >= 30 AND h - hl >= 30")}),
      t AS (SELECT cls, 1 AS node, feature, threshold, gain, g, h FROM b
        UNION ALL SELECT cls, 2, NULL, NULL, NULL, gl, hl FROM b UNION ALL SELECT cls, 3, NULL, NULL, NULL, g - gl, h - hl FROM b)
    {_boost_nodes("SELECT * FROM t", 2.0, 1.5, 0.3)}""",
    ("v_graded",),
)
def boost_round(spark, sf):
    """First round of one split per class, with leaf penalties: every node of the trees."""
    params = {"num_class": 4, "n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "reg_alpha": 2.0, "reg_lambda": 1.5, "min_child_weight": 30.0}
    return rounded(L.fit_gbt(X.v_graded(spark, sf), params).trees(spark))


@query(
    "M3",
    f""", {_EACH}, {_CUTS}, s AS ({_boost_sums("each", "node", "0.25::DOUBLE")}),
      b AS ({_boost_best("s", "node", 0.5, 1.0, "nl >= 20 AND n - nl >= 20")}),
      sides AS (SELECT e.cls, CASE WHEN list_extract(e.features, b.feature + 1) <= b.threshold THEN 2 ELSE 3 END AS node, e.features, e.label FROM each e JOIN b USING (cls)),
      s2 AS ({_boost_sums("sides", "node", "0.25::DOUBLE")}),
      b2 AS ({_boost_best("s2", "node", 0.5, 1.0, "nl >= 20 AND n - nl >= 20")}),
      c AS (SELECT * FROM b2 QUALIFY row_number() OVER (PARTITION BY cls ORDER BY gain DESC, node) = 1),
      t AS (SELECT cls, 1 AS node, feature, threshold, gain, g, h FROM b
        UNION ALL SELECT cls, node, feature, threshold, gain, g, h FROM c
        UNION ALL SELECT cls, 2 * node, NULL, NULL, NULL, gl, hl FROM c UNION ALL SELECT cls, 2 * node + 1, NULL, NULL, NULL, g - gl, h - hl FROM c
        UNION ALL SELECT b.cls, 5 - c.node, NULL, NULL, NULL, CASE WHEN c.node = 3 THEN b.gl ELSE b.g - b.gl END, CASE WHEN c.node = 3 THEN b.hl ELSE b.h - b.hl END FROM b JOIN c USING (cls))
    {_boost_nodes("SELECT * FROM t", 0.5, 1.0, 0.1)}""",
    ("v_graded",),
)
def boost_leaves(spark, sf):
    """First round of three leaves per class, the better of the two second splits: every node of the trees."""
    params = {"num_class": 4, "n_estimators": 1, "num_leaves": 3, "lambda_l1": 0.5, "lambda_l2": 1.0, "min_child_samples": 20, "boost_from_average": False}
    return rounded(L.fit_gbt(X.v_graded(spark, sf), params, "leaf").trees(spark))


@query("M4")
def fit_svc_linear(spark, sf):
    df = _four_classes(spark, sf)
    return _predicted(df, L.fit_svc(df, {"kernel": "linear", "C": 1.0, "class_weight": "balanced", "max_iter": 10}))


@query("M4")
def fit_svc_rbf(spark, sf):
    df = _four_classes(spark, sf)
    return _predicted(df, L.fit_svc(df, {"kernel": "rbf", "C": 10.0, "gamma": "scale", "max_iter": 10}))


@query("M4")
def fit_svc_poly(spark, sf):
    df = _four_classes(spark, sf)
    return _predicted(df, L.fit_svc(df, {"kernel": "poly", "degree": 2, "C": 1.0, "max_iter": 5}))


@query("M5")
def fit_mlp(spark, sf):
    df = _four_classes(spark, sf)
    return _predicted(df, L.fit_mlp(df, {"hidden_layer_sizes": (24, 12), "max_iter": 30, "random_state": 1}))


def _uniform(seed: str, name: str) -> str:
    text = f"'{seed}|{name}|' || CAST(search AS VARCHAR) || '|' || CAST(run AS VARCHAR)"
    return f"((('0x' || substr(md5({text}), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"


@query(
    "M7",
    f"""SELECT search, run, round(0.5 + {_uniform("7", "subsample")} * 0.5, 6) AS subsample,
      round(exp(ln(0.001) + {_uniform("7", "C")} * (ln(1000.0) - ln(0.001))), 6) AS "C",
      CAST(2 + floor({_uniform("7", "max_depth")} * 9) AS BIGINT) AS max_depth,
      list_extract(['linear', 'poly', 'rbf'], CAST(floor({_uniform("7", "kernel")} * 3) AS BIGINT) + 1) AS kernel FROM v_trials""",
    ("v_trials",),
)
def sample_configs(spark, sf):
    space = {
        "subsample": ("uniform", 0.5, 1.0),
        "C": ("loguniform", 0.001, 1000.0),
        "max_depth": ("int", 2, 10),
        "kernel": ("choice", ["linear", "poly", "rbf"]),
    }
    return rounded(H.sample_configs(X.v_trials(spark, sf).select("search", "run"), space, 7, ["search", "run"]))


@query("M7")
def run_search(spark, sf):
    """Three sampled forests, three folds, on the embeddings."""
    df = K.stratified_folds(_four_classes(spark, sf), "label", 3, ["vec_id"])
    space = {"n_estimators": ("int", 5, 10), "max_depth": ("int", 2, 4), "criterion": ("choice", ["gini", "entropy"])}
    trials = H.run_search(df, space, 3, 3, L.fit_rf, seed=1)
    return rounded(trials.select("trial", "params", "accuracy", "f1", "kappa", "folds"))


_SEARCH_DRAW = "(('0x' || substr(md5('11|by|' || CAST(trial AS VARCHAR)), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE"


_SEARCH_LOG = (
    f""", t AS (SELECT trial, list_extract(['l_linestatus', 'l_linenumber', 'l_both'], CAST(floor({_SEARCH_DRAW} * 3) AS BIGINT) + 1) AS grouping_name FROM range(0, 4) r(trial)),
      v AS (SELECT trial, fold, label, CASE grouping_name WHEN 'l_linestatus' THEN l_linestatus WHEN 'l_linenumber' THEN CAST(l_linenumber AS VARCHAR)
          ELSE l_linestatus || CAST(l_linenumber AS VARCHAR) END AS g FROM v_pred, t),
      c AS (SELECT trial, f, g, label, count(*) AS n FROM v, range(1, 6) x(f) WHERE fold <> f GROUP BY ALL),
      rule AS (SELECT trial, f, g, label AS pred FROM c QUALIFY row_number() OVER (PARTITION BY trial, f, g ORDER BY n DESC, label) = 1),
      p AS (SELECT trial, f, CASE WHEN f = fold THEN 'val' ELSE 'train' END AS split, label, pred FROM v JOIN rule USING (trial, g)),
      h AS (SELECT trial, f, split, avg(CAST(label = pred AS INTEGER)) AS accuracy, count(*)::DOUBLE AS n,
          coalesce(2.0 * count(*) FILTER (label = 0 AND pred = 0) / nullif(count(*) FILTER (label = 0) + count(*) FILTER (pred = 0), 0), 0) AS f1,
          sum(CAST(label = 0 AS INTEGER)) * sum(CAST(pred = 0 AS INTEGER))::DOUBLE + sum(CAST(label = 1 AS INTEGER)) * sum(CAST(pred = 1 AS INTEGER))
            + sum(CAST(label = 2 AS INTEGER)) * sum(CAST(pred = 2 AS INTEGER)) AS s FROM p GROUP BY ALL),
      k AS (SELECT trial, f, split, unnest(['accuracy', 'f1', 'kappa']) AS metric, unnest([accuracy, f1, (accuracy - s / (n * n)) / (1 - s / (n * n))]) AS value FROM h),
      m AS (SELECT trial, split, metric, avg(value) AS value FROM k GROUP BY ALL)
    SELECT 'rules-' || CAST(trial AS VARCHAR) AS run, split, metric, CAST(f AS INTEGER) AS fold, CAST(NULL AS VARCHAR) AS summary, round(value, 9) AS value FROM k
    UNION ALL SELECT 'rules-' || CAST(trial AS VARCHAR), split, metric, NULL, 'mean', round(value, 9) FROM m
    UNION ALL SELECT 'rules-search', 'val', 'kappa', NULL, 'best', round(max(value), 9) FROM m WHERE split = 'val' AND metric = 'kappa'"""
)

_GROUPINGS = {"l_linestatus": ["l_linestatus"], "l_linenumber": ["l_linenumber"], "l_both": ["l_linestatus", "l_linenumber"]}


@query("M7 S11", _SEARCH_LOG, ("v_pred",))
def search_log(spark, sf):
    """Search over the grouping of a majority rule; the run log it writes, read back with its keys decoded."""
    df = X.v_pred(spark, sf).drop("pred", "score")
    root = scratch_path(spark, "search")
    H.log_search(df, {"by": ("choice", list(_GROUPINGS))}, 4, 5, lambda train, p: K.majority_rule(_GROUPINGS[p["by"]])(train), root, "rules", 11, objective="kappa")
    return rounded(R.decode_keys(T.read_runs(spark, f"{root}/metrics", "rules")).select("run", "split", "metric", "fold", "summary", "value"), 9)


@query("M7 S11", _SEARCH_LOG, ("v_pred",))
def search_resumed(spark, sf):
    """The same search stopped after seven units and run again: the same log."""
    df = written(X.v_pred(spark, sf).drop("pred", "score"), "samples")
    root = scratch_path(spark, "search")
    for most in (7, None):
        H.resume_search(df, {"by": ("choice", list(_GROUPINGS))}, 4, 5, lambda train, p: K.majority_rule(_GROUPINGS[p["by"]])(train), root, "rules", 11, objective="kappa", most_units=most)
    return rounded(R.decode_keys(T.read_runs(spark, f"{root}/metrics", "rules")).select("run", "split", "metric", "fold", "summary", "value"), 9)


@query("M8")
def cross_validate_rf(spark, sf):
    df = written(K.stratified_folds(_four_classes(spark, sf), "label", 5, ["vec_id"]), "folds")
    params = {"n_estimators": 10, "max_depth": 4}
    return rounded(K.cross_validate(df, lambda train: L.fit_rf(train, params), 5))


@query("S12 M12", "SELECT 'forest' AS model, count(*) AS n, CAST(0 AS BIGINT) AS differing FROM embeddings")
def stored_model(spark, sf):
    """Save a forest, load it, predict with both: no row may differ."""
    df = X.training_table(spark, sf)
    model = L.fit_rf(df, {"n_estimators": 5, "max_depth": 4})
    root = scratch_path(spark, "models")
    L.save_model(model, root, "forest")
    loaded = L.load_model(spark, root, "forest")
    both = L.predict(L.predict(df, model).withColumnRenamed("pred", "first"), loaded, "forest")
    return both.groupBy("model").agg(F.count("*").alias("n"), F.sum((F.col("first") != F.col("pred")).cast("long")).alias("differing"))


@query("M6 M12")
def vote_models(spark, sf):
    """Forest and perceptron vote with their class probabilities, through the long form."""
    df = _four_classes(spark, sf)
    forest = L.fit_rf(df, {"n_estimators": 5, "max_depth": 4})
    net = L.fit_mlp(df, {"hidden_layer_sizes": (8,), "max_iter": 10})
    scores = L.class_scores(df, forest, "forest", "vec_id").unionByName(L.class_scores(df, net, "net", "vec_id"))
    return rounded(vote(scores, "soft"))


@query("M6")
def vote_ensemble(spark, sf):
    """Support vectors, boosting and perceptron vote row by row."""
    df = _four_classes(spark, sf)
    members = {
        "svc": {"kernel": "linear", "C": 1.0, "max_iter": 5, "probability": True},
        "xgb": {"n_estimators": 2, "max_depth": 3},
        "mlp": {"hidden_layer_sizes": 8, "max_iter": 10},
    }
    return L.fit_vote(df, members)(df).select("vec_id", "label", "pred")
