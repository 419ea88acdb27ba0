"""Recorded numbers that the definitions must reproduce, on literal rows."""

import pytest
from pyspark.sql import functions as F

from harrow.functions import values as V
from harrow.functions.bands import stretch
from harrow.operators import folds as K
from harrow.operators import metrics as M
from harrow.operators import runs as R
from harrow.sources.layers import parse_crs


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "v string").select(*cols).first()


def test_fold_mean(spark):
    folds = [0.8922056384742952, 0.9150326797385622, 0.9150326797385622, 0.912106135986733, 0.9072847682119205]
    df = spark.createDataFrame([("r", "val", "f1", v) for v in folds], "run string, split string, metric string, value double")
    row = R.fold_mean(df).first()
    assert row["mean"] == pytest.approx(0.9083323804300146, abs=1e-12) and row["folds"] == 5


def test_ties_go_to_the_earliest_trial(spark):
    rows = [
        ("s", "c", 1747927648079, 0.9142183596244273, 974.1711569631163),
        ("s", "b", 1747927071096, 0.9142183596244273, 919.5426097129714),
        ("s", "a", 1747926167242, 0.9142183596244273, 968.6191736411615),
        ("s", "z", 1747926167000, float("nan"), 1.0),
    ]
    df = spark.createDataFrame(rows, "search string, run string, ts long, objective double, C double")
    assert R.best_trial(df, keep=["C"]).first()["C"] == 968.6191736411615


def test_constant_predictor(spark):
    df = spark.range(1067).select(F.lit(1).alias("fold"), F.when(F.col("id") < 438, 0).otherwise(1).alias("label"), F.lit(0).alias("pred"))
    s = M.scores(df).first()
    assert s["accuracy"] == pytest.approx(0.4104967197750703, abs=1e-12)
    assert s["f1"] == pytest.approx(0.5820598006644518, abs=1e-12)
    assert s["kappa"] == 0.0
    assert M.f1_class(df).first()["f1"] == pytest.approx(s["f1"])


def test_one_class_only_has_kappa_zero(spark):
    df = spark.createDataFrame([(1, 0, 0)] * 4, "fold int, label int, pred int")
    assert M.kappa(df).first()["kappa"] == 0.0


@pytest.mark.parametrize("hot", [None, 100])
def test_fold_sizes(spark, hot):
    df = spark.range(5333).select("id", F.when(F.col("id") % 5333 < 2189, 0).otherwise(1 + F.col("id") % 3).alias("label"))
    f = K.stratified_folds(df, "label", 5, ["id"], hot_rows=hot)
    sizes = {r["fold"]: (r["n"], r["zero"]) for r in f.groupBy("fold").agg(F.count("*").alias("n"), F.sum((F.col("label") == 0).cast("int")).alias("zero")).collect()}
    assert [sizes[i] for i in range(1, 6)] == [(1067, 438), (1067, 438), (1067, 438), (1066, 438), (1066, 437)]


def test_stretch(spark):
    row = spark.range(1).select(stretch(F.lit(0.1)).alias("a"), stretch(F.lit(0.0), gain=1.0).alias("b")).first()
    assert row["a"] == pytest.approx(0.5117031041872515, abs=1e-12)
    assert row["b"] == pytest.approx(-0.327106631018859, abs=1e-12)


def test_dict_param(spark):
    text = "{'C': 0.2755382207169761, 'kernel': 'poly', 'gamma': 'scale', 'class_weight': None, 'probability': True}"
    m = one(spark, text, V.parse_dict(F.col("v")).alias("m"))["m"]
    assert m == {"C": "0.2755382207169761", "kernel": "poly", "gamma": "scale", "class_weight": None, "probability": "True"}


@pytest.mark.parametrize("text,layers", [("46", [46]), ("(93,)", [93]), ("(82, 53)", [82, 53])])
def test_layers(spark, text, layers):
    assert one(spark, text, V.parse_layers(F.col("v")).alias("a"))["a"] == layers


@pytest.mark.parametrize(
    "text,kind",
    [("46", "int"), ("0.0040", "double"), ("1e-05", "double"), ("True", "bool"), ("None", "null"), ("(82, 53)", "list"), ("{'a': 1}", "map"), ("adaptive", "text")],
)
def test_value_type(spark, text, kind):
    assert one(spark, text, V.value_type(F.col("v")).alias("t"))["t"] == kind


@pytest.mark.parametrize(
    "key,want",
    [
        ("Validation F1 score of class 0 in fold 3", ("val", "f1", 0, 3, None)),
        ("Training accuracy in fold 1", ("train", "accuracy", None, 1, None)),
        ("Validation kappa in fold 5", ("val", "kappa", None, 5, None)),
        ("val_f1_mean", ("val", "f1", None, None, "mean")),
        ("train_scores_mean", ("train", "scores", None, None, "mean")),
        ("best_val_accuracy", ("val", "accuracy", None, None, "best")),
        ("Optimal threshold", (None, "threshold", None, None, "threshold")),
    ],
)
def test_metric_keys(spark, key, want):
    assert tuple(one(spark, key, V.decode_metric_key(F.col("v")).alias("k"))["k"]) == want


@pytest.mark.parametrize(
    "line,want",
    [
        ("- python=3.11.8", ("python", "=", "3.11.8")),
        ("- pip<=25.1.1", ("pip", "<=", "25.1.1")),
        ("  - scikit-learn==1.6.1", ("scikit-learn", "==", "1.6.1")),
        ("- conda-forge", None),
        ("- pip:", None),
        ("- -r requirements.txt", None),
    ],
)
def test_pins(spark, line, want):
    got = one(spark, line, V.parse_pin(F.col("v")).alias("p"))["p"]
    assert (None if got is None else tuple(got)) == want


def test_crs(spark):
    wkt = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    assert tuple(one(spark, wkt, *parse_crs(F.col("v")))) == (
        "GCS_WGS_1984", "D_WGS_1984", 6378137.0, 298.257223563, "Degree", 0.0174532925199433,
    )


def test_identical_params_different_score(spark):
    params = spark.createDataFrame(
        [("a", "depth", "3"), ("a", "crit", "gini"), ("b", "crit", "gini"), ("b", "depth", "3"), ("c", "depth", "4")],
        "run string, key string, value string",
    )
    fp = {r["run"]: r["fp"] for r in R.param_fingerprint(params).collect()}
    assert fp["a"] == fp["b"] != fp["c"]
    scores = spark.createDataFrame([("a", 0.7904), ("b", 0.7813), ("c", 0.8)], "run string, objective double")
    found = R.irreproducible(scores.join(R.param_fingerprint(params), "run").withColumn("script", F.lit("s"))).collect()
    assert len(found) == 1 and found[0]["gap"] == pytest.approx(0.0091)


def test_folds_without_mean(spark):
    keys = [f"Validation accuracy in fold {i}" for i in range(1, 6)]
    rows = [("ok", k, 0.5) for k in keys] + [("ok", "val_accuracy_mean", 0.5)] + [("bad", k, 0.5) for k in keys]
    df = spark.createDataFrame(rows, "run string, key string, value double")
    assert [r["run"] for r in R.folds_without_mean(df).collect()] == ["bad"]
