"""Estimators on Spark ML (boosting: `boosting`), set up from the parameter names that the run logs use.

Rows are (features array<double>, label int). What has no Spark counterpart is ignored and named in
each docstring; predictions therefore differ from other libraries' and only scores are comparable.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators import boosting
from harrow.operators.boosting import FittedBoost, Rules
from harrow.operators.folds import training_size, with_class_weight
from harrow.session import written

MAX_DEPTH = 30  # Spark's own limit


def _depth(asked) -> int:
    """Depth to fit: none asked for means Spark's limit, more than that is an error."""
    if not asked:
        return MAX_DEPTH
    if int(asked) > MAX_DEPTH:
        raise ValueError(f"max_depth {asked} is beyond Spark's limit of {MAX_DEPTH}")
    return int(asked)


@dataclass
class FittedModel:
    """A Spark ML model plus the feature map it was trained on."""

    kind: str
    pipeline: PipelineModel
    spec: dict = field(default_factory=dict)

    def __call__(self, df: DataFrame) -> DataFrame:
        return predict(df, self)


def fourier_features(col: str, dim: int, gamma: float, n: int, seed: int):
    """Random Fourier features of the rbf kernel exp(-gamma |x - y|^2) (Rahimi and Recht 2007)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(dim, n))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n)

    @F.pandas_udf("array<double>")
    def features(x: pd.Series) -> pd.Series:
        z = np.cos(np.vstack(x.to_numpy()) @ w + b) * math.sqrt(2.0 / n) if len(x) else np.empty((0, n))
        return pd.Series(list(z))

    return features(F.col(col))


def _vectors(df: DataFrame, spec: dict) -> DataFrame:
    mapped = df
    if spec.get("fourier"):
        f = spec["fourier"]
        mapped = mapped.withColumn("_x", fourier_features("features", f["dim"], f["gamma"], f["n"], f["seed"]))
    else:
        mapped = mapped.withColumn("_x", F.col("features").cast("array<double>"))
    return mapped.withColumn("_x", array_to_vector("_x"))


def _shape(df: DataFrame) -> tuple[int, int]:
    """Feature width and number of classes (labels count from 0)."""
    r = df.agg(F.max(F.size("features")).alias("d"), (F.max("label") + 1).alias("k")).first()
    return int(r["d"]), int(r["k"])


def _weighted(df: DataFrame, params: dict) -> tuple[DataFrame, str | None]:
    if params.get("class_weight") in ("balanced", "balanced_subsample"):
        return with_class_weight(df, "label", "_w"), "_w"
    return df, None


def _fit(kind: str, df: DataFrame, stages: list, spec: dict) -> FittedModel:
    cols = ["label", "_x"] + (["_w"] if "_w" in df.columns else [])
    ready = training_size(_vectors(df, spec).select(*cols))
    return FittedModel(kind, Pipeline(stages=stages).fit(ready), spec)


def fit_rf(df: DataFrame, params: dict | None = None) -> FittedModel:
    """Random forest. Carries n_estimators, criterion, max_depth, min_samples_leaf, max_features,
    min_weight_fraction_leaf, class_weight, random_state; not min_samples_split."""
    p = params or {}
    rows, weight = _weighted(df, p)
    rf = RandomForestClassifier(
        featuresCol="_x",
        labelCol="label",
        predictionCol="prediction",
        numTrees=int(p.get("n_estimators", 100)),
        impurity="gini" if p.get("criterion", "gini") == "gini" else "entropy",
        maxDepth=_depth(p.get("max_depth")),
        minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
        featureSubsetStrategy={None: "all", "None": "all"}.get(p.get("max_features", "sqrt"), str(p.get("max_features", "sqrt"))),
        minWeightFractionPerNode=float(p.get("min_weight_fraction_leaf", 0.0)),
        seed=int(p.get("random_state", 42)),
    )
    if weight:
        rf.setWeightCol(weight)
    return _fit("rf", rows, [rf], {"params": p})


def fit_gbt(df: DataFrame, params: dict | None = None, flavour: str = "depth") -> FittedBoost:
    """Gradient boosting of all classes with a softmax loss.

    'depth' grows trees level by level and reads n_estimators, learning_rate, max_depth, min_split_loss, min_child_weight,
    max_delta_step, reg_alpha, reg_lambda, subsample, colsample_bytree, colsample_bylevel; 'leaf' grows leaf by leaf and reads n_estimators, learning_rate,
    num_leaves, max_depth, min_split_gain, min_child_samples, min_child_weight, lambda_l1, lambda_l2, bagging_fraction, bagging_freq,
    feature_fraction, boost_from_average. Both read num_class, class_weight, random_state. objective, metric, boosting_type and verbosity name what is done anyway.
    """
    p = params or {}
    if flavour not in ("depth", "leaf"):
        raise ValueError("flavour is 'depth' or 'leaf'")
    rows, weight = _weighted(df, p)
    rules = Rules.leaf_wise(p) if flavour == "leaf" else Rules.depth_wise(p)
    return boosting.fit(rows, rules, f"gbt_{flavour}", p, p.get("num_class"), weight)


def fit_svc(df: DataFrame, params: dict | None = None, n_fourier: int = 128) -> FittedModel:
    """Support vector classifier, one linear machine per class, regParam = 1 / (C n).

    kernel 'linear' as is; 'poly' expands to `degree`; 'rbf' approximates the kernel with random
    Fourier features. gamma 'scale' = 1 / (d var), 'auto' = 1 / d. With probability, the margins of rows held out of further
    fits calibrate a sigmoid per class (`calibrated`).
    """
    p = params or {}
    if str(p.get("probability", False)) == "True":
        return calibrated(df, {k: v for k, v in p.items() if k != "probability"}, lambda d, q: fit_svc(d, q, n_fourier))
    rows, weight = _weighted(df, p)
    kernel, c, seed = p.get("kernel", "rbf"), float(p.get("C", 1.0)), int(p.get("random_state", 42))
    d, _ = _shape(df)
    spec: dict = {"params": p}
    stages = []
    last = "_x"
    if kernel == "rbf":
        gamma = p.get("gamma", "scale")
        if gamma == "scale":
            x = df.select(F.explode(F.col("features").cast("array<double>")).alias("x"))
            gamma = 1.0 / (d * (x.agg(F.var_pop("x")).first()[0] or 1.0))
        elif gamma == "auto":
            gamma = 1.0 / d
        spec["fourier"] = {"dim": d, "gamma": float(gamma), "n": n_fourier, "seed": seed}
    elif kernel == "poly":
        stages.append(PolynomialExpansion(inputCol=last, outputCol="_poly", degree=int(p.get("degree", 3))))
        last = "_poly"
    elif kernel != "linear":
        raise ValueError("kernel is 'linear', 'poly' or 'rbf'")
    n = df.count()
    svc = LinearSVC(
        featuresCol=last,
        labelCol="label",
        regParam=1.0 / (c * max(n, 1)),
        maxIter=int(p.get("max_iter", 50)),
        tol=float(p.get("tol", 1e-3)),
    )
    ovr = OneVsRest(classifier=svc, featuresCol=last, labelCol="label", predictionCol="prediction", parallelism=4)
    if weight:
        ovr.setWeightCol(weight)
    return _fit("svc", rows, [*stages, ovr], spec)


#: Parts of the rows, each held out once while margins are calibrated.
CALIBRATION_PARTS = 3
NEWTON_STEPS = 50


def calibrated(df: DataFrame, params: dict, fit) -> FittedModel:
    """`fit(df, params)` with a sigmoid per class, 1 / (1 + exp(a margin + b)), fitted to margins of held-out rows (Platt 1999).

    Rows are dealt to the parts by a hash of their features and label, so a seeded result does not depend on partitions. A part whose
    training rows lack a class that other rows have is left out; with no part left, the margins of the training rows serve.
    """
    data = written(df.withColumn("_part", F.pmod(F.xxhash64("features", "label"), F.lit(CALIBRATION_PARTS))), "calibration")
    held_by = {r["label"]: set(r["p"]) for r in data.groupBy("label").agg(F.collect_set("_part").alias("p")).collect()}
    model = fit(df, params)
    usable = [i for i in range(CALIBRATION_PARTS) if all(parts - {i} for parts in held_by.values())]
    margins = [_margins(fit(data.where(F.col("_part") != i).drop("_part"), params), data.where(F.col("_part") == i)) for i in usable]
    margins = margins or [_margins(model, data)]
    model.spec["sigmoid"] = fit_sigmoids(written(reduce(DataFrame.unionByName, margins), "margins"))
    return model


def _margins(model: FittedModel, df: DataFrame) -> DataFrame:
    """(cls, margin, hit) of every row and class."""
    scored = model.pipeline.transform(_vectors(df, model.spec))
    return scored.select("label", F.posexplode(vector_to_array("rawPrediction")).alias("cls", "margin")).select(
        "cls", "margin", (F.col("cls") == F.col("label")).cast("int").alias("hit")
    )


def fit_sigmoids(margins: DataFrame) -> list[list[float]]:
    """[a, b] per class from (cls, margin, hit), by damped Newton steps; rows stay in the cluster, six sums per class come back.

    Targets are (hits + 1) / (hits + 2) and 1 / (misses + 2), so separable margins have a finite answer.
    """
    counts = {r["cls"]: (r["n1"], r["n"] - r["n1"]) for r in margins.groupBy("cls").agg(F.sum("hit").alias("n1"), F.count(F.lit(1)).alias("n")).collect()}
    target = {c: ((n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0)) for c, (n1, n0) in counts.items()}
    at = {c: (0.0, math.log((n0 + 1.0) / (n1 + 1.0))) for c, (n1, n0) in counts.items()}
    best: dict[int, tuple] = {}  # class -> (loss, point, its step)
    open_classes = set(counts)
    for _ in range(NEWTON_STEPS):
        pick = lambda values, i: F.coalesce(*[F.when(F.col("cls") == c, F.lit(float(v[i]))) for c, v in values.items()])  # noqa: B023
        t = F.when(F.col("hit") == 1, pick(target, 0)).otherwise(pick(target, 1))
        z = F.col("margin") * pick(at, 0) + pick(at, 1)
        p = 1.0 / (1.0 + F.exp(z))
        # log(1 + exp(z)) without overflow.
        loss = t * z + F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        d1, d2, m = t - p, p * (1.0 - p), F.col("margin")
        sums = [("loss", loss), ("ga", d1 * m), ("gb", d1), ("haa", d2 * m * m), ("hab", d2 * m), ("hbb", d2)]
        rows = margins.where(F.col("cls").isin(sorted(open_classes))).groupBy("cls").agg(*[F.sum(e).alias(n) for n, e in sums]).collect()
        for r in rows:
            c = r["cls"]
            if c in best and r["loss"] > best[c][0] - 1e-10 * max(1.0, abs(best[c][0])):
                # No better: half the step, until it is too short to matter.
                step = (best[c][2][0] / 2, best[c][2][1] / 2)
                best[c] = (best[c][0], best[c][1], step)
            else:
                haa, hbb = r["haa"] + 1e-12, r["hbb"] + 1e-12
                det = haa * hbb - r["hab"] ** 2
                step = (-(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det) if det > 0 else (-r["ga"] / haa, -r["gb"] / hbb)
                best[c] = (r["loss"], at[c], step)
            a, b = best[c][1]
            at[c] = (a + step[0], b + step[1])
            if abs(step[0]) <= 1e-7 * (1 + abs(a)) and abs(step[1]) <= 1e-7 * (1 + abs(b)):
                open_classes.discard(c)
        if not open_classes:
            break
    return [list(best[c][1]) if c in best else [0.0, 0.0] for c in range(max(counts, default=-1) + 1)]


def fit_mlp(df: DataFrame, params: dict | None = None) -> FittedModel:
    """Perceptron with the given hidden_layer_sizes (sigmoid units), max_iter, learning_rate_init, random_state.

    solver 'lbfgs' maps to l-bfgs, others to gradient descent only when asked ('sgd'); activation and the
    L2 term alpha do not carry over. Features are standardised first.
    """
    p = params or {}
    d, k = _shape(df)
    hidden = p.get("hidden_layer_sizes", (100,))
    hidden = [int(hidden)] if isinstance(hidden, (int, str)) else [int(h) for h in hidden]
    mlp = MultilayerPerceptronClassifier(
        featuresCol="_scaled",
        labelCol="label",
        predictionCol="prediction",
        layers=[d, *hidden, int(p.get("num_class", k))],
        maxIter=int(p.get("max_iter", 100)),
        stepSize=float(p.get("learning_rate_init", 0.03)),
        solver="gd" if p.get("solver") == "sgd" else "l-bfgs",
        seed=int(p.get("random_state", 42)),
    )
    scale = StandardScaler(inputCol="_x", outputCol="_scaled", withMean=True, withStd=True)
    return _fit("mlp", df, [scale, mlp], {"params": p})


def predict(df: DataFrame, model: FittedModel | FittedBoost, name: str | None = None, fingerprint: str | None = None) -> DataFrame:
    """The input rows plus `pred`, and the model name and fingerprint when given."""
    if isinstance(model, FittedBoost):
        out, pred = model(df), F.col("pred")
    else:
        out, pred = model.pipeline.transform(_vectors(df, model.spec)), F.col("prediction").cast("int").alias("pred")
    cols = [*df.columns, pred]
    if name is not None:
        cols.append(F.lit(name).alias("model"))
    if fingerprint is not None:
        cols.append(F.lit(fingerprint).alias("model_fp"))
    return out.select(*cols)


def with_scores(df: DataFrame, model: FittedModel | FittedBoost, out: str) -> DataFrame:
    """The input rows plus an array of class scores that add up to 1.

    Models without probabilities give one margin per class; each goes through its calibrated sigmoid, or the plain logistic
    function where there is none, and the results are scaled to add up to 1.
    """
    if isinstance(model, FittedBoost):
        return model.scores(df, out)
    scored = model.pipeline.transform(_vectors(df, model.spec))
    if "probability" in scored.columns:
        scores = vector_to_array("probability")
    else:
        fitted = model.spec.get("sigmoid")
        if fitted:
            ab = F.array(*[F.array(*[F.lit(float(x)) for x in pair]) for pair in fitted])
            squashed = F.transform(vector_to_array("rawPrediction"), lambda m, i: 1.0 / (1.0 + F.exp(m * ab[i][0] + ab[i][1])))
        else:
            squashed = F.transform(vector_to_array("rawPrediction"), lambda m: 1.0 / (1.0 + F.exp(-m)))
        total = lambda a: F.greatest(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.lit(1e-300))
        scores = F.transform(squashed, lambda x: x / total(squashed))
    return scored.select(*df.columns, scores.alias(out))


@dataclass
class FittedVote:
    """Members voting row by row: their score arrays sit side by side, so no join or shuffle is needed."""

    members: dict[str, FittedModel | FittedBoost]
    how: str = "soft"
    weights: dict[str, float] = field(default_factory=dict)

    def __call__(self, df: DataFrame) -> DataFrame:
        out = df
        for name, model in self.members.items():
            out = with_scores(out, model, f"_s_{name}")
        tally = None
        for name in self.members:
            s, w = F.col(f"_s_{name}"), F.lit(float(self.weights.get(name, 1.0)))
            if self.how == "hard":
                top = F.array_position(s, F.array_max(s))
                part = F.transform(s, lambda _, i: F.when(i + 1 == top, w).otherwise(0.0))
            else:
                part = F.transform(s, lambda x: x * w)
            tally = part if tally is None else F.zip_with(tally, part, lambda a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))
        # The first position of the maximum is the lowest class.
        tallied = out.withColumn("_tally", tally)
        pred = (F.array_position("_tally", F.array_max("_tally")) - 1).cast("int")
        return tallied.select(*df.columns, pred.alias("pred"))


def fit_vote(df: DataFrame, params: dict, how: str = "soft", weights: dict[str, float] | None = None) -> FittedVote:
    """Voting ensemble; `params` maps member names (svc, xgb, lgbm, mlp, rf) to their own parameters."""
    if how not in ("soft", "hard"):
        raise ValueError("how is 'soft' or 'hard'")
    makers = {
        "svc": fit_svc,
        "xgb": fit_gbt,
        "lgbm": lambda d, p: fit_gbt(d, p, flavour="leaf"),
        "mlp": fit_mlp,
        "rf": fit_rf,
    }
    return FittedVote({name: makers[name](df, p) for name, p in params.items()}, how, weights or {})


def class_scores(df: DataFrame, model: FittedModel, member: str, key: str) -> DataFrame:
    """Long class scores (sample, member, cls, score), the form `metrics.vote` takes."""
    rows = with_scores(df, model, "_s").select(F.col(key).alias("sample"), F.posexplode("_s").alias("cls", "score"))
    return rows.select("sample", F.lit(member).alias("member"), "cls", "score")


def save_model(model: FittedModel | FittedBoost | FittedVote, root: str, name: str) -> str:
    """Model and feature map under `root`/`name`; the folder must be shared. An ensemble keeps each member below its own."""
    path = f"{root.rstrip('/')}/{name}"
    if isinstance(model, FittedVote):
        for member, fitted in model.members.items():
            save_model(fitted, f"{path}/members", member)
        spec = {"kind": "vote", "members": list(model.members), "how": model.how, "weights": model.weights}
    elif isinstance(model, FittedBoost):
        spec = {"kind": "boost", "model": model.to_json()}
    else:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
        spec = {"kind": model.kind, "spec": model.spec}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(spec, sort_keys=True),)], "value string").write.mode("overwrite").text(f"{path}/spec")
    return path


def load_model(spark: SparkSession, root: str, name: str) -> FittedModel | FittedBoost | FittedVote:
    path = f"{root.rstrip('/')}/{name}"
    spec = json.loads(spark.read.text(f"{path}/spec").first()["value"])
    if spec["kind"] == "vote":
        members = {m: load_model(spark, f"{path}/members", m) for m in spec["members"]}
        return FittedVote(members, spec["how"], spec["weights"])
    if spec["kind"] == "boost":
        return FittedBoost.from_json(spec["model"])
    return FittedModel(spec["kind"], PipelineModel.load(f"{path}/pipeline"), spec["spec"])
