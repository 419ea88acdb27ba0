"""Hyper-parameter search: trial tables and their evaluation."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.values import unit_hash
from harrow.operators.folds import ROWS_PER_TASK, Rule, cross_validate, training_size
from harrow.operators.metrics import scores
from harrow.sources.runtree import write_runs

# A dimension: ("uniform", lo, hi), ("loguniform", lo, hi), ("int", lo, hi) or ("choice", [values]).
Space = dict[str, tuple]

#: Tag that names a run's parent.
PARENT_TAG = "mlflow.parentRunId"

TRIAL_SCHEMA = "trial long, params string, ts long, accuracy double, f1 double, kappa double, folds long, seconds double"


def _draw(name: str, dim: tuple, seed: int, ids: list[str]) -> Column:
    u = unit_hash(F.lit(seed), F.lit(name), *[F.col(i) for i in ids])
    kind = dim[0]
    if kind == "uniform":
        return F.lit(float(dim[1])) + u * F.lit(float(dim[2] - dim[1]))
    if kind == "loguniform":
        return F.exp(F.log(F.lit(float(dim[1]))) + u * (F.log(F.lit(float(dim[2]))) - F.log(F.lit(float(dim[1])))))
    if kind == "int":
        return (F.lit(int(dim[1])) + F.floor(u * F.lit(int(dim[2]) - int(dim[1]) + 1))).cast("long")
    if kind == "choice":
        options = F.array(*[F.lit(v) for v in dim[1]])
        return F.element_at(options, (F.floor(u * F.lit(len(dim[1]))) + 1).cast("int"))
    raise ValueError(f"unknown dimension {kind!r}")


def sample_configs(trials: DataFrame, space: Space, seed: int, ids: list[str]) -> DataFrame:
    """Random configuration per trial row, drawn from a hash of (seed, parameter, trial ids).

    Row-local: the same trial gets the same configuration on every run, whatever the partitioning.
    """
    return trials.select("*", *[_draw(n, d, seed, ids).alias(n) for n, d in space.items()])


def search(spark, space: Space, n: int, seed: int) -> DataFrame:
    """Trial table of n random configurations."""
    return sample_configs(spark.range(n).withColumnRenamed("id", "trial"), space, seed, ["trial"])


def run_search(
    df: DataFrame,
    space: Space,
    n: int,
    k: int,
    fit: Callable[[DataFrame, dict], Rule],
    seed: int = 0,
    cls: int = 0,
    parallelism: int = 8,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Evaluate n sampled configurations by k-fold cross-validation; one row per trial.

    `df` has `fold` 1..k. The training table is kept in memory or on disk once; trials run as
    independent Spark jobs from `parallelism` driver threads. Only configurations and k scores per
    trial pass through the driver. Small partitions are joined first, so small tables train in few
    tasks and many trials at once.
    """
    rows = []
    for config, folds, done, seconds in _evaluated(df, space, n, k, fit, seed, cls, parallelism, rows_per_task):
        mean = lambda c: float(sum(r[c] for r in folds) / len(folds))
        rows.append((config["trial"], _text(config), int(done * 1000), mean("accuracy"), mean("f1"), mean("kappa"), len(folds), seconds))
    return df.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def _text(config: dict) -> str:
    return json.dumps({name: v for name, v in config.items() if name != "trial"}, sort_keys=True)


def _evaluated(df, space, n, k, fit, seed, cls, parallelism, rows_per_task, train_scores=False) -> list[tuple]:
    """(configuration, its score rows, end in epoch seconds, seconds) per trial, in order of trial."""
    configs = [r.asDict() for r in search(df.sparkSession, space, n, seed).orderBy("trial").collect()]
    data = training_size(df, rows_per_task).persist(StorageLevel.MEMORY_AND_DISK)
    folds_at_once = max(1, math.ceil(parallelism / n))
    try:

        def one(config: dict) -> tuple:
            started = time.time()
            params = {name: v for name, v in config.items() if name != "trial"}
            folds = cross_validate(data, lambda train: fit(train, params), k, cls, train_scores, folds_at_once).collect()
            done = time.time()
            return config, folds, done, done - started

        with ThreadPoolExecutor(max_workers=min(parallelism, n)) as pool:
            return list(pool.map(one, configs))
    finally:
        data.unpersist()


METRIC_SCHEMA = "experiment_id string, run string, key string, ts long, value double, step long"
PARAM_SCHEMA = "experiment_id string, run string, key string, value string"


def log_search(
    df: DataFrame,
    space: Space,
    n: int,
    k: int,
    fit: Callable[[DataFrame, dict], Rule],
    root: str,
    experiment: str,
    seed: int = 0,
    cls: int = 0,
    objective: str = "f1",
    parallelism: int = 8,
    rows_per_task: int = ROWS_PER_TASK,
) -> None:
    """Evaluate as `run_search` does, with training scores, and append the run log below `root`.

    `metrics`: every score of every fold and its means per trial, and the best mean objective under the parent run.
    `params`: each trial's configuration, and the best one under the parent. `tags`: each trial's parent. Trials are the runs
    '<experiment>-<trial>', their parent is '<experiment>-search'. A NaN or null mean is never the best; ties go to the lowest
    trial. 6 (k + 1) numbers per trial pass through the driver.
    """
    results = [(config, folds, int(done * 1000)) for config, folds, done, _ in _evaluated(df, space, n, k, fit, seed, cls, parallelism, rows_per_task, True)]
    for kind, rows, schema in _log_rows(results, experiment, cls, objective):
        write_runs(df.sparkSession.createDataFrame(rows, schema), f"{root}/{kind}")


def _log_rows(results: list[tuple], experiment: str, cls: int, objective: str) -> list[tuple[str, list, str]]:
    """(kind, rows, schema) of the run log, from (configuration, score rows, end in epoch ms) per trial."""
    parent = f"{experiment}-search"
    metrics, params, tags, best = [], [], [], None
    names = {"accuracy": "accuracy", "f1": f"F1 score of class {cls}", "kappa": "kappa"}
    for config, folds, ts in results:
        run = f"{experiment}-{config['trial']}"
        for split, side in (("train", "Training"), ("val", "Validation")):
            rows = [r for r in folds if r["split"] == split]
            for metric, name in names.items():
                metrics += [(experiment, run, f"{side} {name} in fold {r['fold']}", ts, r[metric], 0) for r in rows]
                values = [r[metric] for r in rows]
                mean = None if not values or None in values else sum(values) / len(values)
                metrics.append((experiment, run, f"{split}_{metric}_mean", ts, mean, 0))
                if split == "val" and metric == objective and mean is not None and not math.isnan(mean) and (best is None or mean > best[0]):
                    best = mean, config, ts
        params += [(experiment, run, name, str(v)) for name, v in config.items() if name != "trial"]
        tags.append((experiment, run, PARENT_TAG, parent))
    if best is not None:
        metrics.append((experiment, parent, f"best_val_{objective}", best[2], best[0], 0))
        params += [(experiment, parent, name, str(v)) for name, v in best[1].items() if name != "trial"]
    return [("metrics", metrics, METRIC_SCHEMA), ("params", params, PARAM_SCHEMA), ("tags", tags, PARAM_SCHEMA)]


UNIT_SCHEMA = "split string, accuracy double, f1 double, kappa double, params string, done long"


def search_units(spark: SparkSession, root: str) -> DataFrame:
    """(trial, fold, split, accuracy, f1, kappa, params, done): the units of a search committed so far; none before the first."""
    schema = f"trial long, fold int, {UNIT_SCHEMA}"
    try:
        return spark.read.schema(schema).parquet(f"{root}/units").select("trial", "fold", *[c.split()[0] for c in UNIT_SCHEMA.split(", ")])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def resume_search(
    df: DataFrame,
    space: Space,
    n: int,
    k: int,
    fit: Callable[[DataFrame, dict], Rule],
    root: str,
    experiment: str,
    seed: int = 0,
    cls: int = 0,
    objective: str = "f1",
    parallelism: int = 8,
    rows_per_task: int = ROWS_PER_TASK,
    most_units: int | None = None,
) -> int:
    """Run a search from where it stopped; returns the number of (trial, fold) units still to do.

    Every unit is fitted, scored and committed by itself, as one file below `root`/units, so a stopped or failed search keeps what it has.
    A call works on the units that are not there under the same configuration (another space, seed or experiment is another search: give it
    another `root`). When all are there, the run log of `log_search` is written; writing it again replaces it, so a stop in between does
    no harm. `most_units` ends a call early. A failing unit stops the call after the units already running.
    """
    spark = df.sparkSession
    configs = {r["trial"]: r.asDict() for r in search(spark, space, n, seed).collect()}
    every = spark.createDataFrame([(t, f, _text(c)) for t, c in configs.items() for f in range(1, k + 1)], "trial long, fold int, params string")

    def open_units() -> list[tuple[int, int]]:
        known = search_units(spark, root).select("trial", "fold", "params").distinct()
        return sorted((r["trial"], r["fold"]) for r in every.join(known, ["trial", "fold", "params"], "left_anti").collect())

    todo = open_units()[:most_units]
    data = training_size(df, rows_per_task).persist(StorageLevel.MEMORY_AND_DISK) if todo else df

    def one(unit: tuple[int, int]) -> None:
        trial, fold = unit
        params = {name: v for name, v in configs[trial].items() if name != "trial"}
        train, held = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        rule = fit(train, params)
        said = rule(train).select(F.lit("train").alias("split"), "label", "pred").unionByName(rule(held).select(F.lit("val").alias("split"), "label", "pred"))
        got = scores(said, cls, ["split"]).collect()  # two rows
        rows = [(r["split"], r["accuracy"], r["f1"], r["kappa"], _text(configs[trial]), int(time.time() * 1000)) for r in got]
        spark.createDataFrame(rows, UNIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/units/trial={trial}/fold={fold}")

    try:
        if todo:
            with ThreadPoolExecutor(max_workers=min(parallelism, len(todo))) as pool:
                running = [pool.submit(one, unit) for unit in todo]
                wait(running, return_when=FIRST_EXCEPTION)
                for f in running:
                    f.cancel()
            for f in running:
                if not f.cancelled():
                    f.result()
    finally:
        if todo:
            data.unpersist()
    left = len(open_units())
    if not left:
        mine = search_units(spark, root).join(every, ["trial", "fold", "params"]).orderBy("trial", "split", "fold").collect()
        results = [(c, [r for r in mine if r["trial"] == t], max(r["done"] for r in mine if r["trial"] == t)) for t, c in sorted(configs.items())]
        for kind, rows, schema in _log_rows(results, experiment, cls, objective):
            out = spark.createDataFrame(rows, schema).hint("rebalance", "experiment_id").write.mode("overwrite")
            out.option("partitionOverwriteMode", "dynamic").partitionBy("experiment_id").parquet(f"{root}/{kind}")
    return left


def best_config(trials: DataFrame, objective: str = "f1") -> dict:
    """Params of the best trial; ties go to the lowest trial number."""
    row = trials.orderBy(F.desc(objective), "trial").first()
    return json.loads(row["params"])
