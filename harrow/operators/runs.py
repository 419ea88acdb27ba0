"""Run-log analytics.

Long form throughout: params(run, key, value), metrics(run, key, value, ts), tags(run, key, value),
trials(search, run, ts, objective, script). Times are epoch milliseconds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.functions import values as V
from harrow.operators.ordered import (
    best_before,
    exact_quantiles,
    has_hot_group,
    join_groups,
    over_order,
    previous,
    quantiles_of_counts,
    row_number,
    running,
    size_checked,
)
from harrow.session import hot_rows as session_hot_rows
from harrow.session import written

# ---------------------------------------------------------------- typed views and filters


def typed_params(params: DataFrame) -> DataFrame:
    """Untyped params with their type and one column per reading (null where it does not apply)."""
    v, kind = F.col("value"), F.col("type")
    return params.withColumn("type", V.value_type(v)).select(
        "*",
        F.when(kind == "int", v.try_cast("long")).alias("as_int"),
        F.when(kind.isin("int", "double"), v.try_cast("double")).alias("as_double"),
        F.when(kind == "bool", v == "True").alias("as_bool"),
        F.when(kind == "text", v).alias("as_text"),
    )


def with_times(runs: DataFrame) -> DataFrame:
    """Start / end as timestamps plus the duration in seconds."""
    return runs.select(
        "*",
        F.timestamp_millis("start_time").alias("started"),
        F.timestamp_millis("end_time").alias("ended"),
        ((F.col("end_time") - F.col("start_time")) / 1000.0).alias("seconds"),
    )


def decode_status(runs: DataFrame) -> DataFrame:
    return runs.select(
        "*",
        V.decode(F.col("status"), V.RUN_STATUS).alias("status_name"),
        V.decode(F.col("source_type"), V.SOURCE_TYPE).alias("source_name"),
    )


def decode_keys(metrics: DataFrame) -> DataFrame:
    """Metric rows with split, metric, cls, fold and summary read from the key."""
    return metrics.select("*", V.decode_metric_key(F.col("key")).alias("_k")).select("*", "_k.*").drop("_k")


def alias_keys(params: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace misspelt keys through `aliases(key, repaired)`."""
    table = size_checked(aliases.select("key", "repaired").dropDuplicates(["key"]))
    rest = [c for c in params.columns if c != "key"]
    return params.join(table, "key", "left").select(F.coalesce("repaired", "key").alias("key"), *rest)


def param_fingerprint(params: DataFrame, by: list[str] = ("run",)) -> DataFrame:
    """Digest of a run's set of (key, value) pairs, the same whatever their order.

    md5 of every pair is added up in four 32-bit quarters, so the state per run is five numbers and
    combines map-side: a run with any number of params never has to fit in one task.
    """
    # The key's length keeps key and value apart; a null value has a mark of its own.
    value = F.coalesce(F.concat(F.lit("="), F.col("value")), F.lit("!"))
    pair = F.concat(F.length("key").cast("string"), F.lit(":"), F.col("key"), value)
    rows = params.select(*by, F.md5(pair).alias("_h")).distinct()
    quarters = V.digest_parts(F.col("_h"))
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_params"), *[F.sum(q).alias(f"_q{i}") for i, q in enumerate(quarters)]
    )
    text = F.concat_ws(":", "n_params", *[f"_q{i}" for i in range(4)])
    return sums.select(*by, "n_params", F.md5(text).alias("fp"))


def finished(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == 3)


def of_script(runs: DataFrame, script: str) -> DataFrame:
    return runs.where(F.col("script") == script)


def of_experiment(runs: DataFrame, experiment: str) -> DataFrame:
    """One experiment; on tables written by experiment only its folder is read."""
    return runs.where(F.col("experiment_id") == experiment)


def with_metric(runs: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Runs that log `key`."""
    logged = metrics.where(F.col("key") == key).select("run").distinct()
    return runs.join(logged, "run", "left_semi")


def at_least(trials: DataFrame, floor: float, col: str = "objective") -> DataFrame:
    """Trials that log the metric and reach `floor`."""
    return trials.where(F.col(col).isNotNull() & (F.col(col) >= floor))


def search_notes(tags: DataFrame, text: str, note_key: str = "mlflow.note.content") -> DataFrame:
    """Notes that mention `text`, any case."""
    return tags.where((F.col("key") == note_key) & F.contains(F.lower("value"), F.lit(text.lower())))


# ---------------------------------------------------------------- aggregates over folds


def fold_mean(metrics: DataFrame, by: list[str] = ("run", "split", "metric")) -> DataFrame:
    """Unweighted mean of the fold values."""
    return metrics.groupBy(*by).agg(F.avg("value").alias("mean"), F.count("value").alias("folds"))


def fold_spread(metrics: DataFrame, by: list[str] = ("run", "split", "metric")) -> DataFrame:
    v = F.col("value")
    return metrics.groupBy(*by).agg(
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        (F.max(v) - F.min(v)).alias("range"),
    )


def incomplete_cv(metrics: DataFrame, k: int = 5, by: list[str] = ("run", "split", "metric")) -> DataFrame:
    """Groups whose distinct folds are not exactly k."""
    return metrics.groupBy(*by).agg(F.count_distinct("fold").alias("folds")).where(F.col("folds") != k)


def folds_without_mean(metrics: DataFrame, k: int = 5) -> DataFrame:
    """Runs with fold values of a (split, metric) but no logged mean of it, or the other way round."""
    keys = decode_keys(metrics)
    flags = keys.groupBy("run", "split", "metric").agg(
        F.count_distinct("fold").alias("folds"), F.max(F.when(F.col("summary") == "mean", 1).otherwise(0)).alias("has_mean")
    )
    logged = (F.col("folds") > 0) | (F.col("has_mean") == 1)
    return flags.where(logged & ((F.col("folds") != k) | (F.col("has_mean") == 0)))


# ---------------------------------------------------------------- trials of a search


def _valid() -> Column:
    """Trials that take part in comparisons: a null or NaN objective is no objective."""
    return F.col("objective").isNotNull() & ~F.isnan("objective")


def best_trial(trials: DataFrame, by: list[str] = ("search",), keep: list[str] = ()) -> DataFrame:
    """Highest objective per search; ties go to the earliest logged, then to the lowest run."""
    ok = trials.where(_valid())
    fields = ["run", "ts", "objective", *keep]
    first = F.min_by(F.struct(*fields), F.struct(-F.col("objective"), F.col("ts"), F.col("run")))
    return ok.groupBy(*by).agg(first.alias("_b")).select(*by, "_b.*")


def search_summary(trials: DataFrame, by: list[str] = ("search",)) -> DataFrame:
    """Best, worst and mean objective, number of trials and time span of every search."""
    ok = trials.where(_valid())
    return ok.groupBy(*by).agg(
        F.max("objective").alias("best"),
        F.min("objective").alias("worst"),
        F.avg("objective").alias("mean"),
        F.count(F.lit(1)).alias("trials"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def wide(kv: DataFrame, keys: list[str], by: list[str] = ("run",), value: str = "value", how=F.max) -> DataFrame:
    """Long -> wide over the named keys."""
    return kv.groupBy(*by).pivot("key", list(keys)).agg(how(value))


def long(df: DataFrame, keys: list[str], by: list[str] = ("run",)) -> DataFrame:
    """Wide -> long; absent (null) values give no row."""
    return df.unpivot(list(by), list(keys), "key", "value").where(F.col("value").isNotNull())


def leaderboard(trials: DataFrame, levels: list[str] = ("experiment", "script")) -> DataFrame:
    """Best / mean / count per (experiment, script), per experiment and overall; `level` 0 is the finest."""
    known = F.when(_valid(), F.col("objective"))
    return trials.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level"),
        F.max(known).alias("best"),
        F.avg(known).alias("mean"),
        F.count(known).alias("trials"),
    )


def param_profile(params: DataFrame, by: list[str] = ("script", "key")) -> DataFrame:
    """Numeric search space per (script, key): count, distinct, min, median, max."""
    by = list(by)
    num = params.select(*by, V.as_double(F.col("value")).alias("x")).where(F.col("x").isNotNull())
    # One row per distinct value, written once: everything below works on these counts.
    counts = written(num.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("_n")), "counts")
    base = counts.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("distinct"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    return join_groups(base, quantiles_of_counts(counts, by, "x", {"median": 0.5}), by)


def enum_profile(params: DataFrame, by: list[str] = ("script", "key")) -> DataFrame:
    """How often each non-numeric value was tried."""
    text = params.where(~V.value_type(F.col("value")).isin("int", "double"))
    return text.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))


def param_effect(trials: DataFrame, by: list[str] = ("script", "key"), hot_rows=None) -> DataFrame:
    """Pearson and rank correlation of a numeric parameter `x` with the objective, per (script, key).

    Trials without a parameter or an objective (null or NaN) take no part. Small groups are ranked by two windows; with a group above
    `hot_rows` the values are counted and ranked as counts.
    """
    by = list(by)
    known = trials.where(_valid() & F.col("x").isNotNull() & ~F.isnan("x"))
    limit = session_hot_rows(trials.sparkSession) if hot_rows is None else hot_rows
    if not by or has_hot_group(known, by, limit):
        return _effect_of_counts(known, by, hot_rows)

    def rank(col: str) -> Column:
        ties = F.count(F.lit(1)).over(Window.partitionBy(*by, col))
        return F.rank().over(Window.partitionBy(*by).orderBy(col)) + (ties - 1) / 2.0

    ranked = known.withColumn("rx", rank("x")).withColumn("ry", rank("objective"))
    return ranked.groupBy(*by).agg(
        F.corr("x", "objective").alias("pearson"), F.corr("rx", "ry").alias("spearman"), F.count(F.lit(1)).alias("n")
    )


def _effect_of_counts(known: DataFrame, by: list[str], hot_rows) -> DataFrame:
    """`param_effect` of large groups. The rows meet the ranks of `x` only: each objective's count carries the sum of these ranks, so
    the rows need no join with the objective's ranks. Ranks are taken from their mean."""
    sizes = written(known.groupBy(*by).agg(F.corr("x", "objective").alias("pearson"), F.count(F.lit(1)).alias("n")), "sizes")

    def centred(counts: DataFrame, col: str) -> DataFrame:
        upto = over_order(counts, by, [col], {"_cum": running("sum", "_n")}, hot_rows)
        rank = F.col("_cum") - (F.col("_n") - 1) / 2.0
        return join_groups(upto, sizes.select(*by, "n"), by).withColumn("_d", rank - (F.col("n") + 1) / 2.0).drop("_cum", "n")

    spread = lambda name: F.sum(F.col("_n") * F.col("_d") * F.col("_d")).alias(name)
    xs = written(centred(written(known.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("_n")), "counts"), "x"), "ranks")
    rows = join_groups(known.select(*by, "x", "objective"), xs.select(*by, "x", "_d"), [*by, "x"])
    ys = written(rows.groupBy(*by, "objective").agg(F.count(F.lit(1)).alias("_n"), F.sum("_d").alias("_s")), "counts")
    both = centred(ys, "objective").groupBy(*by).agg(F.sum(F.col("_s") * F.col("_d")).alias("_xy"), spread("_yy"))
    whole = join_groups(join_groups(sizes, xs.groupBy(*by).agg(spread("_xx")), by), both, by)
    # A single row has neither correlation.
    spearman = F.when(F.col("_xx") * F.col("_yy") > 0, F.col("_xy") / F.sqrt(F.col("_xx")) / F.sqrt(F.col("_yy"))).otherwise(F.col("pearson"))
    return whole.select(*by, "pearson", spearman.alias("spearman"), "n")


def enum_effect(trials: DataFrame, by: list[str] = ("script", "key")) -> DataFrame:
    """Mean and best objective per enum value, and its trials; a null or NaN objective counts as a trial only."""
    known = F.when(_valid(), F.col("objective"))
    return trials.groupBy(*by, "value").agg(F.avg(known).alias("mean"), F.max(known).alias("best"), F.count(F.lit(1)).alias("n"))


def key_census(params: DataFrame) -> DataFrame:
    """Runs per key; keys seen in one run only are flagged (likely misspelt)."""
    c = params.groupBy("key").agg(F.count_distinct("run").alias("runs"))
    return c.select("key", "runs", (F.col("runs") == 1).alias("only_once"))


def irreproducible(trials: DataFrame) -> DataFrame:
    """Same script and same params, different objective."""
    g = trials.groupBy("script", "fp").agg(
        F.count(F.lit(1)).alias("runs"), F.min("objective").alias("low"), F.max("objective").alias("high")
    )
    return g.where((F.col("runs") > 1) & (F.col("high") > F.col("low"))).select(
        "*", (F.col("high") - F.col("low")).alias("gap")
    )


def durations(runs: DataFrame, by: list[str] = ("script",)) -> DataFrame:
    """Min / median / max seconds."""
    by = list(by)
    ends = runs.groupBy(*by).agg(
        F.count("seconds").alias("runs"), F.min("seconds").alias("shortest"), F.max("seconds").alias("longest")
    )
    return join_groups(ends, exact_quantiles(runs, by, "seconds", {"median": 0.5}), by, "left")


# ---------------------------------------------------------------- order inside a search


def trial_no(trials: DataFrame, by: list[str] = ("search",), hot_rows=None) -> DataFrame:
    """Trial number inside a search by log time."""
    return over_order(trials, list(by), ["ts", "run"], {"trial": row_number()}, hot_rows)


def best_so_far(trials: DataFrame, by: list[str] = ("search",), hot_rows=None) -> DataFrame:
    """Running best, and whether the trial improved on everything before it."""
    known = trials.withColumn("_now", F.when(_valid(), F.col("objective")))
    r = over_order(known, list(by), ["ts", "run"], {"_before": best_before("_now")}, hot_rows)
    before, now = F.col("_before"), F.col("_now")
    improved = now.isNotNull() & (before.isNull() | (now > before))
    return r.select(*trials.columns, F.greatest(before, now).alias("best"), improved.alias("improved"))


def rank_trials(trials: DataFrame, by: list[str], hot_rows=None) -> DataFrame:
    """Rank, dense rank and percent rank by objective, best first.

    Equal objectives share a rank: when a group is too big for one task, ranks are found on the counted
    distinct objectives and joined back. Trials without an objective are not ranked.
    """
    by = list(by)
    trials = trials.where(_valid())
    limit = session_hot_rows(trials.sparkSession) if hot_rows is None else hot_rows
    if not has_hot_group(trials, by, limit):
        w = Window.partitionBy(*by).orderBy(F.desc("objective"))
        return trials.select(
            "*",
            F.rank().over(w).cast("long").alias("rank"),
            F.dense_rank().over(w).cast("long").alias("dense_rank"),
            F.percent_rank().over(w).alias("percent_rank"),
        )
    counts = written(trials.groupBy(*by, "objective").agg(F.count(F.lit(1)).alias("_n")), "counts")
    placed = over_order(
        counts, by, ["-objective"], {"_cum": running("sum", "_n"), "dense_rank": row_number()}, limit
    ).withColumn("rank", F.col("_cum") - F.col("_n") + 1)
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    ranks = join_groups(placed, sizes, by).select(
        *by,
        "objective",
        "rank",
        "dense_rank",
        F.when(F.col("_size") > 1, (F.col("rank") - 1) / (F.col("_size") - 1)).otherwise(0.0).alias("percent_rank"),
    )
    return join_groups(trials, ranks, [*by, "objective"])


def fold_seconds(metrics: DataFrame, by: list[str] = ("run",), tie: list[str] = ("fold",), hot_rows=None) -> DataFrame:
    """Seconds since the log before it, per run."""
    r = over_order(metrics, list(by), ["ts", *tie], {"_prev": previous("ts")}, hot_rows)
    return r.select(*metrics.columns, ((F.col("ts") - F.col("_prev")) / 1000.0).alias("seconds"))


def fold_order(metrics: DataFrame, by: list[str] = ("run",), tie: list[str] = (), hot_rows=None) -> DataFrame:
    """Position of every fold in the run's log, and whether it follows the fold logged before it."""
    order = ["ts", "fold", *tie]
    r = over_order(metrics, list(by), order, {"position": row_number(), "_prev": previous("fold")}, hot_rows)
    return r.select(
        *metrics.columns, "position", (F.col("_prev").isNull() | (F.col("fold") >= F.col("_prev"))).alias("in_order")
    )


def latest_model(models: DataFrame, by: list[str] = ("name",), keep: list[str] = ("run",)) -> DataFrame:
    """Last registry state per model; ties on time go to the highest run."""
    last = F.max_by(F.struct("ts", *keep), F.struct("ts", *keep))
    return models.groupBy(*by).agg(last.alias("_m")).select(*by, "_m.*")


def top_trials(trials: DataFrame, k: int) -> DataFrame:
    """The k best trials over everything: highest objective, then earliest, then lowest run."""
    return trials.where(_valid()).orderBy(F.desc("objective"), "ts", "run").limit(k)


def top_per(trials: DataFrame, by: list[str], n: int) -> DataFrame:
    """The n best trials per group.

    Spark cuts each group to n rows before the shuffle (window group limit, up to its threshold), so a
    hot group sends at most n rows per input partition; a larger n goes through the split-group order.
    """
    trials = trials.where(_valid())
    limit = int(trials.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        return over_order(trials, list(by), ["-objective", "ts", "run"], {"place": row_number()}).where(F.col("place") <= n)
    w = Window.partitionBy(*by).orderBy(F.desc("objective"), "ts", "run")
    return trials.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= n)


# ---------------------------------------------------------------- sets


def union_runs(*dfs: DataFrame) -> DataFrame:
    """Runs of several experiments with differing columns; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def shared_keys(params: DataFrame, a: str, b: str) -> DataFrame:
    """Keys that both scripts log."""
    keys = params.where(F.col("script").isin(a, b)).groupBy("key").agg(F.count_distinct("script").alias("_n"))
    return keys.where(F.col("_n") == 2).select("key")


def only_in(pins: DataFrame, a: str, b: str, by: str = "model") -> DataFrame:
    """Packages (with operator and version) pinned by `a` and not by `b`."""
    cols = ["package", "op", "version"]
    both = pins.where(F.col(by).isin(a, b)).groupBy(*cols).agg(
        F.max((F.col(by) == a).cast("int")).alias("_a"), F.max((F.col(by) == b).cast("int")).alias("_b")
    )
    return both.where((F.col("_a") == 1) & (F.col("_b") == 0)).select(*cols)


def distinct_trials(trials: DataFrame) -> DataFrame:
    """One row per (script, fingerprint): the earliest run of each tried configuration."""
    first = F.min_by(F.struct("run", "ts", "objective"), F.struct("ts", "run"))
    return trials.groupBy("script", "fp").agg(first.alias("_t"), F.count(F.lit(1)).alias("tries")).select(
        "script", "fp", "tries", "_t.*"
    )
