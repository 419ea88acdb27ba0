"""Joins over run logs, registries and environments."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators.ordered import join_groups, last_known, over_order, running, size_checked
from harrow.operators.runs import param_fingerprint
from harrow.session import written

#: Rows that one task of a grouped pass takes in, by their number before any are combined.
ROWS_A_TASK = 500_000


def with_experiment(runs: DataFrame, experiments: DataFrame) -> DataFrame:
    """Run with its experiment; the experiment side is broadcast only after its size was read."""
    return runs.join(size_checked(experiments), "experiment_id")


def with_parent(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Child run with its parent's columns, prefixed `parent_`.

    Parents are unique, so a parent with very many children is skewed on one side only, which adaptive
    execution splits.
    """
    p = parents.select(*[F.col(c).alias(c if c == "parent" else f"parent_{c}") for c in parents.columns])
    return children.join(p, "parent")


def trials(metrics: DataFrame, params: DataFrame, metric_keys: list[str], param_keys: list[str], by=("run",)) -> DataFrame:
    """One row per run: the named metrics and params side by side.

    Both sides are folded to one row per run before the join, so the join is one to one.
    """
    by = list(by)
    m = metrics.groupBy(*by).pivot("key", list(metric_keys)).agg(F.max("value"))
    p = params.groupBy(*by).pivot("key", list(param_keys)).agg(F.max("value"))
    return m.join(p, by)


def aborted(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Runs that logged no metric."""
    return runs.join(metrics.select("run").distinct(), "run", "left_anti")


def searches(runs: DataFrame, children: DataFrame) -> DataFrame:
    """Runs that are the parent of at least one run."""
    return runs.join(children.select(F.col("parent").alias("run")).distinct(), "run", "left_semi")


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str], value: list[str], hot_rows=None) -> DataFrame:
    """Each left row with the latest right row of the same group at or before it (null when none).

    Both sides are put in one order and the last right row is carried forward: no range join, and a
    hot group is cut into ranges like any other. Of several right rows at one time the highest
    `value` tuple wins.
    """
    by = list(by)
    payload = F.struct(F.col(on).alias(f"right_{on}"), *[F.col(v).alias(f"right_{v}") for v in value])
    typed = right.select(payload.alias("_p")).schema["_p"].dataType
    l = left.select(*[F.col(c) for c in left.columns], F.lit(1).alias("_side"), F.lit(None).cast(typed).alias("_p"))
    r = right.select(*by, F.col(on), F.lit(0).alias("_side"), payload.alias("_p"))
    both = l.unionByName(r, allowMissingColumns=True)
    carried = over_order(both, by, [on, "_side", "_p"], {"_last": last_known("_p")}, hot_rows)
    return carried.where(F.col("_side") == 1).select(*left.columns, "_last.*")


def overlaps(runs: DataFrame, by: list[str] = ("search",), hot_rows=None) -> DataFrame:
    """Runs that were active at the same time as another run of the same search, with how many others.

    A run [start, end) meets every run that starts before its end and has not ended by its start:
    starts before `end` minus ends up to `start`, minus itself. Both counts are running sums over one
    ordering of the instants, so no pair of runs is ever formed. Runs of no length meet nothing.
    """
    by = list(by)
    # A run without an end is still running: it ends after every instant.
    still = F.lit(2**63 - 1).cast("long") if dict(runs.dtypes)["end_time"] == "bigint" else F.lit("9999-12-31").cast(dict(runs.dtypes)["end_time"])
    runs = runs.withColumn("end_time", F.coalesce(F.col("end_time"), still))
    spans = runs.where(F.col("end_time") > F.col("start_time"))
    # At one instant: first ends are counted, then starts are asked and counted, ends ask before starts count.
    marks = spans.select(
        *by,
        "run",
        F.explode(
            F.array(
                F.struct(F.col("end_time").alias("t"), F.lit(0).alias("kind"), F.lit(0).alias("s"), F.lit(1).alias("e")),
                F.struct(F.col("start_time").alias("t"), F.lit(1).alias("kind"), F.lit(1).alias("s"), F.lit(0).alias("e")),
            )
        ).alias("m"),
    ).select(*by, "run", "m.*")
    counted = over_order(
        marks, by, ["t", "kind", "run"], {"starts": running("sum", "s"), "ends": running("sum", "e")}, hot_rows
    )
    each = counted.groupBy(*by, "run").agg(
        F.max(F.when(F.col("kind") == 0, F.col("starts"))).alias("_begun"),
        F.max(F.when(F.col("kind") == 1, F.col("ends"))).alias("_over"),
    )
    return each.select(*by, "run", (F.col("_begun") - F.col("_over") - 1).alias("others")).where(F.col("others") > 0)


def concurrency(runs: DataFrame, by: list[str] = (), hot_rows=None) -> DataFrame:
    """Number of active runs after every instant at which it changes.

    +1 / -1 marks are summed per instant first (map-side), then summed in order.
    """
    by = list(by)
    marks = runs.where(F.col("start_time").isNotNull()).select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("start_time").alias("t"), F.lit(1).alias("d")),
                F.struct(F.col("end_time").alias("t"), F.lit(-1).alias("d")),
            )
        ).alias("m"),
    ).select(*by, "m.*").where(F.col("t").isNotNull())  # an open run has no end mark
    net = written(marks.groupBy(*by, "t").agg(F.sum("d").alias("change")), "changes")
    return over_order(net, by, ["t"], {"depth": running("sum", "change")}, hot_rows)


def env_diff(pins: DataFrame, a: str, b: str, by: str = "model") -> DataFrame:
    """Packages whose pin differs between two models (absent on one side included)."""
    side = pins.where(F.col(by).isin(a, b)).groupBy("package").agg(
        F.max(F.when(F.col(by) == a, F.concat("op", "version"))).alias("a"),
        F.max(F.when(F.col(by) == b, F.concat("op", "version"))).alias("b"),
    )
    return side.where(~F.col("a").eqNullSafe(F.col("b")))


def cv_grid(trials: DataFrame, k: int) -> DataFrame:
    """Every trial once per fold 1..k: a row-local explode, no join and no shuffle."""
    return trials.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))


def score_join(pred: DataFrame, truth: DataFrame, on: str = "sample") -> DataFrame:
    """Predictions with the true label of their sample."""
    return pred.join(truth, on)


def tasks_for(*rows: DataFrame) -> int:
    """Tasks that rows grouped in one pass are dealt to; they grow with the rows, so what a task sorts does not."""
    return max(1, -(-sum(r.count() for r in rows) // ROWS_A_TASK))


def key_values(rows: DataFrame, how: str, tasks: int, by: list[str] = ("search",)) -> DataFrame:
    """One row per key: the `how` (max or min) of its text values.

    Each Arrow batch is combined where it is read, without a sort, so a key with very many rows reaches its task as one row
    per batch. The rows are then dealt by number: adaptive execution would merge the partitions again by their compressed
    size, which says little of the memory that sorting takes.
    """
    keys = [*by, "key"]
    rows = rows.select(*keys, F.col("value").cast("string").alias("value"))

    def combine(batches):
        for b in batches:
            best = pa.Table.from_batches([b]).group_by(keys, use_threads=False).aggregate([("value", how)])
            yield from best.rename_columns([*keys, "value"]).cast(b.schema).to_batches()

    dealt = rows.mapInArrow(combine, rows.schema).repartition(tasks, *keys)
    return dealt.groupBy(*keys).agg(getattr(F, how)("value").alias("value"))


def param_drift(parent: DataFrame, child: DataFrame, by: list[str] = ("search",)) -> DataFrame:
    """Keys whose recorded value on a search differs from that of its best trial, absent keys included.

    One grouped pass over both sides stands in for the full outer join. Sides made by `key_values` with the same number of
    tasks meet without another shuffle.
    """
    by = list(by)
    rows = parent.select(*by, "key", F.col("value").alias("recorded"), F.lit(None).cast("string").alias("best")).unionByName(
        child.select(*by, "key", F.lit(None).cast("string").alias("recorded"), F.col("value").alias("best"))
    )
    g = rows.groupBy(*by, "key").agg(F.max("recorded").alias("recorded"), F.max("best").alias("best"))
    return g.where(~F.col("recorded").eqNullSafe(F.col("best")))


def model_mismatch(pins: DataFrame, rules: DataFrame) -> DataFrame:
    """Saved runs (model, run) that do not pin the package their model name calls for.

    `rules(model, expected)`: a small table; a model without a rule is not judged.
    """
    saved = pins.select("model", "run").distinct().join(size_checked(rules), "model")
    have = pins.select("model", "run", F.col("package").alias("expected")).distinct()
    return saved.join(have, ["model", "run", "expected"], "left_anti")


def env_census(pins: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Per model family: distinct environments, runs, and the most common pin (ties: lowest text).

    An unpinned package counts as a pin of its bare name.
    """
    by = list(by)
    as_kv = pins.select(*by, "run", F.col("package").alias("key"), F.concat_ws("", "op", "version").alias("value"))
    envs = param_fingerprint(as_kv, [*by, "run"]).groupBy(*by).agg(
        F.count_distinct("fp").alias("environments"), F.count(F.lit(1)).alias("runs")
    )
    pin = F.concat_ws("", "package", "op", "version")
    used = pins.select(*by, pin.alias("pin"), "run").groupBy(*by, "pin").agg(F.count_distinct("run").alias("n"))
    common = used.groupBy(*by).agg(F.min_by(F.struct("pin", "n"), F.struct(-F.col("n"), F.col("pin"))).alias("_c"))
    return join_groups(envs, common, by).select(
        *by, "environments", "runs", F.col("_c.pin").alias("common_pin"), F.col("_c.n").alias("common_runs")
    )


def crs_mismatch(layers: DataFrame, by: str, base: str) -> DataFrame:
    """Layers whose coordinate system differs from that of their group's base layer, or is missing.

    Compared with the one base layer per group, not layer against layer: the result has at most one
    row per layer and no pairs are formed.
    """
    ref = layers.where(F.col("name") == base).groupBy(by).agg(F.max("crs").alias("base_crs"))
    others = layers.where(F.col("name") != base)
    joined = others.join(ref, by, "left")
    return joined.where(F.col("crs").isNull() | ~F.col("crs").eqNullSafe(F.col("base_crs"))).select(
        by, "name", "crs", "base_crs"
    )
