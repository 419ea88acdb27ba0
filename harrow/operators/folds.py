"""Folds, class weights, scaling and cross-validation."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions.values import unit_hash
from harrow.operators.metrics import scores, scores_of_cells
from harrow.operators.ordered import join_groups, over_order, row_number, size_checked
from harrow.session import written


def stratified_folds(df: DataFrame, label: str, k: int, order: list[str], hot_rows=None) -> DataFrame:
    """Fold 1..k per row: rows in order of class, then `order`, dealt out in turn.

    Fold sizes, and each class's counts over the folds, differ by at most one, larger first. The one
    global order is cut into ranges, so neither a big class nor the whole table meets in one task.
    """
    numbered = over_order(df, [], [label, *order], {"_pos": row_number()}, hot_rows)
    return numbered.select(*df.columns, ((F.col("_pos") - 1) % k + 1).cast("int").alias("fold"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """'balanced' weight n / (classes * n_class) for every class."""
    counts = size_checked(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    totals = counts.agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_k")).first()
    return counts.select(label, "n", (F.lit(float(totals["_all"] or 0)) / (F.lit(totals["_k"]) * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Rows with their class weight; the weight table is broadcast only after its size was read."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return join_groups(df, size_checked(w), [label])


#: Draws of one row that a bootstrap tells apart; more have a chance below 1e-12, less than a hash value's own.
MAX_DRAWS = 14


def bootstrap_weights(df: DataFrame, trees: int, key: str, label: str = "label", seed: int = 42) -> DataFrame:
    """'balanced_subsample': (tree, `key`, `label`, draws, weight) of every row that a tree's bootstrap holds.

    A row comes `draws` times, Poisson with mean 1, read off a hash of (seed, tree, key): the same on every run and partitioning. The
    weight is n / (classes * n_class) within the tree's own bootstrap, each row counted by its draws. Rows with one key are drawn alike;
    a null key and a null label are values like any other.
    """
    drawn = df.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), key, label)
    u = unit_hash(F.lit(seed), F.col("tree"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    upto = [math.exp(-1) * sum(1 / math.factorial(i) for i in range(j + 1)) for j in range(MAX_DRAWS)]
    drawn = drawn.withColumn("draws", reduce(lambda a, b: a + b, [(u > p).cast("int") for p in upto])).where("draws > 0")
    counts = drawn.groupBy("tree", label).agg(F.sum("draws").alias("_n"))
    totals = counts.groupBy("tree").agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    weights = counts.join(totals, "tree").select("tree", label, (F.col("_all").cast("double") / (F.col("_k") * F.col("_n"))).alias("weight"))
    return join_groups(drawn, size_checked(weights), ["tree", label])


def standard_scale(df: DataFrame, cols: list[str], by: list[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, fitted on `fit_on` (default: the rows themselves); constant columns give 0.

    Adds `<col>_scaled`.
    """
    by = list(by)
    fit = df if fit_on is None else fit_on
    stats = fit.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]
    )
    if by:
        joined = join_groups(df, size_checked(stats), by)
        m, s = (lambda c: F.col(f"_m_{c}")), (lambda c: F.col(f"_s_{c}"))
    else:
        row = stats.first()
        joined = df
        m, s = (lambda c: F.lit(row[f"_m_{c}"])), (lambda c: F.lit(row[f"_s_{c}"]))
    return joined.select(
        *df.columns, *[F.when(s(c) > 0, (F.col(c) - m(c)) / s(c)).otherwise(0.0).alias(f"{c}_scaled") for c in cols]
    )


ROWS_PER_TASK = 20_000


def training_size(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Join partitions that hold few rows (never splits, never moves rows apart).

    An iterative fit visits its rows many times in short jobs: a small table trains fastest in few
    tasks. Above `rows_per_task` rows per partition nothing changes.
    """
    return df.coalesce(max(1, math.ceil(df.count() / rows_per_task)))


# A fitted rule: takes rows, gives the same rows plus `pred`.
Rule = Callable[[DataFrame], DataFrame]


def cross_validate(
    df: DataFrame,
    fit: Callable[[DataFrame], Rule],
    k: int,
    cls: int = 0,
    train_scores: bool = False,
    parallelism: int | None = None,
) -> DataFrame:
    """Scores per fold (and split): fit on the other folds, predict the held-out one.

    `df` has `fold` 1..k and `label`; `fit(train)` returns a rule. The k fits are independent Spark
    jobs started from a few driver threads; all predictions are scored in one grouped pass. An estimator that needs counts only
    (`CountedFit`) reads `df` once instead.
    """
    if isinstance(fit, CountedFit):
        return fit.cross_validated(df, k, cls, train_scores)

    def one(fold: int) -> DataFrame:
        rule = fit(df.where(F.col("fold") != fold))
        held = rule(df.where(F.col("fold") == fold))
        out = held.select(F.lit(fold).alias("fold"), F.lit("val").alias("split"), "label", "pred")
        if train_scores:
            seen = rule(df.where(F.col("fold") != fold))
            out = out.unionByName(seen.select(F.lit(fold).alias("fold"), F.lit("train").alias("split"), "label", "pred"))
        return out

    with ThreadPoolExecutor(max_workers=min(parallelism or k, k)) as pool:
        parts = list(pool.map(one, range(1, k + 1)))
    return scores(reduce(DataFrame.unionByName, parts), cls, ["split", "fold"])


def cv_means(fold_scores: DataFrame, by: list[str] = ("split",)) -> DataFrame:
    """Unweighted means over the folds."""
    return fold_scores.groupBy(*by).agg(
        F.avg("accuracy").alias("accuracy_mean"), F.avg("f1").alias("f1_mean"), F.avg("kappa").alias("kappa_mean"),
        F.count(F.lit(1)).alias("folds"),
    )


class CountedFit:
    """Majority label of each `by` group (ties: lowest label), an estimator whose training set matters only by its counts.

    So the rows are counted once by (fold, group, label), the training counts of a fold are all counts less its own, and both splits are
    scored from counts.
    """

    def __init__(self, by: list[str]):
        self.by = list(by)

    def __call__(self, train: DataFrame) -> Rule:
        counts = train.groupBy(*self.by, "label").agg(F.count(F.lit(1)).alias("_n"))
        table = self._majority(counts, self.by)
        if not self.by:
            row = table.first()
            value = row["pred"] if row else None
            return lambda rows: rows.withColumn("pred", F.lit(value))
        small = size_checked(table)
        return lambda rows: join_groups(rows, small, self.by, "left")

    @staticmethod
    def _majority(counts: DataFrame, by: list[str]) -> DataFrame:
        first = F.min_by("label", F.struct(-F.col("_n"), F.col("label"))).alias("pred")
        return counts.groupBy(*by).agg(first)

    def cross_validated(self, df: DataFrame, k: int, cls: int = 0, train_scores: bool = False) -> DataFrame:
        """As `cross_validate`, from one scan of `df`: rows outside the folds 1..k train every fold, a group no fold trains on is predicted null."""
        by = [f"_by{i}" for i in range(len(self.by))]
        named = df.select("fold", *[F.col(c).alias(b) for c, b in zip(self.by, by)], "label")
        counts = written(named.groupBy("fold", *by, "label").agg(F.count(F.lit(1)).alias("_n")), "fold_counts")
        whole = counts.groupBy(*by, "label").agg(F.sum("_n").alias("_all"))
        held = whole.withColumn("fold", F.explode(F.array(*[F.lit(f).cast(df.schema["fold"].dataType) for f in range(1, k + 1)])))
        own = join_groups(held, counts, ["fold", *by, "label"], "left")
        train = own.withColumn("_n", F.col("_all") - F.coalesce("_n", F.lit(0))).where("_n > 0").drop("_all")
        rule = self._majority(train, ["fold", *by])

        def cells(rows: DataFrame, split: str) -> DataFrame:
            said = join_groups(rows, rule, ["fold", *by], "left")
            return said.select("fold", F.lit(split).alias("split"), "label", "pred", F.col("_n").alias("n"))

        out = cells(counts.where(F.col("fold").between(1, k)), "val")
        return scores_of_cells(out.unionByName(cells(train, "train")) if train_scores else out, cls, ["split", "fold"])


def majority_rule(by: list[str]) -> CountedFit:
    """Estimator that predicts the most frequent training label of each `by` group (ties: lowest label).

    With `by` empty it is the constant predictor.
    """
    return CountedFit(by)
