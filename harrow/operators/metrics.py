"""Scores of predictions pred(fold, label, pred[, score]) and threshold tuning.

Everything starts from counts that combine map-side; classes and folds are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.ordered import join_groups, over_order, running
from harrow.session import written


def confusion(pred: DataFrame, by: list[str] = ("fold",)) -> DataFrame:
    return pred.groupBy(*by, "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy_agg() -> Column:
    return F.avg((F.col("label") == F.col("pred")).cast("int"))


def f1_agg(cls: int = 0) -> Column:
    """2TP / (2TP + FP + FN) = 2TP / (actual + predicted); 0 when the class never appears."""
    hit = F.sum(((F.col("label") == cls) & (F.col("pred") == cls)).cast("long"))
    both = F.sum((F.col("label") == cls).cast("long") + (F.col("pred") == cls).cast("long"))
    return F.when(both > 0, 2.0 * hit / both).otherwise(0.0)


def accuracy(pred: DataFrame, by: list[str] = ("fold",)) -> DataFrame:
    return pred.groupBy(*by).agg(accuracy_agg().alias("accuracy"))


def f1_class(pred: DataFrame, cls: int = 0, by: list[str] = ("fold",)) -> DataFrame:
    return pred.groupBy(*by).agg(f1_agg(cls).alias("f1"))


def kappa(pred: DataFrame, by: list[str] = ("fold",)) -> DataFrame:
    """Cohen's kappa (po - pe) / (1 - pe); 0 for a predictor that only ever says one class."""
    return scores(pred, by=by).select(*by, "kappa")


def scores(pred: DataFrame, cls: int = 0, by: list[str] = ("fold",)) -> DataFrame:
    """Accuracy, F1 of one class and kappa per group, from one pass over the predictions."""
    return scores_of_cells(confusion(pred, by), cls, by)


def scores_of_cells(cells: DataFrame, cls: int = 0, by: list[str] = ("fold",)) -> DataFrame:
    """The scores from counts (*by, label, pred, n); a cell may come in several rows."""
    by = list(by)
    # Row and column totals of the confusion matrix, side by side per class.
    margins = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p")),
                F.struct(F.col("pred").alias("c"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p")),
            )
        ).alias("m"),
        F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("hit"),
    )
    per_class = margins.groupBy(*by, F.col("m.c").alias("c")).agg(
        F.sum("m.a").alias("a"), F.sum("m.p").alias("p"), (F.sum("hit") / 2).alias("hit")
    )
    n = F.sum("a")
    both = F.sum(F.when(F.col("c") == cls, F.col("a") + F.col("p")).otherwise(0))
    hits = F.sum(F.when(F.col("c") == cls, F.col("hit")).otherwise(0))
    g = per_class.groupBy(*by).agg(
        (F.sum("hit") / n).alias("accuracy"),
        F.when(both > 0, 2.0 * hits / both).otherwise(0.0).alias("f1"),
        (F.sum(F.col("a").cast("double") * F.col("p")) / (n.cast("double") * n)).alias("_pe"),
    )
    return g.select(
        *by,
        "accuracy",
        "f1",
        F.when(F.col("_pe") < 1, (F.col("accuracy") - F.col("_pe")) / (1 - F.col("_pe"))).otherwise(0.0).alias("kappa"),
    )


def threshold_curve(pred: DataFrame, cls: int = 0, by: list[str] = (), hot_rows=None) -> DataFrame:
    """Precision, recall and F1 of class `cls` when everything scored at or above each distinct score is taken.

    Rows are counted per score first (and written once), then summed from the top score down.
    """
    by = list(by)
    per = written(
        pred.groupBy(*by, "score").agg(
            F.sum((F.col("label") == cls).cast("long")).alias("_t"), F.sum((F.col("label") != cls).cast("long")).alias("_f")
        ),
        "scores",
    )
    upto = over_order(per, by, ["-score"], {"tp": running("sum", "_t"), "fp": running("sum", "_f")}, hot_rows)
    total = per.groupBy(*by).agg(F.sum("_t").alias("_pos")) if by else None
    if by:
        upto = join_groups(upto, total, by)
    else:
        # One number for the whole table.
        upto = upto.withColumn("_pos", F.lit(per.agg(F.sum("_t")).first()[0] or 0))
    tp, fp, pos = F.col("tp"), F.col("fp"), F.col("_pos")
    return upto.select(
        *by,
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        (tp / (tp + fp)).alias("precision"),
        F.when(pos > 0, tp / pos).otherwise(0.0).alias("recall"),
        F.when(tp + fp + pos > 0, 2.0 * tp / (tp + fp + pos)).otherwise(0.0).alias("f1"),
    )


def best_threshold(pred: DataFrame, cls: int = 0, by: list[str] = (), hot_rows=None) -> DataFrame:
    """The threshold with the highest F1 of class `cls`; ties go to the higher threshold (our criterion)."""
    curve = threshold_curve(pred, cls, by, hot_rows)
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", "threshold"))
    return curve.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def vote(preds: DataFrame, how: str = "soft", weights: dict[str, float] | None = None) -> DataFrame:
    """Ensemble label per sample from member class scores preds(sample, member, cls, score).

    soft: highest weighted mean score; hard: each member votes for its top class. Ties: lowest class.
    """
    w = F.lit(1.0)
    for member, value in (weights or {}).items():
        w = F.when(F.col("member") == member, F.lit(float(value))).otherwise(w)
    if how == "soft":
        tally = preds.groupBy("sample", "cls").agg((F.sum(w * F.col("score")) / F.sum(w)).alias("_v"))
    elif how == "hard":
        top = F.min_by("cls", F.struct(-F.col("score"), F.col("cls"))).alias("cls")
        tally = preds.groupBy("sample", "member").agg(top).groupBy("sample", "cls").agg(F.sum(w).alias("_v"))
    else:
        raise ValueError("how is 'soft' or 'hard'")
    win = F.min_by(F.struct("cls", "_v"), F.struct(-F.col("_v"), F.col("cls")))
    return tally.groupBy("sample").agg(win.alias("_w")).select("sample", F.col("_w.cls").alias("pred"), F.col("_w._v").alias("support"))


def contingency(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))


def purity(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Per cluster: size, majority label (ties: lowest) and the share it holds."""
    c = contingency(df, cluster, label)
    top = F.min_by(F.struct(label, "n"), F.struct(-F.col("n"), F.col(label)))
    g = c.groupBy(cluster).agg(F.sum("n").alias("size"), top.alias("_t"))
    return g.select(
        cluster, "size", F.col(f"_t.{label}").alias("majority"), (F.col("_t.n") / F.col("size")).alias("purity")
    )
