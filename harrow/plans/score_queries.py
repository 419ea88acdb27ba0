"""Scores, folds, weights, thresholds, votes, cross-validation with rule models."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import folds as K
from harrow.operators import metrics as M
from harrow.plans import fixtures as X
from harrow.plans.registry import query, rounded


@query("A7", "SELECT fold, label, pred, count(*) AS n FROM v_pred GROUP BY ALL", ("v_pred",))
def confusion(spark, sf):
    return M.confusion(X.v_pred(spark, sf))


@query("A8", "SELECT fold, round(avg(CAST(label = pred AS INTEGER)), 9) AS accuracy FROM v_pred GROUP BY fold", ("v_pred",))
def accuracy(spark, sf):
    return rounded(M.accuracy(X.v_pred(spark, sf)), 9)


_F1 = """2.0 * count(*) FILTER (label = 0 AND pred = 0) /
  (count(*) FILTER (label = 0) + count(*) FILTER (pred = 0))"""


@query("A9", f"SELECT fold, round({_F1}, 9) AS f1 FROM v_pred GROUP BY fold", ("v_pred",))
def f1_class(spark, sf):
    return rounded(M.f1_class(X.v_pred(spark, sf)), 9)


_KAPPA_CTES = """, n AS (SELECT {by}, count(*) AS n, avg(CAST(label = pred AS INTEGER)) AS po, {f1} AS f1 FROM {src} GROUP BY ALL),
  a AS (SELECT {by}, label AS c, count(*) AS a FROM {src} GROUP BY ALL), p AS (SELECT {by}, pred AS c, count(*) AS p FROM {src} GROUP BY ALL),
  e AS (SELECT {by}, sum(a.a::DOUBLE * p.p) AS s FROM a JOIN p USING ({by}, c) GROUP BY ALL)"""


@query(
    "A10",
    _KAPPA_CTES.format(by="fold", src="v_pred", f1=_F1)
    + " SELECT fold, round((po - s / (n::DOUBLE * n)) / (1 - s / (n::DOUBLE * n)), 9) AS kappa FROM n JOIN e USING (fold)",
    ("v_pred",),
)
def kappa(spark, sf):
    return rounded(M.kappa(X.v_pred(spark, sf)), 9)


_CURVE = """, g AS (SELECT {by} score, count(*) FILTER (label = 0) AS t, count(*) FILTER (label <> 0) AS f FROM v_pred GROUP BY ALL),
  c AS (SELECT {by} score AS threshold, CAST(sum(t) OVER w AS BIGINT) AS tp, CAST(sum(f) OVER w AS BIGINT) AS fp,
      sum(t) OVER ({part}) AS pos FROM g WINDOW w AS ({part} ORDER BY score DESC)),
  r AS (SELECT {by} round(threshold, 9) AS threshold, tp, fp, round(tp / (tp + fp), 9) AS precision, round(tp / pos, 9) AS recall,
      round(2.0 * tp / (tp + fp + pos), 9) AS f1 FROM c)"""


@query("W6", _CURVE.format(by="", part="") + " SELECT * FROM r", ("v_pred",))
def threshold_curve(spark, sf):
    return rounded(M.threshold_curve(X.v_pred(spark, sf)), 9)


@query("W6", _CURVE.format(by="fold,", part="PARTITION BY fold") + " SELECT * FROM r", ("v_pred",))
def threshold_curve_per_fold(spark, sf):
    return rounded(M.threshold_curve(X.v_pred(spark, sf), by=["fold"]), 9)


@query(
    "W6",
    _CURVE.format(by="fold,", part="PARTITION BY fold")
    + """ SELECT fold, threshold, precision, recall, f1 FROM r
    QUALIFY row_number() OVER (PARTITION BY fold ORDER BY f1 DESC, threshold DESC) = 1""",
    ("v_pred",),
)
def best_threshold(spark, sf):
    return rounded(M.best_threshold(X.v_pred(spark, sf), by=["fold"]), 9)


@query(
    "M6",
    """, t AS (SELECT sample, cls, avg(score) AS v FROM v_votes GROUP BY 1, 2)
    SELECT sample, cls AS pred, round(v, 6) AS support FROM t QUALIFY row_number() OVER (PARTITION BY sample ORDER BY v DESC, cls) = 1""",
    ("v_votes",),
)
def vote_soft(spark, sf):
    return rounded(M.vote(X.v_votes(spark, sf), "soft"))


@query(
    "M6",
    """, w AS (SELECT *, CASE member WHEN 'm0' THEN 2.0 ELSE 1.0 END AS w FROM v_votes),
      t AS (SELECT sample, cls, CAST(sum(w * score) / sum(w) AS DOUBLE) AS v FROM w GROUP BY 1, 2)
    SELECT sample, cls AS pred, round(v, 6) AS support FROM t QUALIFY row_number() OVER (PARTITION BY sample ORDER BY v DESC, cls) = 1""",
    ("v_votes",),
)
def vote_weighted(spark, sf):
    return rounded(M.vote(X.v_votes(spark, sf), "soft", {"m0": 2.0}))


@query(
    "M6",
    """, b AS (SELECT sample, member, cls FROM v_votes QUALIFY row_number() OVER (PARTITION BY sample, member ORDER BY score DESC, cls) = 1),
      t AS (SELECT sample, cls, CAST(count(*) AS DOUBLE) AS v FROM b GROUP BY 1, 2)
    SELECT sample, cls AS pred, v AS support FROM t QUALIFY row_number() OVER (PARTITION BY sample ORDER BY v DESC, cls) = 1""",
    ("v_votes",),
)
def vote_hard(spark, sf):
    return M.vote(X.v_votes(spark, sf), "hard")


@query(
    "W5",
    "SELECT vec_id, label, CAST((row_number() OVER (ORDER BY label, vec_id) - 1) % 5 + 1 AS INTEGER) AS fold FROM embeddings",
)
def stratified_folds(spark, sf):
    return K.stratified_folds(X.table(spark, sf, "embeddings").select("vec_id", "label"), "label", 5, ["vec_id"])


@query(
    "A18",
    """SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels)::DOUBLE / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 9) AS weight
    FROM labels GROUP BY quality""",
)
def class_weights(spark, sf):
    return rounded(K.class_weights(X.table(spark, sf, "labels"), "quality"), 9)


@query(
    "A18",
    """SELECT vec_id, label, round((SELECT count(*) FROM embeddings)::DOUBLE /
      ((SELECT count(DISTINCT label) FROM embeddings) * count(*) OVER (PARTITION BY label)), 9) AS weight FROM embeddings""",
)
def with_class_weight(spark, sf):
    df = X.table(spark, sf, "embeddings").select("vec_id", "label")
    return rounded(K.with_class_weight(df).select("vec_id", "label", "weight"), 9)


_DRAW = "(('0x' || substr(md5('7|' || CAST(tree AS VARCHAR) || '|' || CAST(vec_id AS VARCHAR)), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE"


@query(
    "A18",
    f"""WITH c AS (SELECT j, sum(exp(-1::DOUBLE) / factorial(j)) OVER (ORDER BY j) AS p FROM (SELECT CAST(range AS INTEGER) AS j FROM range(14))),
      d AS (SELECT CAST(t.range AS INTEGER) AS tree, vec_id, label FROM embeddings, range(5) t),
      h AS (SELECT tree, vec_id, label, {_DRAW} AS u FROM d),
      n AS (SELECT tree, vec_id, label, CAST((SELECT count(*) FROM c WHERE c.p < h.u) AS INTEGER) AS draws FROM h),
      s AS (SELECT tree, label, sum(draws) AS m FROM n WHERE draws > 0 GROUP BY ALL),
      w AS (SELECT tree, label, (sum(m) OVER (PARTITION BY tree))::DOUBLE / (count(*) OVER (PARTITION BY tree) * m) AS weight FROM s)
    SELECT tree, vec_id, label, draws, round(weight, 9) AS weight FROM n JOIN w USING (tree, label) WHERE draws > 0""",
)
def bootstrap_weights(spark, sf):
    df = X.table(spark, sf, "embeddings").select("vec_id", "label")
    return rounded(K.bootstrap_weights(df, 5, "vec_id", seed=7), 9)


@query(
    "A19",
    """SELECT l_orderkey, l_returnflag,
      round((l_quantity - avg(l_quantity) OVER w) / stddev_pop(l_quantity) OVER w, 6) AS l_quantity_scaled,
      round((l_tax - avg(l_tax) OVER w) / stddev_pop(l_tax) OVER w, 6) AS l_tax_scaled
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""",
)
def standard_scale(spark, sf):
    li = X.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_tax")
    scaled = K.standard_scale(li, ["l_quantity", "l_tax"], ["l_returnflag"])
    return rounded(scaled.drop("l_quantity", "l_tax"))


_RULE = """, folds AS (SELECT * FROM range(1, 6) t(f)),
  counts AS (SELECT f, l_linestatus, l_linenumber, label, count(*) AS n FROM v_pred, folds WHERE fold <> f GROUP BY ALL),
  rule AS (SELECT f, l_linestatus, l_linenumber, label AS guess FROM counts
    QUALIFY row_number() OVER (PARTITION BY f, l_linestatus, l_linenumber ORDER BY n DESC, label) = 1),
  s AS (SELECT CASE WHEN f = v.fold THEN 'val' ELSE 'train' END AS split, CAST(f AS INTEGER) AS fold, label, guess AS pred
    FROM v_pred v JOIN rule USING (l_linestatus, l_linenumber))"""


@query(
    "M8",
    _RULE
    + _KAPPA_CTES.format(by="split, fold", src="s", f1=_F1)
    + """ SELECT split, fold, round(po, 9) AS accuracy, round(f1, 9) AS f1,
      round((po - s / (n::DOUBLE * n)) / (1 - s / (n::DOUBLE * n)), 9) AS kappa FROM n JOIN e USING (split, fold)""",
    ("v_pred",),
)
def cross_validate_rule(spark, sf):
    df = X.v_pred(spark, sf).drop("pred", "score")
    fit = K.majority_rule(["l_linestatus", "l_linenumber"])
    return rounded(K.cross_validate(df, fit, 5, train_scores=True), 9)


@query(
    "M8",
    """, folds AS (SELECT * FROM range(1, 6) t(f)),
      top AS (SELECT f, label AS guess FROM (SELECT f, label, count(*) AS n FROM v_pred, folds WHERE fold <> f GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, label) = 1),
      s AS (SELECT f, avg(CAST(label = guess AS INTEGER)) AS acc,
        coalesce(2.0 * count(*) FILTER (label = 0 AND guess = 0) / nullif(count(*) FILTER (label = 0) + count(*) FILTER (guess = 0), 0), 0) AS f1
        FROM v_pred JOIN top ON fold = f GROUP BY f)
    SELECT 'val' AS split, round(avg(acc), 9) AS accuracy_mean, round(avg(f1), 9) AS f1_mean, CAST(0 AS DOUBLE) AS kappa_mean, count(*) AS folds FROM s""",
    ("v_pred",),
)
def cross_validate_constant(spark, sf):
    """The constant predictor: its kappa is 0 in every fold."""
    df = X.v_pred(spark, sf).drop("pred", "score")
    return rounded(K.cv_means(K.cross_validate(df, K.majority_rule([]), 5)), 9)


@query("M13", "SELECT CAST(vec_id % 6 AS INTEGER) AS cluster, label, count(*) AS n FROM embeddings GROUP BY ALL")
def contingency(spark, sf):
    df = X.table(spark, sf, "embeddings").select((F.col("vec_id") % 6).cast("int").alias("cluster"), "label")
    return M.contingency(df)


@query(
    "M13",
    """WITH c AS (SELECT CAST(vec_id % 6 AS INTEGER) AS cluster, label, count(*) AS n FROM embeddings GROUP BY ALL)
    SELECT cluster, CAST(sum(n) OVER w AS BIGINT) AS size, label AS majority, round(n / sum(n) OVER w, 9) AS purity FROM c
    WINDOW w AS (PARTITION BY cluster) QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) = 1""",
)
def purity(spark, sf):
    df = X.table(spark, sf, "embeddings").select((F.col("vec_id") % 6).cast("int").alias("cluster"), "label")
    return rounded(M.purity(df), 9)
