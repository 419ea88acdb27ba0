"""All registered queries, and the flagship report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators import runs as R
from harrow.plans import fixtures as X
from harrow.plans import (  # noqa: F401  (importing registers the queries)
    join_queries,
    model_queries,
    pixel_queries,
    run_queries,
    score_queries,
    series_queries,
    source_queries,
)
from harrow.plans.registry import OPERATORS, ORACLES, QUERIES, query, rounded

__all__ = ["OPERATORS", "ORACLES", "QUERIES", "flagship"]


@query(
    "P8 A1 W3 T1",
    """, k AS (SELECT run, 'Validation ' || CASE WHEN key IN ('view', 'click') THEN 'accuracy' ELSE 'kappa' END AS m, value FROM v_kv),
      a AS (SELECT run, CASE m WHEN 'Validation accuracy' THEN 'accuracy' ELSE 'kappa' END AS metric, avg(value) AS mean, count(*) AS folds FROM k GROUP BY ALL),
      r AS (SELECT *, rank() OVER (PARTITION BY metric ORDER BY mean DESC) AS rank FROM a)
    SELECT run, 'val' AS split, metric, round(mean, 6) AS mean, folds, rank FROM r ORDER BY mean DESC, metric, run LIMIT 20""",
    ("v_kv",),
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Read split and metric from the keys, average over folds, rank the runs per metric, list the best 20."""
    metric = F.when(F.col("key").isin("view", "click"), "accuracy").otherwise("kappa")
    key = F.concat(F.lit("Validation "), metric, F.lit(" in fold "), F.col("fold"))
    logs = X.v_kv(spark, sf).select("run", key.alias("key"), "value")
    means = R.fold_mean(R.decode_keys(logs))
    ranked = R.rank_trials(means.withColumn("objective", F.col("mean")), ["split", "metric"])
    top = ranked.orderBy(F.desc("mean"), "metric", "run").limit(20)
    return rounded(top.select("run", "split", "metric", "mean", "folds", "rank"))
