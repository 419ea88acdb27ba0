"""Run-log queries: typed views, fold and search aggregates, ranks, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import values as V
from harrow.operators import runs as R
from harrow.plans import fixtures as X
from harrow.plans.registry import query, rounded

# ---------------------------------------------------------------- P4 .. P14


@query(
    "P4",
    """SELECT run, key, value,
      CASE WHEN value = 'None' THEN 'null' WHEN value IN ('True', 'False') THEN 'bool'
           WHEN regexp_matches(value, '^[0-9]+$') THEN 'int'
           WHEN regexp_matches(value, '^[0-9]+[.][0-9]*$') THEN 'double' ELSE 'text' END AS type,
      TRY_CAST(CASE WHEN regexp_matches(value, '^[0-9]+$') THEN value END AS BIGINT) AS as_int,
      TRY_CAST(value AS DOUBLE) AS as_double,
      CASE value WHEN 'True' THEN true WHEN 'False' THEN false END AS as_bool,
      CASE WHEN key = 'kernel' OR value = 'balanced' THEN value END AS as_text
    FROM v_params""",
    ("v_params",),
)
def typed_params(spark, sf):
    return R.typed_params(X.v_params(spark, sf)).drop("script")


@query(
    "P5",
    """SELECT run, regexp_extract(t, '''C'': ([0-9.]+)', 1) AS c, regexp_extract(t, '''kernel'': ''([A-Z])''', 1) AS kernel,
      CASE WHEN t LIKE '%''class_weight'': None%' THEN NULL ELSE 'balanced' END AS class_weight,
      regexp_extract(t, '''probability'': (True|False)', 1) AS probability, CAST(4 AS INTEGER) AS n_keys
    FROM (SELECT l_orderkey AS run, '{''C'': ' || CAST(l_quantity AS VARCHAR) || ', ''kernel'': ''' || l_returnflag ||
      ''', ''class_weight'': ' || CASE WHEN l_discount = 0 THEN 'None' ELSE '''balanced''' END || ', ''probability'': ' ||
      CASE WHEN l_tax > 0 THEN 'True' ELSE 'False' END || '}' AS t FROM lineitem)""",
)
def parse_dict_param(spark, sf):
    text = F.format_string(
        "{'C': %s, 'kernel': '%s', 'class_weight': %s, 'probability': %s}",
        F.col("l_quantity").cast("string"),
        F.col("l_returnflag"),
        F.when(F.col("l_discount") == 0, "None").otherwise("'balanced'"),
        F.when(F.col("l_tax") > 0, "True").otherwise("False"),
    )
    m = X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run"), V.parse_dict(text).alias("m"))
    return m.select(
        "run",
        F.col("m")["C"].alias("c"),
        F.col("m")["kernel"].alias("kernel"),
        F.col("m")["class_weight"].alias("class_weight"),
        F.col("m")["probability"].alias("probability"),
        F.size("m").alias("n_keys"),
    )


@query(
    "P6",
    """SELECT run, CAST(len(a) AS INTEGER) AS layers, a[1] AS first_layer, CAST(list_sum(a) AS BIGINT) AS units FROM (
      SELECT l_orderkey AS run, list_transform(regexp_extract_all(t, '([0-9]+)', 1), lambda x: CAST(x AS INTEGER)) AS a FROM (
        SELECT l_orderkey, CASE l_linenumber % 3 WHEN 0 THEN CAST(l_partkey AS VARCHAR)
          WHEN 1 THEN '(' || CAST(l_partkey AS VARCHAR) || ',)'
          ELSE '(' || CAST(l_partkey AS VARCHAR) || ', ' || CAST(l_suppkey AS VARCHAR) || ')' END AS t FROM lineitem))""",
)
def parse_layers(spark, sf):
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    text = (
        F.when(F.col("l_linenumber") % 3 == 0, part)
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("("), part, F.lit(",)")))
        .otherwise(F.concat(F.lit("("), part, F.lit(", "), supp, F.lit(")")))
    )
    a = X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run"), V.parse_layers(text).alias("a"))
    return a.select(
        "run",
        F.size("a").alias("layers"),
        F.element_at("a", 1).alias("first_layer"),
        F.aggregate("a", F.lit(0).cast("long"), lambda s, x: s + x).alias("units"),
    )


@query(
    "P7",
    """SELECT run, strftime(make_timestamp(start_time * 1000), '%Y-%m-%d %H:%M:%S') AS started,
      strftime(make_timestamp(end_time * 1000), '%Y-%m-%d %H:%M:%S') AS ended, (end_time - start_time) / 1000.0 AS seconds FROM v_runs""",
    ("v_runs",),
)
def run_times(spark, sf):
    df = R.with_times(X.v_runs(spark, sf))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("run", text("started"), text("ended"), "seconds")


_KEY_SQL = """SELECT event_id AS run, CASE event_type
      WHEN 'view' THEN side || ' accuracy in fold ' || f WHEN 'click' THEN side || ' kappa in fold ' || f
      WHEN 'signup' THEN side || ' F1 score of class ' || c || ' in fold ' || f
      WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'val_accuracy_mean' ELSE 'train_scores_mean' END
      ELSE CASE WHEN event_id % 2 = 0 THEN 'best_val_f1' ELSE 'Optimal threshold' END END AS key
    FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'Validation' ELSE 'Training' END AS side,
      CAST(event_id % 5 + 1 AS VARCHAR) AS f, CAST(user_id % 4 AS VARCHAR) AS c FROM events)"""


@query(
    "P8",
    f"""WITH k AS ({_KEY_SQL}),
    r AS (SELECT *, regexp_extract(key, '^(Training|Validation) ', 1) AS side,
        regexp_extract(key, 'class ([0-9]+) in', 1) AS c, regexp_extract(key, 'in fold ([0-9]+)$', 1) AS f FROM k)
    SELECT run, key,
      CASE WHEN side = 'Training' OR key LIKE '%train%' THEN 'train' WHEN side = 'Validation' OR key LIKE '%val%' THEN 'val' END AS split,
      CASE WHEN c <> '' THEN 'f1' WHEN key LIKE '%accuracy%' THEN 'accuracy' WHEN key LIKE '%kappa%' THEN 'kappa'
        WHEN key = 'train_scores_mean' THEN 'scores' WHEN key = 'best_val_f1' THEN 'f1' ELSE 'threshold' END AS metric,
      TRY_CAST(c AS INTEGER) AS cls, TRY_CAST(f AS INTEGER) AS fold,
      CASE WHEN key LIKE 'best%' THEN 'best' WHEN key LIKE '%mean' THEN 'mean' WHEN key LIKE 'Opt%' THEN 'threshold' END AS summary
    FROM r""",
)
def decode_metric_key(spark, sf):
    side = F.when(F.col("event_id") % 2 == 0, "Validation").otherwise("Training")
    fold = F.concat(F.lit(" in fold "), F.col("event_id") % 5 + 1)
    even = F.col("event_id") % 2 == 0
    kind = F.col("event_type")
    key = (
        F.when(kind == "view", F.concat(side, F.lit(" accuracy"), fold))
        .when(kind == "click", F.concat(side, F.lit(" kappa"), fold))
        .when(kind == "signup", F.concat(side, F.lit(" F1 score of class "), F.col("user_id") % 4, fold))
        .when(kind == "purchase", F.when(even, "val_accuracy_mean").otherwise("train_scores_mean"))
        .otherwise(F.when(even, "best_val_f1").otherwise("Optimal threshold"))
    )
    return R.decode_keys(X.table(spark, sf, "events").select(F.col("event_id").alias("run"), key.alias("key")))


@query(
    "P9",
    """SELECT run, status, source_type, CASE status WHEN 3 THEN 'FINISHED' WHEN 4 THEN 'FAILED' WHEN 1 THEN 'RUNNING' END AS status_name,
      CASE source_type WHEN 1 THEN 'NOTEBOOK' WHEN 2 THEN 'JOB' WHEN 3 THEN 'PROJECT' WHEN 4 THEN 'LOCAL' WHEN 5 THEN 'UNKNOWN' END AS source_name
    FROM v_runs""",
    ("v_runs",),
)
def decode_status(spark, sf):
    return R.decode_status(X.v_runs(spark, sf)).select("run", "status", "source_type", "status_name", "source_name")


@query(
    "P10",
    """SELECT 'mlflow-artifacts:/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '/artifacts' AS uri,
      CAST(o_custkey AS VARCHAR) AS experiment_id, CAST(o_orderkey AS VARCHAR) AS run_id FROM orders""",
)
def artifact_uris(spark, sf):
    uri = V.artifact_uri(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    df = X.table(spark, sf, "orders").select(uri.alias("uri"))
    return df.select("uri", V.split_artifact_uri(F.col("uri")).alias("s")).select("uri", "s.*")


@query(
    "P11",
    """SELECT run, n_params, md5(CAST(n_params AS VARCHAR) || ':' || CAST(q0 AS VARCHAR) || ':' || CAST(q1 AS VARCHAR) || ':' ||
        CAST(q2 AS VARCHAR) || ':' || CAST(q3 AS VARCHAR)) AS fp FROM (
      SELECT run, count(*) AS n_params, sum(('0x' || substr(h, 1, 8))::BIGINT) AS q0, sum(('0x' || substr(h, 9, 8))::BIGINT) AS q1,
        sum(('0x' || substr(h, 17, 8))::BIGINT) AS q2, sum(('0x' || substr(h, 25, 8))::BIGINT) AS q3
      FROM (SELECT DISTINCT run, md5(CAST(length(key) AS VARCHAR) || ':' || key || coalesce('=' || value, '!')) AS h FROM v_params) GROUP BY run)""",
    ("v_params",),
)
def param_fingerprint(spark, sf):
    return R.param_fingerprint(X.v_params(spark, sf))


@query(
    "P12",
    """SELECT run, script, CASE key WHEN 'C' THEN 'cost' WHEN 'max_depth' THEN 'depth' ELSE key END AS key, count(*) AS n
    FROM v_params GROUP BY ALL""",
    ("v_params",),
)
def alias_keys(spark, sf):
    aliases = spark.createDataFrame([("C", "cost"), ("max_depth", "depth")], "key string, repaired string")
    fixed = R.alias_keys(X.v_params(spark, sf), aliases)
    return fixed.groupBy("run", "script", "key").agg(F.count("*").alias("n"))


@query(
    "P13",
    """SELECT t.run, t.objective FROM v_trials t JOIN v_runs r ON t.run = r.run
    WHERE r.status = 3 AND t.script = '1-URGENT' AND t.objective >= 200000""",
    ("v_trials", "v_runs"),
)
def filter_runs(spark, sf):
    done = R.finished(X.v_runs(spark, sf)).select("run")
    ok = R.at_least(R.of_script(X.v_trials(spark, sf), "1-URGENT"), 200000.0)
    return ok.join(done, "run", "left_semi").select("run", "objective")


@query(
    "P13",
    """SELECT DISTINCT run FROM v_params p WHERE script = 'O'
    AND EXISTS (SELECT 1 FROM v_params q WHERE q.run = p.run AND q.key = 'class_weight' AND q.value = 'None')""",
    ("v_params",),
)
def runs_with_metric(spark, sf):
    """Runs of one experiment that log a key."""
    rows = X.v_params(spark, sf).withColumnRenamed("script", "experiment_id")
    runs = R.of_experiment(rows, "O").select("run").distinct()
    return R.with_metric(runs, rows.where(F.col("value") == "None"), "class_weight")


@query("P14", "SELECT doc_id AS run, md5(text) AS note FROM documents WHERE contains(lower(text), 'data')")
def search_notes(spark, sf):
    tags = X.table(spark, sf, "documents").select(
        F.col("doc_id").alias("run"), F.lit("mlflow.note.content").alias("key"), F.col("text").alias("value")
    )
    return R.search_notes(tags, "Data").select("run", F.md5("value").alias("note"))


# ---------------------------------------------------------------- A1 .. A17


@query("A1", "SELECT run, key, round(avg(value), 6) AS mean, count(value) AS folds FROM v_kv GROUP BY ALL", ("v_kv",))
def fold_mean(spark, sf):
    return rounded(R.fold_mean(X.v_kv(spark, sf), ["run", "key"]))


@query(
    "A2",
    """SELECT run, key, round(stddev_samp(value), 6) AS std, min(value) AS low, max(value) AS high,
      round(max(value) - min(value), 6) AS range FROM v_kv GROUP BY ALL""",
    ("v_kv",),
)
def fold_spread(spark, sf):
    return rounded(R.fold_spread(X.v_kv(spark, sf), ["run", "key"]))


@query(
    "A3",
    """SELECT search, run, ts, objective, script FROM v_trials
    QUALIFY row_number() OVER (PARTITION BY search ORDER BY objective DESC, ts, run) = 1""",
    ("v_trials",),
)
def best_trial(spark, sf):
    return R.best_trial(X.v_trials(spark, sf), keep=["script"])


@query(
    "A4",
    """SELECT search, max(objective) AS best, min(objective) AS worst, round(avg(objective), 7) AS mean, count(*) AS trials,
      min(ts) AS first_ts, max(ts) AS last_ts FROM v_trials GROUP BY search""",
    ("v_trials",),
)
def search_summary(spark, sf):
    return rounded(R.search_summary(X.v_trials(spark, sf)), 7)


_EVENTS = ["click", "error", "purchase", "signup", "view"]


@query(
    "A5",
    "SELECT run, "
    + ", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in _EVENTS)
    + " FROM v_kv GROUP BY run",
    ("v_kv",),
)
def long_to_wide(spark, sf):
    return R.wide(X.v_kv(spark, sf), _EVENTS)


@query(
    "A6",
    "\nUNION ALL\n".join(
        f"SELECT l_orderkey AS run, '{k}' AS key, {c} AS value FROM lineitem"
        for k, c in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("tax", "l_tax"))
    ),
)
def wide_to_long(spark, sf):
    li = X.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("tax"),
    )
    return R.long(li, ["quantity", "price", "tax"])


@query(
    "A11",
    """SELECT experiment, script, CAST(GROUPING(experiment, script) AS INTEGER) AS level, max(objective) AS best,
      round(avg(objective), 4) AS mean, count(objective) AS trials FROM v_trials GROUP BY ROLLUP (experiment, script)""",
    ("v_trials",),
)
def leaderboard(spark, sf):
    return rounded(R.leaderboard(X.v_trials(spark, sf)), 4)


@query(
    "A12",
    """SELECT script, key, count(x) AS n, count(DISTINCT x) AS "distinct", min(x) AS low, max(x) AS high,
      round(quantile_cont(x, 0.5), 6) AS median
    FROM (SELECT script, key, TRY_CAST(value AS DOUBLE) AS x FROM v_params) WHERE x IS NOT NULL GROUP BY script, key""",
    ("v_params",),
)
def param_profile(spark, sf):
    return rounded(R.param_profile(X.v_params(spark, sf)))


@query(
    "A12",
    """SELECT script, key, value, count(*) AS n FROM v_params WHERE TRY_CAST(value AS DOUBLE) IS NULL GROUP BY ALL""",
    ("v_params",),
)
def enum_profile(spark, sf):
    return R.enum_profile(X.v_params(spark, sf))


def _effects(spark, sf):
    pairs = F.array(
        F.struct(F.lit("quantity").alias("key"), F.col("l_quantity").alias("x")),
        F.struct(F.lit("discount").alias("key"), F.col("l_discount").alias("x")),
    )
    li = X.table(spark, sf, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("script"), F.explode(pairs).alias("p"), F.col("l_extendedprice").alias("objective")
    ).select("script", "p.*", "objective")


@query(
    "A13",
    """WITH e AS (SELECT l_returnflag AS script, 'quantity' AS key, l_quantity AS x, l_extendedprice AS objective FROM lineitem
        UNION ALL SELECT l_returnflag, 'discount', l_discount, l_extendedprice FROM lineitem),
      n AS (SELECT *, row_number() OVER (PARTITION BY script, key ORDER BY x) AS a,
        row_number() OVER (PARTITION BY script, key ORDER BY objective) AS b FROM e),
      r AS (SELECT *, avg(a) OVER (PARTITION BY script, key, x) AS rx, avg(b) OVER (PARTITION BY script, key, objective) AS ry FROM n)
    SELECT script, key, round(corr(x, objective), 6) AS pearson, round(corr(rx, ry), 6) AS spearman, count(*) AS n
    FROM r GROUP BY script, key""",
)
def param_effect(spark, sf):
    return rounded(R.param_effect(_effects(spark, sf)))


@query(
    "A13",
    """SELECT script, 'status' AS key, experiment AS value, round(avg(objective), 4) AS mean, max(objective) AS best, count(*) AS n
    FROM v_trials GROUP BY script, experiment""",
    ("v_trials",),
)
def enum_effect(spark, sf):
    t = X.v_trials(spark, sf).select("script", F.lit("status").alias("key"), F.col("experiment").alias("value"), "objective")
    return rounded(R.enum_effect(t), 4)


@query(
    "A14",
    "SELECT run, key, count(DISTINCT fold) AS folds FROM v_kv GROUP BY run, key HAVING count(DISTINCT fold) <> 5",
    ("v_kv",),
)
def incomplete_cv(spark, sf):
    return R.incomplete_cv(X.v_kv(spark, sf), by=["run", "key"])


@query(
    "A14",
    """SELECT run, 'val' AS split, 'kappa' AS metric, count(DISTINCT fold) AS folds, CAST(CASE WHEN run % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS has_mean
    FROM v_kv GROUP BY run HAVING count(DISTINCT fold) <> 5 OR run % 2 <> 0
    UNION ALL SELECT DISTINCT run, 'val', 'accuracy', 0, 1 FROM v_kv WHERE run % 3 = 0""",
    ("v_kv",),
)
def folds_without_mean(spark, sf):
    """Every event is a fold value of kappa; even runs log its mean, and each third run a mean accuracy without folds."""
    kv = X.v_kv(spark, sf)
    folds = kv.select("run", F.concat(F.lit("Validation kappa in fold "), "fold").alias("key"), "value")
    means = kv.groupBy("run").agg(F.avg("value").alias("value"))
    kappa = means.where(F.col("run") % 2 == 0).withColumn("key", F.lit("val_kappa_mean"))
    accuracy = means.where(F.col("run") % 3 == 0).withColumn("key", F.lit("val_accuracy_mean"))
    return R.folds_without_mean(folds.unionByName(kappa).unionByName(accuracy))


@query(
    "A15",
    """SELECT key, count(DISTINCT run) AS runs, count(DISTINCT run) = 1 AS only_once FROM (
      SELECT CAST(l_partkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS key, l_orderkey AS run FROM lineitem) GROUP BY key""",
)
def key_census(spark, sf):
    key = F.concat_ws("/", F.col("l_partkey"), F.col("l_linenumber"))
    return R.key_census(X.table(spark, sf, "lineitem").select(key.alias("key"), F.col("l_orderkey").alias("run")))


_FINGERPRINTED = """, p AS (SELECT run, md5(CAST(count(*) AS VARCHAR) || ':' || CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS VARCHAR) || ':' ||
        CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS VARCHAR) || ':' || CAST(sum(('0x' || substr(h, 17, 8))::BIGINT) AS VARCHAR) || ':' ||
        CAST(sum(('0x' || substr(h, 25, 8))::BIGINT) AS VARCHAR)) AS fp
      FROM (SELECT DISTINCT run, md5(CAST(length(key) AS VARCHAR) || ':' || key || coalesce('=' || value, '!')) AS h FROM v_params
        WHERE key IN ('kernel', 'class_weight')) GROUP BY run),
      t AS (SELECT v.*, p.fp FROM v_trials v JOIN p ON p.run = v.run)"""


def _fingerprinted(spark, sf):
    """Trials with the fingerprint of their enumerated parameters; many trials share one."""
    chosen = X.v_params(spark, sf).where(F.col("key").isin("kernel", "class_weight"))
    return X.v_trials(spark, sf).join(R.param_fingerprint(chosen).select("run", "fp"), "run")


@query(
    "A16",
    _FINGERPRINTED
    + """ SELECT script, fp, count(*) AS runs, min(objective) AS low, max(objective) AS high, round(max(objective) - min(objective), 4) AS gap
    FROM t GROUP BY script, fp HAVING count(*) > 1 AND max(objective) > min(objective)""",
    ("v_trials", "v_params"),
)
def irreproducible(spark, sf):
    return rounded(R.irreproducible(_fingerprinted(spark, sf)), 4)


@query(
    "A17",
    """SELECT script, count(*) AS runs, min(s) AS shortest, max(s) AS longest, quantile_cont(s, 0.5) AS median
    FROM (SELECT script, (end_time - start_time) / 1000.0 AS s FROM v_runs) GROUP BY script""",
    ("v_runs",),
)
def durations(spark, sf):
    return R.durations(R.with_times(X.v_runs(spark, sf)))


# ---------------------------------------------------------------- W1 .. W4, W7


@query(
    "W1",
    "SELECT search, run, row_number() OVER (PARTITION BY search ORDER BY ts, run) AS trial FROM v_trials",
    ("v_trials",),
)
def trial_no(spark, sf):
    return R.trial_no(X.v_trials(spark, sf)).select("search", "run", "trial")


@query(
    "W2",
    """SELECT search, run, best, before IS NULL OR best > before AS improved FROM (
      SELECT search, run, max(objective) OVER w AS best,
        max(objective) OVER (PARTITION BY search ORDER BY ts, run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM v_trials WINDOW w AS (PARTITION BY search ORDER BY ts, run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    ("v_trials",),
)
def best_so_far(spark, sf):
    return R.best_so_far(X.v_trials(spark, sf)).select("search", "run", "best", "improved")


@query(
    "W3",
    """SELECT run, script, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 9) AS percent_rank
    FROM v_trials WINDOW w AS (PARTITION BY script ORDER BY objective DESC)""",
    ("v_trials",),
)
def rank_trials(spark, sf):
    r = R.rank_trials(X.v_trials(spark, sf), ["script"])
    return rounded(r.select("run", "script", "rank", "dense_rank", "percent_rank"), 9)


@query(
    "W4",
    """SELECT run, event_id, (ts - lag(ts) OVER (PARTITION BY run ORDER BY ts, event_id)) / 1000.0 AS seconds FROM v_kv""",
    ("v_kv",),
)
def fold_seconds(spark, sf):
    return R.fold_seconds(X.v_kv(spark, sf), tie=["event_id"]).select("run", "event_id", "seconds")


@query(
    "W7",
    """SELECT name, ts, run FROM (SELECT script || '/' || CAST(search AS VARCHAR) AS name, ts, run FROM v_trials)
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY ts DESC, run DESC) = 1""",
    ("v_trials",),
)
def latest_model(spark, sf):
    return R.latest_model(X.v_trials(spark, sf).withColumn("name", F.concat_ws("/", "script", F.col("search"))))


# ---------------------------------------------------------------- T1 .. T3


@query(
    "T1",
    "SELECT search, run, ts, objective FROM v_trials ORDER BY objective DESC, ts, run LIMIT 20",
    ("v_trials",),
)
def top_trials(spark, sf):
    return R.top_trials(X.v_trials(spark, sf).select("search", "run", "ts", "objective"), 20)


@query(
    "T2",
    """SELECT script, run, objective, place FROM (
      SELECT *, row_number() OVER (PARTITION BY script ORDER BY objective DESC, ts, run) AS place FROM v_trials) WHERE place <= 5""",
    ("v_trials",),
)
def top_per_script(spark, sf):
    return R.top_per(X.v_trials(spark, sf), ["script"], 5).select("script", "run", "objective", "place")


@query(
    "T3",
    """SELECT run, key, event_id, row_number() OVER w AS position,
      coalesce(fold >= lag(fold) OVER w, true) AS in_order FROM v_kv
    WINDOW w AS (PARTITION BY run, key ORDER BY ts, fold, event_id)""",
    ("v_kv",),
)
def fold_order(spark, sf):
    r = R.fold_order(X.v_kv(spark, sf), ["run", "key"], ["event_id"])
    return r.select("run", "key", "event_id", "position", "in_order")


# ---------------------------------------------------------------- U1 .. U4


@query(
    "U1",
    """SELECT run, objective, script, NULL AS seconds FROM v_trials
    UNION ALL SELECT run, NULL, script, (end_time - start_time) / 1000.0 FROM v_runs""",
    ("v_trials", "v_runs"),
)
def union_runs(spark, sf):
    a = X.v_trials(spark, sf).select("run", "objective", "script")
    b = R.with_times(X.v_runs(spark, sf)).select("run", "script", "seconds")
    return R.union_runs(a, b)


_PAIR_KEYS = "SELECT l_returnflag AS script, CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) AS key FROM lineitem"


@query(
    "U2",
    f"""SELECT key FROM ({_PAIR_KEYS}) WHERE script = 'A' INTERSECT SELECT key FROM ({_PAIR_KEYS}) WHERE script = 'N'""",
)
def shared_keys(spark, sf):
    key = F.concat_ws("/", F.col("l_partkey"), F.col("l_suppkey"))
    params = X.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("script"), key.alias("key"))
    return R.shared_keys(params, "A", "N")


@query(
    "U3",
    """SELECT package, op, version FROM v_pins WHERE model = 'family1'
    EXCEPT SELECT package, op, version FROM v_pins WHERE model = 'family2'""",
    ("v_pins",),
)
def only_in(spark, sf):
    return R.only_in(X.v_pins(spark, sf), "family1", "family2")


@query(
    "U4",
    _FINGERPRINTED
    + """ SELECT script, fp, tries, run, ts, objective FROM (
      SELECT script, fp, run, ts, objective, count(*) OVER (PARTITION BY script, fp) AS tries,
        row_number() OVER (PARTITION BY script, fp ORDER BY ts, run) AS rn FROM t) WHERE rn = 1""",
    ("v_trials", "v_params"),
)
def distinct_trials(spark, sf):
    return R.distinct_trials(_fingerprinted(spark, sf))
