"""Join queries: trees of runs, as-of, overlap, environments, layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import joins as J
from harrow.plans import fixtures as X
from harrow.plans.registry import query, rounded


@query(
    "J1",
    "SELECT c_custkey AS run, n_name AS experiment, CAST(c_nationkey AS INTEGER) AS experiment_id FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def with_experiment(spark, sf):
    runs = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("run"), F.col("c_nationkey").alias("experiment_id"))
    exps = X.table(spark, sf, "nation").select(F.col("n_nationkey").alias("experiment_id"), F.col("n_name").alias("experiment"))
    return J.with_experiment(runs, exps)


@query(
    "J2",
    """SELECT o_orderkey AS run, o_custkey AS parent, c_mktsegment AS parent_segment, c_acctbal AS parent_balance
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def with_parent(spark, sf):
    children = X.table(spark, sf, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_custkey").alias("parent"))
    parents = X.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("parent"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    return J.with_parent(children, parents)


@query(
    "J3",
    """SELECT run, A, N, R, priority, status FROM (
      SELECT l_orderkey AS run, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS A,
        max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS N, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS R
      FROM lineitem GROUP BY 1) m JOIN (SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status FROM orders) p ON run = o_orderkey""",
)
def trials(spark, sf):
    metrics = X.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("key"), F.col("l_quantity").alias("value")
    )
    params = X.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
    )
    return J.trials(metrics, params.unpivot("run", ["priority", "status"], "key", "value"), ["A", "N", "R"], ["priority", "status"])


@query("J4", "SELECT o_orderkey AS run FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def aborted(spark, sf):
    runs = X.table(spark, sf, "orders").select(F.col("o_orderkey").alias("run"))
    return J.aborted(runs, X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run")))


@query("J5", "SELECT c_custkey AS run, c_name AS name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def searches(spark, sf):
    runs = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("run"), F.col("c_name").alias("name"))
    return J.searches(runs, X.table(spark, sf, "orders").select(F.col("o_custkey").alias("parent")))


@query(
    "J6",
    """WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t, value FROM events)
    SELECT l.user_id, l.event_id, l.t, r.t AS right_t, r.event_id AS right_event_id, r.value AS right_value
    FROM (SELECT * FROM e WHERE event_type = 'purchase') l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'click') r
      ON l.user_id = r.user_id AND l.t >= r.t""",
)
def asof_join(spark, sf):
    e = X.table(spark, sf, "events").withColumn("t", X.epoch(F.col("ts"), "MICROSECOND"))
    left = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", "t")
    right = e.where(F.col("event_type") == "click").select("user_id", "event_id", "t", "value")
    return J.asof_join(left, right, "t", ["user_id"], ["event_id", "value"])


@query(
    "J7",
    """SELECT a.search, a.run, count(*) AS others FROM v_runs a JOIN v_runs b
      ON a.search = b.search AND a.run <> b.run AND a.start_time < b.end_time AND b.start_time < a.end_time GROUP BY 1, 2""",
    ("v_runs",),
)
def overlaps(spark, sf):
    return J.overlaps(X.v_runs(spark, sf))


@query(
    "W10",
    """SELECT t, change, CAST(sum(change) OVER (ORDER BY t) AS BIGINT) AS depth FROM (
      SELECT t, CAST(sum(d) AS BIGINT) AS change FROM (SELECT start_time AS t, 1 AS d FROM v_runs UNION ALL SELECT end_time, -1 FROM v_runs) GROUP BY t)""",
    ("v_runs",),
)
def concurrency(spark, sf):
    return J.concurrency(X.v_runs(spark, sf))


@query(
    "W10",
    """SELECT script, t, change, CAST(sum(change) OVER (PARTITION BY script ORDER BY t) AS BIGINT) AS depth FROM (
      SELECT script, t, CAST(sum(d) AS BIGINT) AS change FROM (SELECT script, start_time AS t, 1 AS d FROM v_runs
        UNION ALL SELECT script, end_time, -1 FROM v_runs) GROUP BY script, t)""",
    ("v_runs",),
)
def concurrency_per_script(spark, sf):
    return J.concurrency(X.v_runs(spark, sf), ["script"])


_SIDE = "SELECT package, max(op || version) AS pin FROM v_pins WHERE model = '{}' GROUP BY 1"


@query(
    "J8",
    f"""SELECT coalesce(x.package, y.package) AS package, x.pin AS a, y.pin AS b
    FROM ({_SIDE.format("family1")}) x FULL JOIN ({_SIDE.format("family2")}) y ON x.package = y.package
    WHERE x.pin IS DISTINCT FROM y.pin""",
    ("v_pins",),
)
def env_diff(spark, sf):
    return J.env_diff(X.v_pins(spark, sf), "family1", "family2")


@query("J9", "SELECT o_orderkey AS run, CAST(f AS INTEGER) AS fold FROM orders CROSS JOIN range(1, 6) t(f)")
def cv_grid(spark, sf):
    return J.cv_grid(X.table(spark, sf, "orders").select(F.col("o_orderkey").alias("run")), 5)


@query("J10", "SELECT d.doc_id AS sample, CAST(n_chars % 2 AS INTEGER) AS pred, quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def score_join(spark, sf):
    pred = X.table(spark, sf, "documents").select(F.col("doc_id").alias("sample"), (F.col("n_chars") % 2).cast("int").alias("pred"))
    truth = X.table(spark, sf, "labels").select(F.col("doc_id").alias("sample"), F.col("quality").alias("label"))
    return J.score_join(pred, truth)


_DRIFT = "SELECT l_orderkey AS search, l_returnflag AS key, {} AS value FROM lineitem WHERE {} GROUP BY 1, 2"


@query(
    "J11",
    f"""SELECT coalesce(p.search, c.search) AS search, coalesce(p.key, c.key) AS key, p.value AS recorded, c.value AS best
    FROM ({_DRIFT.format("max(l_linestatus)", "l_discount > 0.02")}) p FULL JOIN ({_DRIFT.format("min(l_linestatus)", "l_tax > 0.01")}) c
      ON p.search = c.search AND p.key = c.key WHERE p.value IS DISTINCT FROM c.value""",
)
def param_drift(spark, sf):
    li = X.table(spark, sf, "lineitem")
    keyed = [F.col("l_orderkey").alias("search"), F.col("l_returnflag").alias("key"), F.col("l_linestatus").alias("value")]
    recorded, best = li.where(F.col("l_discount") > 0.02).select(*keyed), li.where(F.col("l_tax") > 0.01).select(*keyed)
    tasks = J.tasks_for(recorded, best)
    return J.param_drift(J.key_values(recorded, "max", tasks), J.key_values(best, "min", tasks))


@query(
    "J14",
    """SELECT o.patch, o.name, o.crs, b.crs AS base_crs FROM v_layers o LEFT JOIN v_layers b ON b.patch = o.patch AND b.name = 'BUILDING'
    WHERE o.name <> 'BUILDING' AND (o.crs IS NULL OR o.crs IS DISTINCT FROM b.crs)""",
    ("v_layers",),
)
def crs_mismatch(spark, sf):
    return J.crs_mismatch(X.v_layers(spark, sf), "patch", "BUILDING")


@query(
    "J15",
    """SELECT model, run, expected FROM (SELECT DISTINCT model, run, CASE model WHEN 'family0' THEN 'Brand#1' WHEN 'family1' THEN 'Brand#2'
        WHEN 'family2' THEN 'Brand#3' END AS expected FROM v_pins) s WHERE expected IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM v_pins p WHERE p.model = s.model AND p.run = s.run AND p.package = s.expected)""",
    ("v_pins",),
)
def model_mismatch(spark, sf):
    rules = spark.createDataFrame(
        [("family0", "Brand#1"), ("family1", "Brand#2"), ("family2", "Brand#3")], "model string, expected string"
    )
    return J.model_mismatch(X.v_pins(spark, sf), rules)


@query(
    "A23",
    """, env AS (SELECT model, run, string_agg(DISTINCT package || op || version, ',' ORDER BY package || op || version) AS e FROM v_pins GROUP BY 1, 2),
      used AS (SELECT model, package || op || version AS pin, count(DISTINCT run) AS n FROM v_pins GROUP BY 1, 2),
      top AS (SELECT * FROM used QUALIFY row_number() OVER (PARTITION BY model ORDER BY n DESC, pin) = 1)
    SELECT g.model, environments, runs, pin AS common_pin, n AS common_runs
    FROM (SELECT model, count(DISTINCT e) AS environments, count(*) AS runs FROM env GROUP BY 1) g JOIN top ON g.model = top.model""",
    ("v_pins",),
)
def env_census(spark, sf):
    return J.env_census(X.v_pins(spark, sf))
