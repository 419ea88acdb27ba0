"""The run-log, pixel and series shapes as views over the driver tables: DataFrame here, SQL in VIEWS."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def epoch(ts: Column, unit: str = "MILLISECOND") -> Column:
    """Zone-free timestamp -> epoch number, whatever the session time zone."""
    return F.timestamp_diff(unit, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def v_kv(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_type").alias("key"),
        (F.col("event_id") % 5 + 1).alias("fold"),
        "value",
        epoch(F.col("ts")).alias("ts"),
        "event_id",
    )


def v_trials(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("search"),
        F.col("o_orderkey").alias("run"),
        epoch(F.col("o_orderdate")).alias("ts"),
        F.col("o_totalprice").alias("objective"),
        F.col("o_orderpriority").alias("script"),
        F.col("o_orderstatus").alias("experiment"),
    )


def v_runs(spark, sf) -> DataFrame:
    start = epoch(F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("search"),
        F.col("o_orderkey").alias("run"),
        start.alias("start_time"),
        (start + (F.col("o_orderkey") % 40 + 1) * DAY_MS).alias("end_time"),
        F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "P", 4).otherwise(1).alias("status"),
        (F.col("o_orderkey") % 7).cast("int").alias("source_type"),
        F.col("o_orderpriority").alias("script"),
    )


def v_params(spark, sf) -> DataFrame:
    """Untyped params: an int, a float, an enum and an optional one per line."""
    li = table(spark, sf, "lineitem")
    pairs = F.array(
        F.struct(F.lit("max_depth").alias("key"), F.col("l_linenumber").cast("string").alias("value")),
        F.struct(F.lit("C").alias("key"), F.col("l_quantity").cast("string").alias("value")),
        F.struct(F.lit("kernel").alias("key"), F.col("l_returnflag").alias("value")),
        F.struct(
            F.lit("class_weight").alias("key"),
            F.when(F.col("l_discount") == 0, "None").when(F.col("l_tax") == 0, "True").otherwise("balanced").alias("value"),
        ),
    )
    return li.select(
        F.col("l_orderkey").alias("run"), F.col("l_linestatus").alias("script"), F.explode(pairs).alias("p")
    ).select("run", "script", "p.*")


def v_pred(spark, sf) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return (
        table(spark, sf, "lineitem")
        .withColumn("label", label)
        .select(
            (F.col("l_orderkey") % 5 + 1).cast("int").alias("fold"),
            "label",
            F.when(F.col("l_orderkey") % 4 < 3, F.col("label"))
            .otherwise((F.col("label") + 1 + F.col("l_linenumber") % 2) % 3)
            .alias("pred"),
            (F.col("l_quantity") / 100 + F.when(F.col("label") == 0, 0.5).otherwise(0.0)).alias("score"),
            "l_linestatus",
            "l_linenumber",
        )
    )


def v_graded(spark, sf) -> DataFrame:
    """Lines with four features of few values and four classes."""
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).when(F.col("l_linestatus") == "F", 2).otherwise(3)
    features = F.array(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_discount", "l_tax")])
    return table(spark, sf, "lineitem").select(features.alias("features"), label.alias("label"))


def v_pixels(spark, sf) -> DataFrame:
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int")
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("x"),
        (F.col("l_partkey") % 10).alias("y"),
        month.alias("period"),
        F.col("l_discount").alias("B04"),
        F.col("l_tax").alias("B03"),
        (F.col("l_quantity") / 500).alias("B02"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("dataMask"),
    )


def v_series(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("series"), epoch(F.col("ts"), "DAY").alias("t"))
        .agg(F.avg("value").alias("value"))
    )


def v_votes(spark, sf) -> DataFrame:
    """Three members, three classes: the whole embedding dealt out, averaged per member and class."""
    parts = table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample"), F.posexplode("embedding").alias("i", "e"))
    return parts.groupBy(
        "sample", F.concat(F.lit("m"), F.col("i") % 3).alias("member"), (F.floor(F.col("i") / 3) % 3).cast("int").alias("cls")
    ).agg(F.avg(F.col("e").cast("double")).alias("score"))


def v_points(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id",
        "label",
        F.element_at("embedding", 1).cast("double").alias("lon"),
        F.element_at("embedding", 2).cast("double").alias("lat"),
    )


def v_boxes(spark, sf) -> DataFrame:
    """Per label: half a standard deviation around the mean point."""

    def edge(c: str, sign: float) -> Column:
        return F.avg(c) + sign * F.stddev_samp(c) / 2

    return v_points(spark, sf).groupBy(F.col("label").alias("box")).agg(
        edge("lon", -1.0).alias("min_lon"),
        edge("lon", 1.0).alias("max_lon"),
        edge("lat", -1.0).alias("min_lat"),
        edge("lat", 1.0).alias("max_lat"),
    )


def v_cells(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(predicted, true) cells per year."""
    li = table(spark, sf, "lineitem").withColumn("variant", F.year("l_shipdate"))
    cells = lambda cond: li.where(cond).select(
        "variant", F.col("l_suppkey").alias("x"), (F.col("l_partkey") % 50).alias("y")
    )
    return cells(F.col("l_linestatus") == "O"), cells(F.col("l_returnflag") == "A")


def v_fields(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(predicted, true) cells per month, sparse enough for many regions."""
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int")
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", month.alias("variant"), F.col("l_suppkey").alias("x"), (F.col("l_partkey") % 50).alias("y"))
    cells = lambda cond: li.where(cond).select("variant", "x", "y")
    return cells(F.col("l_quantity") > 8), cells(F.col("l_discount") < 0.09)


def v_pins(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("family"), F.col("p_partkey") % 4).alias("model"),
        (F.floor(F.col("p_partkey") / 20)).alias("run"),
        F.col("p_brand").alias("package"),
        F.when(F.col("p_size") % 2 == 0, "==").otherwise("<=").alias("op"),
        F.concat(F.col("p_size"), F.lit(".0")).alias("version"),
    )


def v_layers(spark, sf) -> DataFrame:
    """One layer per (patch, name) with its coordinate system, missing on some."""
    name = F.when(F.max("c_acctbal") > 9000, F.lit(None)).when(F.count("*") % 2 == 0, "GCS_WGS_1984").otherwise("LOCAL")
    return (
        table(spark, sf, "customer")
        .groupBy(F.col("c_nationkey").alias("patch"), F.col("c_mktsegment").alias("name"))
        .agg(name.alias("crs"))
    )


def training_table(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


VIEWS = {
    "v_kv": "SELECT user_id AS run, event_type AS key, event_id % 5 + 1 AS fold, value, (epoch_us(ts) // 1000) AS ts, event_id FROM events",
    "v_trials": """SELECT o_custkey AS search, o_orderkey AS run, (epoch_us(o_orderdate) // 1000) AS ts, o_totalprice AS objective,
        o_orderpriority AS script, o_orderstatus AS experiment FROM orders""",
    "v_runs": """SELECT o_custkey AS search, o_orderkey AS run, (epoch_us(o_orderdate) // 1000) AS start_time,
        (epoch_us(o_orderdate) // 1000) + (o_orderkey % 40 + 1) * 86400000 AS end_time,
        CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 4 ELSE 1 END AS status,
        CAST(o_orderkey % 7 AS INTEGER) AS source_type, o_orderpriority AS script FROM orders""",
    "v_params": """SELECT l_orderkey AS run, l_linestatus AS script, 'max_depth' AS key, CAST(l_linenumber AS VARCHAR) AS value FROM lineitem
        UNION ALL SELECT l_orderkey, l_linestatus, 'C', CAST(l_quantity AS VARCHAR) FROM lineitem
        UNION ALL SELECT l_orderkey, l_linestatus, 'kernel', l_returnflag FROM lineitem
        UNION ALL SELECT l_orderkey, l_linestatus, 'class_weight',
          CASE WHEN l_discount = 0 THEN 'None' WHEN l_tax = 0 THEN 'True' ELSE 'balanced' END FROM lineitem""",
    "v_pred": """SELECT CAST(l_orderkey % 5 + 1 AS INTEGER) AS fold, label,
        CASE WHEN l_orderkey % 4 < 3 THEN label ELSE (label + 1 + l_linenumber % 2) % 3 END AS pred,
        l_quantity / 100 + CASE WHEN label = 0 THEN 0.5 ELSE 0.0 END AS score, l_linestatus, l_linenumber
        FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM lineitem)""",
    "v_graded": """SELECT [CAST(l_linenumber AS DOUBLE), CAST(l_quantity AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)] AS features,
        CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN 1 WHEN l_linestatus = 'F' THEN 2 ELSE 3 END AS label FROM lineitem""",
    "v_pixels": """SELECT l_suppkey % 10 AS x, l_partkey % 10 AS y,
        CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS period, l_discount AS B04, l_tax AS B03,
        l_quantity / 500 AS B02, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS dataMask FROM lineitem""",
    "v_series": """SELECT user_id AS series, CAST((epoch_us(ts) // 1000) // 86400000 AS BIGINT) AS t, avg(value) AS value
        FROM events GROUP BY 1, 2""",
    "v_votes": """SELECT sample, 'm' || CAST((i - 1) % 3 AS VARCHAR) AS member, CAST(((i - 1) // 3) % 3 AS INTEGER) AS cls,
        avg(CAST(e AS DOUBLE)) AS score
        FROM (SELECT vec_id AS sample, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY 1, 2, 3""",
    "v_points": """SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS lon, CAST(embedding[2] AS DOUBLE) AS lat FROM embeddings""",
    "v_boxes": """SELECT label AS box, avg(lon) - stddev_samp(lon) / 2 AS min_lon, avg(lon) + stddev_samp(lon) / 2 AS max_lon,
        avg(lat) - stddev_samp(lat) / 2 AS min_lat, avg(lat) + stddev_samp(lat) / 2 AS max_lat FROM v_points GROUP BY 1""",
    "v_field_lines": """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS variant, l_suppkey AS x, l_partkey % 50 AS y, l_quantity, l_discount FROM lineitem""",
    "v_pins": """SELECT 'family' || CAST(p_partkey % 4 AS VARCHAR) AS model, p_partkey // 20 AS run, p_brand AS package,
        CASE WHEN p_size % 2 = 0 THEN '==' ELSE '<=' END AS op, CAST(p_size AS VARCHAR) || '.0' AS version FROM part""",
    "v_layers": """SELECT c_nationkey AS patch, c_mktsegment AS name,
        CASE WHEN max(c_acctbal) > 9000 THEN NULL WHEN count(*) % 2 = 0 THEN 'GCS_WGS_1984' ELSE 'LOCAL' END AS crs
        FROM customer GROUP BY 1, 2""",
}
