"""Pixel tables in, band tables out."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.ordered import join_groups, size_checked
from harrow.sources.stored import read_or_none


def read_pixels(spark: SparkSession, path: str, bands: list[str], keys: list[str] = ("scene_ts", "x", "y")) -> DataFrame:
    """Only the declared input bands (and the keys) are read from the files."""
    return spark.read.parquet(path).select(*keys, *bands)


def write_bands(df: DataFrame, path: str, scene: str = "scene_ts") -> None:
    """Add the scenes of `df` to the band table under `path`; a scene written before is replaced, other scenes of its day stay.

    The rows go to a folder of this call's own, below one folder per month and sorted by date. Then one manifest file names the scenes
    (`scene` and date) that this call holds, and so commits them all at once: a call that dies before leaves nothing that `read_bands`
    shows. Rows with a null scene form one scene without a date. Of two writers of one scene at one time, either may stay, never both.
    """
    spark = df.sparkSession
    batch = uuid.uuid4().hex
    dated = df.withColumn("scene_date", F.to_date(scene)).withColumn("scene_month", F.date_format("scene_date", "yyyy-MM"))
    # Rows of a month are gathered; adaptive execution cuts a month that is too big for one task.
    gathered = dated.hint("rebalance", "scene_month").sortWithinPartitions("scene_month", "scene_date")
    gathered.write.partitionBy("scene_month").parquet(f"{path}/batches/batch={batch}")
    before = read_or_none(spark, f"{path}/manifest")
    number = 0 if before is None else before.agg(F.max("number")).first()[0]
    held = spark.read.schema(dated.schema).parquet(f"{path}/batches/batch={batch}").groupBy("scene_date", F.col(scene).alias("scene")).agg(F.count(F.lit(1)).alias("n"))
    entry = held.withColumns({"batch": F.lit(batch), "number": F.lit((number or 0) + 1).cast("long")})
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def read_bands(spark: SparkSession, path: str, scene: str = "scene_ts", first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
    """The committed rows under `path` with `scene_date`, of the days from `first` to `last` where given.

    Of every scene the newest write counts. Days outside are left out by month folders and by the files' own statistics.
    """

    def wanted(rows: DataFrame) -> DataFrame:
        for day, keep in ((first, lambda c, d: c >= d), (last, lambda c, d: c <= d)):
            if day is not None:
                rows = rows.where(keep(F.col("scene_date"), F.lit(day)))
                if "scene_month" in rows.columns:
                    rows = rows.where(keep(F.col("scene_month"), F.lit(day.strftime("%Y-%m"))))
        return rows

    manifest = wanted(spark.read.parquet(f"{path}/manifest"))
    # One row per scene ever written; its newest write by number, then by name.
    newest = manifest.groupBy("scene").agg(F.max(F.struct("number", "batch")).alias("_w")).select("scene", F.col("_w.batch").alias("batch"))
    schema = spark.read.parquet(f"{path}/batches").schema
    text = {"batch", "scene_month"}  # folder names are text, whatever they look like
    rows = wanted(spark.read.schema(", ".join(f"`{f.name}` {'string' if f.name in text else f.dataType.simpleString()}" for f in schema.fields)).parquet(f"{path}/batches"))
    key = rows.withColumnRenamed(scene, "scene") if scene != "scene" else rows
    # A null scene is a scene too: keys are compared through a marked text.
    marked = lambda d: d.withColumn("_scene", F.coalesce(F.concat(F.lit("="), F.col("scene").cast("string")), F.lit("")))
    kept = join_groups(marked(key), size_checked(marked(newest).select("_scene", "batch")), ["_scene", "batch"])
    out = kept.withColumnRenamed("scene", scene)
    return out.select(*[c for c in schema.fieldNames() if c not in text])
