"""Vector-layer sidecars: coordinate system (.prj, WKT1) and code page (.cpg)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.sources.files import list_tree, read_whole


def parse_crs(wkt: Column) -> list[Column]:
    """Name, datum, spheroid axes and angular unit of a geographic WKT1 text."""
    number = r"([0-9.eE+\-]+)"
    quoted = r'"([^"]*)"'
    get = lambda pattern, i=1: F.nullif(F.regexp_extract(wkt, pattern, i), F.lit(""))
    spheroid = rf"SPHEROID\[{quoted},{number},{number}"
    unit = rf"UNIT\[{quoted},{number}"
    return [
        get(rf"GEOGCS\[{quoted}").alias("crs"),
        get(rf"DATUM\[{quoted}").alias("datum"),
        get(spheroid, 2).try_cast("double").alias("semi_major"),
        get(spheroid, 3).try_cast("double").alias("inv_flattening"),
        get(unit, 1).alias("unit"),
        get(unit, 2).try_cast("double").alias("unit_rad"),
    ]


def _layer_ids() -> list[Column]:
    pattern = r"([^/]+)/([^/]+)\.[a-z]+$"
    return [F.regexp_extract("path", pattern, 1).alias("variant"), F.regexp_extract("path", pattern, 2).alias("name")]


def read_crs(spark: SparkSession, root: str) -> DataFrame:
    """One row per layer: variant (folder), name, coordinate system, encoding; either sidecar may be absent."""
    # Each folder below the root is walked by a task.
    files = list_tree(spark, root, "[^_.]*", below=True)
    find = lambda ext: read_whole(files.where(F.col("path").endswith(f".{ext}")))
    prj = find("prj").select(*_layer_ids(), *parse_crs(F.col("value")))
    cpg = find("cpg").select(*_layer_ids(), F.trim("value").alias("encoding"))
    # Grouped union in place of a full outer join: each sidecar gives at most one row per layer.
    both = prj.unionByName(cpg, allowMissingColumns=True)
    fields = [c for c in both.columns if c not in ("variant", "name")]
    return both.groupBy("variant", "name").agg(*[F.max(c).alias(c) for c in fields])
