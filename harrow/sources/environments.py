"""Pinned packages of saved models: <root>/<experiment>/<run>/artifacts/<model>/{conda,python_env}.yaml."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.values import parse_pin, parse_unpinned
from harrow.sources.files import list_tree, read_whole


def read_env_pins(spark: SparkSession, root: str, file: str = "conda.yaml") -> DataFrame:
    """(experiment_id, run, model, file, package, op, version), nested pip lists flattened.

    A line without a version gives a row with null op and version. Channels are not packages.
    """
    files = read_whole(list_tree(spark, root, f"*/*/artifacts/*/{file}"))
    listed = F.regexp_replace("value", r"(?m)^channels:[ \t]*\n(?:[ \t]*-.*(?:\n|$))*", "")
    pattern = r"([^/]+)/([^/]+)/artifacts/([^/]+)/([^/]+)$"
    names = ["experiment_id", "run", "model", "file"]
    ids = [F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    lines = files.select(*ids, F.explode(F.split(listed, r"\r?\n")).alias("value"))
    pins = lines.select(*names, F.coalesce(parse_pin(F.col("value")), parse_unpinned(F.col("value"))).alias("_p")).where(F.col("_p").isNotNull())
    return pins.select(*names, "_p.*")
