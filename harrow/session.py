"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
HOT_ROWS_CONF = "spark.harrow.hotGroupRows"
DEFAULT_HOT_ROWS = 2_000_000

_local_scratch: dict[str, str] = {}


def build_session(app: str = "harrow", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the one the cluster names, else (tests) one made here."""
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        _local_scratch[app] = tempfile.mkdtemp(prefix="harrow-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: short lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared folder that its maker needs no more, and nobody else was given."""
    if not path.startswith(f"{scratch_dir(spark)}/"):
        raise ValueError(f"not in the shared folder: {path}")
    full = spark._jvm.org.apache.hadoop.fs.Path(path)
    full.getFileSystem(spark._jsc.hadoopConfiguration()).delete(full, True)


def hot_rows(spark: SparkSession) -> int:
    """Rows of one group that a single task may sort; larger groups are split over ranges."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))
