"""Small helpers of the operators: tables, output batches, connected components."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import written

__all__ = ["batch", "components", "doc_texts", "public_tokenizer", "release_memory", "table", "written"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) only, so that no other column can clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def public_tokenizer(name: str) -> str:
    """Path of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def release_memory() -> None:
    """Give freed memory back to the system, so that idle workers stay small beside the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): (node, component), component = smallest node.

    Each round a node takes the smallest label among its neighbours and itself, then the label of that label
    (pointer jumping), until nothing changes. Labels are written to the shared folder each round.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        low = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("mid"))
        far = labels.select(F.col("node").alias("mid"), F.col("component").alias("jump"))
        new = written(low.join(far, "mid").select("node", "was", F.least("mid", "jump").alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where("was <> component").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
