"""A training-data pipeline over `documents`: quality, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept; `run` writes each result to the
shared folder and reads it again. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import jaccard, ordinal, packing, suffixes
from harrow.llm.common import public_tokenizer, table, written
from harrow.llm.queries import LEAST_TOP, WORD_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose chance of the top grade is below LEAST_TOP; the model is fitted on `labels`."""
    model = ordinal.fit(docs, ordinal.ratings_of(table(spark, sf_dir, "labels")))
    return ordinal.selected(docs, model, LEAST_TOP)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, that of the smallest doc_id, of every component of documents with five-word Jaccard similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs, 5, 80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte of a 50-byte string that an earlier document also has; n_chars follows the text."""
    # Other columns travel under names of their own, so that none clashes with what the operator adds.
    others = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")}
    named = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in others.items()])
    cut = suffixes.without_repeats(named, 50, carry=list(others.values()), with_text=True, digests=False)
    back = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")} | {c: F.col(n) for c, n in others.items()}
    return cut.select(*[back[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of what is left into sequences of 2048."""
    return packing.pack_documents(docs, public_tokenizer(WORD_BPE), 2048)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packed)]

#: The classifier and the tokenizer are beyond SQL; tests/llm/test_pipeline.py compares the stages and the whole with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
