"""Training-order materialisation: every sequence gets a global slot, shards hold fixed-stride records.

A keyed hash deals the sequences to WAVES waves, whose slots follow one another. In a wave they are numbered in the order of
the written sequence table; a keyed Feistel permutation of the smallest even-bit domain, walked until it falls below the
wave's size, sends each number to its slot. Shards are ranges of slots, written as one file each, so record i of shard s
starts at byte i * stride and a reader can resume anywhere. Shards are written wave by wave, and a wave of the sequence
table is deleted as soon as its shards are there: the table, the shuffle and the shards are never whole on disk together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.common import batch, doc_texts, written
from harrow.llm.encoders import WordEncoder, worker_copy
from harrow.llm.text import blocks, column_bytes, mixed
from harrow.session import removed, scratch_path

PAD = 49407  # end-of-text of the word vocabulary: closes a document and fills its last record
ROUNDS = 4
WAVES = 8  # a wave's sequence table goes once the next wave is written too: a quarter of it is left at the end

_SEQ = pa.schema(
    [("part", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32()), ("tokens", pa.binary()), ("wave", pa.int32())]
)
_SEQ_SQL = "part long, n long, doc_id long, piece int, n_tokens int, tokens binary, wave int"


def stride_of(length: int) -> int:
    """Bytes of a written record of `length` ids: the ids and a line feed."""
    return 2 * length + 1


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. n-1, applied to `index`."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(ROUNDS):
            salt = np.uint64(((key * ROUNDS + r + 1) * 0x9E3779B97F4A7C15) % 2**64)
            left, right = right, left ^ (mixed(right + salt) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def wave_of(part: int, index: np.ndarray, key: int) -> np.ndarray:
    """The wave of the sequences `index` of a partition."""
    salt = np.uint64((key * 0x9E3779B97F4A7C15 + part * 0xD1B54A32D192ED03) % 2**64)
    return (mixed(mixed(index.astype(np.uint64) + salt)) % np.uint64(WAVES)).astype(np.int32)


def sequences(docs: DataFrame, path: str, length: int = 512, key: int = 2024) -> DataFrame:
    """Every whole text as records of `length` 16-bit ids (little-endian), closed and filled with PAD; numbered in its partition and wave."""

    def run(batches):
        encoder = worker_copy(WordEncoder, path)
        part, seen, size = TaskContext.get().partitionId(), 0, np.zeros(WAVES, np.int64)
        for b in batches:
            data, off = column_bytes(b.column(1))
            for s, e, d, o in blocks(data, off, 4 << 20):
                raw, o = d.tobytes(), o.tolist()
                docs_, piece, count, out = [], [], [], []
                for doc, ids in zip(b.column(0)[s:e].to_pylist(), encoder.encode([raw[x:y] for x, y in zip(o, o[1:])]), strict=True):
                    ids = np.append(np.frombuffer(ids, "<u4").astype("<u2"), np.uint16(PAD))
                    k = -(-len(ids) // length)
                    full = np.full(k * length, PAD, "<u2")
                    full[: len(ids)] = ids
                    flat = full.tobytes()
                    docs_ += [doc] * k
                    piece += range(k)
                    count += [length] * (k - 1) + [len(ids) - (k - 1) * length]
                    out += [flat[i : i + 2 * length] for i in range(0, len(flat), 2 * length)]
                wave = wave_of(part, np.arange(seen, seen + len(out)), key)
                n = np.empty(len(out), np.int64)
                for w in range(WAVES):
                    (here,) = np.nonzero(wave == w)
                    n[here] = size[w] + np.arange(len(here))
                    size[w] += len(here)
                yield batch(_SEQ, np.full(len(out), part), n, docs_, piece, count, out, wave)
                seen += len(out)

    return doc_texts(docs).mapInArrow(run, _SEQ_SQL)


def _sequence_table(docs: DataFrame, path: str, length: int, key: int) -> str:
    """Writes the sequences to the shared folder, a folder for each wave."""
    folder = scratch_path(docs.sparkSession, "sequences")
    sequences(docs, path, length, key).write.partitionBy("wave").parquet(folder)
    return folder


def _read_waves(spark: SparkSession, folder: str, *waves: int) -> DataFrame:
    """The sequences of some waves, of all without any named."""
    return spark.read.schema(_SEQ_SQL).option("basePath", folder).parquet(*[f"{folder}/wave={w}" for w in waves] or [folder])


def _sizes(seq: DataFrame) -> dict[int, dict[int, int]]:
    """Sequences by wave and partition, both ascending: one number for each, whatever the rows."""
    out = {}
    for wave, part, c in sorted(map(tuple, seq.groupBy("wave", "part").agg(F.count(F.lit(1))).collect())):
        out.setdefault(wave, {})[part] = c
    return out


def _placed(seq: DataFrame, sizes: dict[int, dict[int, int]], records_a_shard: int, key: int) -> DataFrame:
    """Sequences with their slot and shard."""
    starts, totals, base, total = {}, {}, {}, 0
    for wave, parts in sizes.items():
        base[wave], starts[wave], totals[wave] = total, {}, sum(parts.values())
        for part, c in parts.items():
            starts[wave][part] = total - base[wave]
            total += c

    @F.pandas_udf("long")
    def slot_of(wave: pd.Series, part: pd.Series, n: pd.Series) -> pd.Series:
        out = np.empty(len(n), np.int64)
        for w in wave.unique():
            (here,) = np.nonzero(wave.to_numpy() == w)
            index = part.iloc[here].map(starts[w]).to_numpy(np.int64) + n.iloc[here].to_numpy(np.int64)
            out[here] = base[w] + feistel(index, totals[w], key * WAVES + int(w))
        return pd.Series(out)

    once = slot_of.asNondeterministic()  # it is not, but a filter on the slot would evaluate it again
    return seq.withColumn("slot", once("wave", "part", "n")).withColumn("shard", F.expr(f"slot div {records_a_shard}"))


def _sharded(placed: DataFrame, first: int, end: int, length: int, records_a_shard: int) -> DataFrame:
    """The shards first .. end - 1, one partition each, sorted by slot."""
    return (
        placed.repartitionById(max(1, end - first), (F.col("shard") - first).cast("int"))
        .sortWithinPartitions("slot")
        .select(
            "slot",
            "shard",
            (F.col("slot") % records_a_shard * stride_of(length)).alias("byte_offset"),
            *[c for c in placed.columns if c in ("doc_id", "piece", "n_tokens", "tokens")],
        )
    )


def in_training_order(docs: DataFrame, path: str, length: int = 512, records_a_shard: int = 8192, key: int = 2024) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, piece, n_tokens, tokens), one partition per shard, sorted by slot.

    byte_offset is the record's place in the shard's file as `write_shards` makes it. A null or empty text is one record that holds only PAD. The numbering follows the sequence table as written, so a lost executor
    re-reads the same numbers; another run over the same files gives the same order.
    """
    seq = _read_waves(docs.sparkSession, _sequence_table(docs, path, length, key))
    sizes = _sizes(seq)
    shards = -(-sum(sum(parts.values()) for parts in sizes.values()) // records_a_shard)
    return _sharded(_placed(seq, sizes, records_a_shard, key), 0, shards, length, records_a_shard)


def write_shards(ordered: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file per shard under path/shard=<n>/: raw records one after the other, each closed by a line feed (`stride_of`).

    `ordered` is that of `in_training_order`: its partitions are the shards. Spark's own text writer puts the bytes into any
    file system it can reach. With mode "append", shards that are not there yet join those that are.
    """
    rows = ordered.select("shard", "slot", F.col("tokens").cast("string").alias("value"))
    one = rows.sortWithinPartitions("shard", "slot").drop("slot")
    one.write.mode(mode).partitionBy("shard").option("lineSep", "\n").option("maxRecordsPerFile", 0).text(path)


def shard_index(docs: DataFrame, path: str, length: int = 512, records_a_shard: int = 8192, key: int = 2024) -> DataFrame:
    """Writes the shards to the shared folder; (slot, shard, byte_offset, doc_id, piece, n_tokens, folder) says where each record is.

    The ids of a record are the 2 * length bytes from byte_offset on in the one file of `folder`.
    """
    spark, out = docs.sparkSession, scratch_path(docs.sparkSession, "shards")
    folder = _sequence_table(docs, path, length, key)
    index = written(_read_waves(spark, folder).drop("tokens"), "sequence_index")
    sizes = _sizes(index)
    last, end, done, waiting = max(sizes, default=None), 0, 0, []
    for wave, parts in sizes.items():
        end += sum(parts.values())
        waiting.append(wave)
        full = -(-end // records_a_shard) if wave == last else end // records_a_shard
        if full > done:  # else the shard begun goes on in the next wave
            rows = _placed(_read_waves(spark, folder, *waiting), sizes, records_a_shard, key)
            write_shards(_sharded(rows.where(F.col("shard").between(done, full - 1)), done, full, length, records_a_shard), out, "append")
            for w in waiting if end == full * records_a_shard or wave == last else waiting[:-1]:
                removed(spark, f"{folder}/wave={w}")
            done, waiting = full, [] if end == full * records_a_shard else [wave]
    ordered = _sharded(_placed(index, sizes, records_a_shard, key), 0, done, length, records_a_shard)
    return ordered.withColumn("folder", F.concat(F.lit(f"{out}/shard="), F.col("shard").cast("string")))


def read_records(spark: SparkSession, path: str, shard: int, first: int, count: int, length: int = 512) -> list[np.ndarray]:
    """Records first .. first + count - 1 of a shard, by position alone."""
    stride = stride_of(length)
    files = spark.read.format("binaryFile").load(f"{path}/shard={shard}")
    part = files.select(F.expr(f"substring(content, {first * stride + 1}, {count * stride})").alias("c"), "path").orderBy("path").first()["c"]
    return [np.frombuffer(bytes(part[i : i + stride - 1]), "<u2") for i in range(0, len(part), stride)]
