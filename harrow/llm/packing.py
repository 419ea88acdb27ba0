"""Best-fit packing with certified bounds.

Items are dealt to partitions of a bounded number of items. Each partition packs by best-fit decreasing and compares its
bin count with lower bounds from dual-feasible functions of its sizes. A partition that meets its bound keeps its bins, but for
the loosest one; a partition with a gap gives up all bins that are not full. What is given up is dealt anew, to partitions of the
same bounded size, and packed again, until one partition holds the rest or a round makes no fewer bins of it.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import batch, doc_texts, written
from harrow.llm.encoders import WordEncoder, worker_copy
from harrow.llm.text import blocks, column_bytes

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PACKED = PIECES + ", place int, bin int, offset long, loose boolean"
ITEMS_A_TASK = 20_000
MAX_ROUNDS = 40


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Ids of every whole text, then `end_id`, cut into pieces of at most `capacity`. Null text: only `end_id`."""

    def run(batches):
        encoder = worker_copy(WordEncoder, path)
        end = end_id.to_bytes(4, "little")
        for b in batches:
            data, off = column_bytes(b.column(1))
            for s, e, d, o in blocks(data, off, 4 << 20):
                raw, o = d.tobytes(), o.tolist()
                cols: list[list] = [[], [], [], [], []]
                doc_ids = b.column(0)[s:e].to_pylist()
                for doc, ids in zip(doc_ids, encoder.encode([raw[x:y] for x, y in zip(o, o[1:])]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        for c, v in zip(cols, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                            c.append(v)
                yield batch(_PIECES, *cols)

    return doc_texts(docs).mapInArrow(run, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best of several dual-feasible functions: no packing of `sizes` has fewer bins.

    Each maps sizes to weights such that sizes fitting one bin have weights of at most one bin.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    upto_n, upto_s = np.cumsum(count), np.cumsum(count * x)
    best = -(-int(upto_s[-1]) // capacity)
    # Sizes over capacity - t count whole, sizes under t not at all.
    t = np.arange(1, capacity // 2 + 1)
    whole = upto_n[-1] - upto_n[capacity - t]
    middle = upto_s[capacity - t] - upto_s[t - 1]
    best = max(best, int((-(-(whole * capacity + middle) // capacity)).max()))
    # Rounding down to multiples of capacity / k, but for exact multiples of capacity / (k + 1).
    for k in range(1, 33):
        exact = (k + 1) * x % capacity == 0
        weight = np.where(exact, x * k, ((k + 1) * x // capacity) * capacity)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every size (given in descending order), and the free space of every bin.

    Bins with the same free space are a stack; the set bits of one integer say which free spaces exist.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    present, made = 0, 0
    for i, s in enumerate(sizes.tolist()):
        fits = present >> s
        if fits:
            free = s + (fits & -fits).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                present ^= 1 << free
        else:
            free, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - free
        if s < free:
            stacks[free - s].append(b)
            present |= 1 << (free - s)
    room = np.zeros(made, np.int64)
    for free, held in enumerate(stacks):
        room[held] = free
    return bins, offsets, room


def _pack_round(items: DataFrame, parts: int, capacity: int, last: bool, salt: int) -> DataFrame:
    def run(df):
        df = df.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        sizes = df["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(sizes, capacity)
        loose = np.zeros(len(room), bool)
        if not last:
            if len(room) > lower_bound(sizes, capacity):
                loose = room > 0
            loose[room.argmax()] |= room.max() > 0
        return df.assign(bin=bins.astype("int32"), offset=offsets, loose=loose[bins])

    row = F.coalesce("doc_id", F.monotonically_increasing_id())  # rows without an id must not all meet in one place
    dealt = items.withColumn("place", F.pmod(F.xxhash64(row, "piece", F.lit(salt)), F.lit(parts)).cast("int"))
    return dealt.groupBy("place").applyInPandas(run, PACKED)


def packed(items: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset, in as few sequences as it can.

    Repeated rows are packed as often as they come; an empty table gives an empty result. sequence_id holds the
    round, partition and bin; a full piece is a sequence of its own with a negative id.
    """
    items = written(items, "pieces")
    own = items.where(F.col("length") >= capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    out, rest = own, items.where(F.col("length") < capacity)
    left, spare, spare_bins = rest.count(), None, None
    for k in range(MAX_ROUNDS):
        if not left:
            break
        parts = math.ceil(left / ITEMS_A_TASK)
        last = parts == 1 or k == MAX_ROUNDS - 1
        done = written(_pack_round(rest, parts, capacity, last, k), "packed")
        number = F.lit(k).cast("long") * 2**56 + F.col("place").cast("long") * 2**28 + F.col("bin")
        # Every bin has one item at offset 0.
        sums = [F.sum(F.expr(c).cast("long")).alias(n) for n, c in (("bins", "offset = 0"), ("loose_bins", "loose and offset = 0"), ("left", "loose"))]
        n = done.agg(*sums).first()
        if spare is not None and n["bins"] >= spare_bins:
            out = out.union(spare)  # the round before had them in no more bins
            break
        out = out.union(done.where(~F.col("loose")).select(*items.columns, number.alias("sequence_id"), "offset"))
        rest = done.where("loose").select(*items.columns)
        spare = done.where("loose").select(*items.columns, number.alias("sequence_id"), "offset")
        left, spare_bins = n["left"], n["loose_bins"]
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    return packed(pieces(docs, path, capacity), capacity)
