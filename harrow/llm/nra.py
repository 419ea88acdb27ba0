"""Exact top-k inner products by no-random-access aggregation.

One list per dimension holds the candidates in order of that component; a query reads it from the top (positive weight) or the
bottom (negative weight). After each portion every object has a lower bound (unread components at their worst) and an upper
bound (unread ones at the last value read). Reading stops when only few objects can still qualify; their scores are then
resolved. Blocks of candidates are tasks of their own, and the blocks' winners are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.llm.common import written

BLOCK_ROWS = 16_384
DEPTHS = (0.25, 0.5, 0.75)
#: Share of the block that may still qualify when reading stops.
FEW = 0.02


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, codes): floor(scale * x) of each component as 64-bit integers; unusable vectors are left out."""
    schema = pa.schema([("vec_id", pa.int64()), ("codes", pa.binary())])

    def run(batches):
        for b in batches:
            ids, out = [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i is None or v is None or any(x is None for x in v):
                    continue
                x = np.floor(scale * np.array(v, np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    out.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], schema=schema)

    d = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    return d.mapInArrow(run, "vec_id long, codes binary")


def _matrix(codes: pd.Series) -> np.ndarray:
    """Rows of integers; shorter vectors count as filled up with zeros."""
    width = max((len(c) for c in codes), default=0)
    return np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), "<i8").reshape(len(codes), width // 8)


class SortedLists:
    """The sorted lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, kind: type):
        self.ids, self.values = ids, values.astype(kind)
        self.sorted = np.sort(self.values, axis=0)  # ascending; read from either end
        self.kind = kind

    def read(self, depth: float) -> tuple[np.ndarray, ...]:
        """What is known of each component after `depth` of every list: upper and lower bounds for weights of either sign."""
        n = len(self.values)
        p = max(1, math.ceil(depth * n))
        low, high = self.sorted[p - 1], self.sorted[n - p]
        worst, best = self.sorted[0], self.sorted[-1]
        v = self.values
        return np.maximum(v, high), np.minimum(v, low), np.where(v >= high, v, worst), np.where(v <= low, v, best)

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, candidate, score) of each query's k best of this block, ties to smaller ids."""
        out = []
        n = len(self.ids)
        q = queries.astype(self.kind)
        plus, minus = np.maximum(q, 0), np.maximum(-q, 0)
        own = query_ids[:, None] == self.ids[None, :]
        alive = np.arange(len(q))
        may: dict[int, np.ndarray] = {}
        for depth in DEPTHS if n > 4 * k else ():
            if not len(alive):
                break
            up_p, up_m, lo_p, lo_m = self.read(depth)
            lower = plus[alive] @ lo_p.T - minus[alive] @ lo_m.T
            lower[own[alive]] = -np.inf
            bar = np.partition(lower, n - k, axis=1)[:, n - k]
            upper = plus[alive] @ up_p.T - minus[alive] @ up_m.T
            can = (upper >= bar[:, None]) & ~own[alive]
            few = can.sum(1) <= max(2 * k, FEW * n)
            for i in np.flatnonzero(few):
                may[int(alive[i])] = np.flatnonzero(can[i])
            alive = alive[~few]
        # Resolve: the rest of the lists, for the objects that are left.
        if len(alive):
            score = q[alive] @ self.values.T
            for row, i in enumerate(alive):
                can = np.flatnonzero(~own[i])
                out += self._best(query_ids[i], can, score[row, can], k)
        for i, can in may.items():
            out += self._best(query_ids[i], can, self.values[can] @ q[i], k)
        return out

    def _best(self, query, can, score, k):
        if len(can) > k:
            bar = np.partition(score, len(score) - k)[len(score) - k]
            some = score >= bar
            can, score = can[some], score[some]
        order = np.lexsort((self.ids[can], -score))[:k]
        return [(int(query), int(self.ids[can[j]]), int(score[j])) for j in order]


def _search(k: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        asked = df["query"].to_numpy()
        parts = []
        for mask in (asked, ~asked):
            d = df[mask].sort_values(["vec_id", "codes"], kind="stable").drop_duplicates("vec_id")
            parts.append((d["vec_id"].to_numpy(np.int64), _matrix(d["codes"])))
        (q_ids, q), (c_ids, c) = parts
        width = max(q.shape[1], c.shape[1])
        q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))
        rows = []
        if len(q) and len(c):
            largest = max(1, width) * (float(np.abs(q).max(initial=0)) + 1) * (float(np.abs(c).max(initial=0)) + 1)
            kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
            if kind is np.int64:  # bounds would not be exact: read the lists to their end at once
                for i in range(len(q)):
                    can = np.flatnonzero(c_ids != q_ids[i])
                    score = c[can] @ q[i]
                    order = np.lexsort((c_ids[can], -score))[:k]
                    rows += [(int(q_ids[i]), int(c_ids[can[j]]), int(score[j])) for j in order]
            else:
                lists = SortedLists(c_ids, c, kind)
                step = max(1, (64 << 20) // (8 * len(c)))
                for s in range(0, len(q), step):
                    rows += lists.top(q_ids[s : s + step], q[s : s + step], k)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best inner products of each query with all other rows.

    `is_query` is a condition on vec_id. Vectors that are null or hold a null or non-finite component take no part, nor do rows without
    id; of rows that share a vec_id the one with the smallest code bytes counts. Shorter vectors are filled up with zeros.
    Fewer than k candidates: all of them. Every query meets every candidate block, in blocks of BLOCK_ROWS.
    """
    spark = vectors.sparkSession
    v = written(quantised(vectors, id_col, vector_col, scale), "vectors")
    q = v.where(is_query)
    n, n_q = v.count(), q.count()
    blocks, lots = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(n_q / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    lot = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(lots))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    asked = q.withColumn("lot", lot).withColumn("block", every(blocks)).select("block", "lot", "vec_id", "codes", F.lit(True).alias("query"))
    others = v.withColumn("block", block).withColumn("lot", every(lots)).select("block", "lot", "vec_id", "codes", F.lit(False).alias("query"))
    found = asked.union(others).groupBy("block", "lot").applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
