"""k-means over time series with dynamic time warping: arrays(<key>, values array<double>).

Centres are k short arrays and live on the driver between rounds; the series stay in the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.dtw import blocks, cost_tables, dtw_to, padded
from harrow.functions.values import unit_hash
from harrow.session import written


def _nearest(values: list, centres: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    d = np.stack([dtw_to(values, c) for c in centres])
    return d.argmin(axis=0), d.min(axis=0)


def _nearest_udf(centres: list[list[float]]):
    fixed = [np.asarray(c, dtype=float) for c in centres]

    @F.pandas_udf("cluster int, distance double")
    def nearest(values: pd.Series) -> pd.DataFrame:
        cluster, distance = _nearest(list(values), fixed)
        return pd.DataFrame({"cluster": cluster.astype("int32"), "distance": distance})

    return nearest


def assign(arrays: DataFrame, centres: list[list[float]], key: str = "series") -> DataFrame:
    """Nearest centre per series (ties: lowest centre) and the distance to it."""
    near = arrays.select(key, _nearest_udf(centres)("values").alias("_n"))
    return near.select(key, "_n.cluster", "_n.distance")


def kmeanspp(arrays: DataFrame, k: int, seed: int, key: str = "series") -> list[list[float]]:
    """k starting centres: each draw prefers series far from the centres so far (weight = distance squared).

    The draw is the row with the least -ln(u) / weight, with u a hash of (seed, round, key): one
    top-1 per round, the same on every run and partitioning.
    """
    u = lambda r: unit_hash(F.lit(seed), F.lit(r), F.col(key))
    first = arrays.orderBy(u(0), key).select("values").first()
    if first is None:
        raise ValueError("no series")
    centres = [list(first["values"])]
    near = arrays.select(key, "values", F.lit(float("inf")).alias("_d"))
    for r in range(1, k):
        # Only the newest centre is measured; the least distance so far is kept.
        newest = _nearest_udf(centres[-1:])("values")["distance"]
        near = written(near.select(key, "values", F.least("_d", newest).alias("_d")), "seeding")
        draw = -F.log(u(r)) / (F.col("_d") * F.col("_d"))
        row = near.where(F.col("_d") > 0).orderBy(draw, key).select("values").first()
        if row is None:  # fewer distinct series than k
            break
        centres.append(list(row["values"]))
    return centres


def _align(values: list, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count, per centre position, of the points the best warping paths put on it."""
    sums, counts = np.zeros(len(centre)), np.zeros(len(centre))
    for part in blocks(values, len(centre)):
        a, n = padded(values[part])
        d = cost_tables(a, centre)
        rows = np.arange(len(n))
        i, j = n.copy(), np.full(len(n), len(centre))
        live = (i > 0) & (j > 0)
        while live.any():
            r = rows[live]
            np.add.at(sums, j[r] - 1, a[r, i[r] - 1])
            np.add.at(counts, j[r] - 1, 1)
            back = np.stack([d[r, i[r] - 1, j[r] - 1], d[r, i[r] - 1, j[r]], d[r, i[r], j[r] - 1]])
            move = back.argmin(axis=0)
            i[r] -= (move != 2).astype(int)
            j[r] -= (move != 1).astype(int)
            live = (i > 0) & (j > 0)
    return sums, counts


def _barycentre_sums(arrays: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Per (cluster, position): sum, count and inertia share; each Arrow batch is reduced before the shuffle."""
    fixed = [np.asarray(c, dtype=float) for c in centres]

    def batches(frames):
        for pdf in frames:
            if pdf.empty:
                continue
            values = list(pdf["values"])
            cluster, distance = _nearest(values, fixed)
            for c in np.unique(cluster):
                mine = np.flatnonzero(cluster == c)
                sums, counts = _align([values[m] for m in mine], fixed[c])
                inertia = float((distance[mine] ** 2).sum())
                yield pd.DataFrame(
                    {
                        "cluster": np.int32(c),
                        "pos": np.arange(len(sums), dtype="int32"),
                        "s": sums,
                        "n": counts,
                        "inertia": np.where(np.arange(len(sums)) == 0, inertia, 0.0),
                    }
                )

    parts = arrays.select("values").mapInPandas(batches, "cluster int, pos int, s double, n double, inertia double")
    return parts.groupBy("cluster", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("inertia").alias("inertia"))


def kmeans_dtw(
    arrays: DataFrame, k: int = 6, seed: int = 10, max_iter: int = 10, tol: float = 1e-6, key: str = "series"
) -> tuple[DataFrame, list[list[float]]]:
    """(assignments(key, cluster, distance), centres).

    One barycentre step per round: every member is aligned to its centre, and a centre point becomes the
    mean of the points aligned to it. The arrays are written once to the shared folder, so each round
    is a short plan that can be rerun; rounds stop when no centre point moves by more than `tol`.
    """
    fixed = written(arrays.select(key, "values"), "series")
    centres = kmeanspp(fixed, k, seed, key)
    for _ in range(max_iter):
        # k * (centre length) rows, both bounded.
        rows = _barycentre_sums(fixed, centres).collect()
        moved = [list(c) for c in centres]
        for r in rows:
            moved[r["cluster"]][r["pos"]] = r["s"] / r["n"]
        shift = max(abs(a - b) for old, new in zip(centres, moved) for a, b in zip(old, new))
        centres = moved
        if shift <= tol:
            break
    return assign(fixed, centres, key), centres


def save_centres(spark: SparkSession, centres: list[list[float]], root: str, name: str) -> str:
    """Cluster centres under `root`/`name`, one row per centre; the folder must be shared."""
    path = f"{root.rstrip('/')}/{name}"
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, "cluster int, centre array<double>").write.mode("overwrite").parquet(path)
    return path


def load_centres(spark: SparkSession, root: str, name: str) -> list[list[float]]:
    """The stored centres, for `assign`."""
    return [r["centre"] for r in spark.read.parquet(f"{root.rstrip('/')}/{name}").orderBy("cluster").collect()]
