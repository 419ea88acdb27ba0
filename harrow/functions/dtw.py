"""Dynamic time warping distance: sqrt of the least sum of squared differences over warping paths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dtw_expr(a: Column, b: Column) -> Column:
    """DTW as a built-in expression (JVM side): fold over `a`, keeping one cost row over `b`.

    The row before `a` starts is [0, inf, inf, ...]: a path may only start at the first pair.
    Work is len(a) * len(b) per row; meant for short series.
    """
    inf = F.lit(float("inf"))
    first = F.concat(F.array(F.lit(0.0)), F.transform(b, lambda _: inf))

    def next_row(prev: Column, x: Column) -> Column:
        # Pair each b value with the two costs above it, then run left to right.
        steps = F.zip_with(
            b,
            F.zip_with(F.slice(prev, 1, F.size(b)), F.slice(prev, 2, F.size(b)), lambda d, u: F.least(d, u)),
            lambda y, above: F.struct(((x - y) * (x - y)).alias("cost"), above.alias("above")),
        )
        return F.aggregate(
            steps,
            F.array(inf),
            lambda row, s: F.concat(row, F.array(s["cost"] + F.least(s["above"], F.element_at(row, -1)))),
        )

    return F.sqrt(F.element_at(F.aggregate(a, first, next_row), -1))


CELLS = 4_000_000  # cost-table cells held at once per task


def padded(arrays) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in arrays], dtype=np.int64)
    out = np.zeros((len(arrays), max(int(sizes.max(initial=0)), 1)))
    for i, x in enumerate(arrays):
        out[i, : len(x)] = x
    return out, sizes


def cost_tables(a: np.ndarray, b: np.ndarray, window: int | None = None) -> np.ndarray:
    """Accumulated costs for a batch: a is (rows, n), b is (rows, m) or (m,) -> (rows, n + 1, m + 1).

    Cells are filled one at a time over (n, m) but for all rows of the batch at once. Cells beyond a
    row's true length never feed the cells inside it, so padding needs no special case.
    """
    b = np.broadcast_to(b, (a.shape[0], b.shape[-1]))
    rows, n, m = a.shape[0], a.shape[1], b.shape[1]
    d = np.full((n + 1, m + 1, rows), np.inf)
    d[0, 0] = 0.0
    for i in range(1, n + 1):
        lo, hi = (1, m) if window is None else (max(1, i - window), min(m, i + window))
        for j in range(lo, hi + 1):
            gap = a[:, i - 1] - b[:, j - 1]
            d[i, j] = gap * gap + np.minimum(np.minimum(d[i - 1, j], d[i, j - 1]), d[i - 1, j - 1])
    return np.moveaxis(d, 2, 0)


def blocks(a, longest_b: int):
    """Slices of `a` whose cost tables together stay under CELLS cells."""
    longest = max((len(x) for x in a), default=0)
    size = max(1, CELLS // ((longest + 1) * (longest_b + 1)))
    return [slice(s, s + size) for s in range(0, len(a), size)]


def dtw_batch(a, b, window: int | None = None) -> np.ndarray:
    """Distances of the pairs (a[i], b[i])."""
    out = np.full(len(a), np.nan)
    for part in blocks(a, max((len(x) for x in b), default=0)):
        pa, na = padded(a[part])
        pb, nb = padded(b[part])
        d = cost_tables(pa, pb, window)
        out[part] = np.sqrt(d[np.arange(len(na)), na, nb])
    return out


def dtw_to(a, centre: np.ndarray) -> np.ndarray:
    """Distances of every a[i] to one centre."""
    out = np.full(len(a), np.nan)
    for part in blocks(a, len(centre)):
        pa, na = padded(a[part])
        out[part] = np.sqrt(cost_tables(pa, centre)[np.arange(len(na)), na, len(centre)])
    return out


def dtw_udf(window: int | None = None):
    """DTW as an Arrow UDF for longer series, with an optional band |i - j| <= window."""

    @F.pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(dtw_batch(list(a), list(b), window))

    return distance
