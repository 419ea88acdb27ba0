"""Ordered (window-like) computations that stay correct and balanced when one group is huge.

Every helper here has two ways to the same result:

* no group above `hot_rows` rows: one ordinary Spark window;
* otherwise: rows are range-partitioned on (group, order) so that a hot group is cut into many
  contiguous ranges, each range is scanned on its own, and what a range needs from the ranges
  before it (the carry) is added by a join. Only a group that crosses a range border needs a
  carry, so the carry table has at most two rows per range partition: its broadcast size is
  bounded by the partition count, whatever the data size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.session import hot_rows as session_hot_rows
from harrow.session import written

MIN_RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Running:
    """One running value: `how` in row_number, count, sum, max, min, max_before, last, lag."""

    how: str
    col: str | None = None


def row_number() -> Running:
    return Running("row_number")


def running(how: str, col: str) -> Running:
    return Running(how, col)


def best_before(col: str) -> Running:
    """Maximum over the rows before the current one (null on a group's first row)."""
    return Running("max_before", col)


def last_known(col: str) -> Running:
    """Latest non-null value up to and including the row."""
    return Running("last", col)


def previous(col: str) -> Running:
    """Value of the row before (null on a group's first row)."""
    return Running("lag", col)


def sort_columns(order: list[str]) -> list[Column]:
    """'x' sorts ascending, '-x' descending."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def group_sizes(df: DataFrame, by: list[str]) -> tuple[int, int]:
    """(rows of the largest group, rows in all). Counts combine map-side; two numbers come back."""
    if not by:
        n = df.count()
        return n, n
    top = df.groupBy(*by).count().agg(F.max("count"), F.sum("count")).first()
    return top[0] or 0, top[1] or 0


def has_hot_group(df: DataFrame, by: list[str], limit: int) -> bool:
    """True when some group exceeds `limit` rows, or when all rows are one group."""
    return not by or group_sizes(df, by)[0] > limit


def _local(spec: Running, w) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    match spec.how:
        case "row_number":
            return F.row_number().over(w).cast("long")
        case "lag":
            return F.lag(spec.col).over(w)
        case "last":
            return F.last(spec.col, ignorenulls=True).over(upto)
        case "max_before":
            return F.max(spec.col).over(w.rowsBetween(Window.unboundedPreceding, -1))
        case "count" | "sum" | "max" | "min":
            return getattr(F, spec.how)(spec.col).over(upto)
    raise ValueError(f"unknown running value {spec.how!r}")


def _total(spec: Running) -> Column:
    """What one range contributes to the ranges after it."""
    match spec.how:
        case "row_number":
            return F.count(F.lit(1))
        case "lag":
            return F.max_by(F.struct(spec.col), F.col("_seq"))
        case "last":
            return F.max_by(spec.col, F.when(F.col(spec.col).isNotNull(), F.col("_seq")))
        case "max_before":
            return F.max(spec.col)
    return getattr(F, spec.how)(spec.col)


def _carry(spec: Running, total: str, before) -> Column:
    if spec.how in ("row_number", "count", "sum"):
        return F.sum(total).over(before)
    if spec.how in ("max", "min", "max_before"):
        return getattr(F, spec.how[:3])(total).over(before)
    return F.last(total, ignorenulls=True).over(before)


def _merge(spec: Running, local: Column, carry: Column) -> Column:
    match spec.how:
        case "row_number" | "count":
            return local + F.coalesce(carry, F.lit(0))
        case "sum":
            return F.when(carry.isNull(), local).otherwise(carry + F.coalesce(local, F.lit(0)))
        case "max" | "max_before":
            return F.greatest(local, carry)
        case "min":
            return F.least(local, carry)
        case "last":
            return F.coalesce(local, carry)
    return F.when(F.col("_seq") == 1, carry.getField(spec.col)).otherwise(local)


def _plain(df, by, order, cols) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*sort_columns(order))
    return df.select("*", *[_local(s, w).alias(n) for n, s in cols.items()])


def _ranged(df, by, order, cols, parts) -> DataFrame:
    keep = df.columns
    keys = by or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    placed = df.repartitionByRange(parts, *[F.col(k) for k in keys], *sort_columns(order))
    # The range bounds come from a sample, so the placement is written down before it is read twice.
    r = written(placed.withColumn("_rng", F.spark_partition_id()), "ranges")

    w = Window.partitionBy("_rng", *keys).orderBy(*sort_columns(order))
    local = r.select(
        "*", F.row_number().over(w).alias("_seq"), *[_local(s, w).alias(f"_l_{n}") for n, s in cols.items()]
    )
    key = F.struct(*keys)
    edges = r.groupBy("_rng").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    border = (
        local.join(F.broadcast(edges), "_rng")
        .where(key.eqNullSafe(F.col("_lo")) | key.eqNullSafe(F.col("_hi")))
        .groupBy("_rng", *keys)
        .agg(*[_total(s).alias(f"_t_{n}") for n, s in cols.items()])
    )
    before = Window.partitionBy(*keys).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    carry = border.select(
        F.col("_rng").alias("_c_rng"),
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[_carry(s, f"_t_{n}", before).alias(f"_carry_{n}") for n, s in cols.items()],
    )
    on = F.col("_rng") == F.col("_c_rng")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    joined = local.join(F.broadcast(carry), on, "left")
    return joined.select(
        *keep, *[_merge(s, F.col(f"_l_{n}"), F.col(f"_carry_{n}")).alias(n) for n, s in cols.items()]
    )


def over_order(df: DataFrame, by: list[str], order: list[str], cols: dict[str, Running], hot_rows=None) -> DataFrame:
    """Add running values per group. `by` empty means one order over all rows (never a one-task window).

    `order` should end in a unique column: ties are otherwise ordered arbitrarily.
    """
    limit = session_hot_rows(df.sparkSession) if hot_rows is None else hot_rows
    largest, rows = group_sizes(df, by)
    if by and largest <= limit:
        return _plain(df, by, order, cols)
    # Enough ranges that each holds about what one task may sort.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _ranged(df, by, order, cols, max(parts, math.ceil(rows / max(limit, MIN_RANGE_ROWS))))


def over_frame(df: DataFrame, by: list[str], order: list[str], n: int, build, hot_rows=None) -> DataFrame:
    """Add columns over the frame of `n` rows either side; `build(window)` -> {name: Column}.

    A hot group is numbered, cut into chunks of consecutive rows, and each chunk gets copies of the
    `n` rows beside it, so every frame is whole inside its chunk and no task sees the full group.
    """
    limit = session_hot_rows(df.sparkSession) if hot_rows is None else hot_rows
    keep = df.columns
    if not has_hot_group(df, by, limit):
        w = Window.partitionBy(*by).orderBy(*sort_columns(order))
        return df.select("*", *[c.alias(k) for k, c in build(w.rowsBetween(-n, n), w).items()])
    size = max(limit, n)
    at = over_order(df, by, order, {"_pos": row_number()}, hot_rows=limit).withColumn("_pos", F.col("_pos") - 1)
    home = F.floor(F.col("_pos") / size)
    offset = F.col("_pos") % size
    copies = F.array(
        home,
        F.when((offset < n) & (home > 0), home - 1),
        F.when(offset >= size - n, home + 1),
    )
    spread = (
        at.withColumn("_home", home).withColumn("_chunk", F.explode(copies)).where(F.col("_chunk").isNotNull())
    )
    w = Window.partitionBy(*by, "_chunk").orderBy("_pos")
    cols = build(w.rowsBetween(-n, n), w)
    return (
        spread.select("*", *[c.alias(k) for k, c in cols.items()])
        .where(F.col("_chunk") == F.col("_home"))
        .select(*keep, *cols)
    )


def exact_quantiles(df: DataFrame, by: list[str], col: str, qs: dict[str, float], hot_rows=None) -> DataFrame:
    """Interpolated quantiles per group, exact at any group size: one row per group, one column per entry of `qs`.

    Small groups use Spark's `percentile`. Its buffer holds every distinct value of a group, so above
    `hot_rows` the values are counted first and the counts are worked on.
    """
    limit = session_hot_rows(df.sparkSession) if hot_rows is None else hot_rows
    present = df.where(F.col(col).isNotNull())
    if by and not has_hot_group(present, by, limit):
        return present.groupBy(*by).agg(*[F.percentile(col, F.lit(q)).alias(n) for n, q in qs.items()])
    counts = written(present.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n")), "counts")
    return quantiles_of_counts(counts, by, col, qs, limit)


def quantiles_of_counts(counts: DataFrame, by: list[str], col: str, qs: dict[str, float], hot_rows=None) -> DataFrame:
    """Quantiles from distinct values with their counts `_n`.

    The counts are summed in order of value, and the values whose rows cover the wanted positions are picked.
    """
    limit = session_hot_rows(counts.sparkSession) if hot_rows is None else hot_rows
    if by and not has_hot_group(counts, by, limit):
        return counts.groupBy(*by).agg(*[F.percentile(col, F.lit(q), F.col("_n")).alias(n) for n, q in qs.items()])
    keys = by or ["_all"]
    if not by:
        counts = counts.withColumn("_all", F.lit(0))
    upto = over_order(counts, by, [col], {"_cum": running("sum", "_n")}, hot_rows=limit)
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    placed = join_groups(upto, sizes, keys)

    def at(position: Column) -> Column:
        inside = (F.col("_cum") - F.col("_n") <= position) & (position < F.col("_cum"))
        return F.max(F.when(inside, F.col(col)))

    aggs = []
    for name, q in qs.items():
        p = F.lit(float(q)) * (F.col("_size") - 1)
        aggs += [
            at(F.floor(p)).alias(f"_lo_{name}"),
            at(F.ceil(p)).alias(f"_hi_{name}"),
            F.max(p - F.floor(p)).alias(f"_f_{name}"),
        ]
    picked = placed.groupBy(*keys).agg(*aggs)
    lo, hi, f = "_lo_", "_hi_", "_f_"
    return picked.select(
        *by,
        # Equal neighbours need no interpolation; infinities would give NaN.
        *[F.when(F.col(lo + n) == F.col(hi + n), F.col(lo + n)).otherwise(F.col(lo + n) + F.col(f + n) * (F.col(hi + n) - F.col(lo + n))).alias(n) for n in qs],
    )


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on group keys where null is a group like any other; columns of `left`, then the rest of `right`."""
    rest = [c for c in right.columns if c not in keys]
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *rest)
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        on = same if on is None else on & same
    return left.join(r, on, how).select(*left.columns, *rest)


def size_checked(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcastable copy of `df` when it has at most `max_rows` rows; else `df` itself, for a shuffle join.

    The rows are read once here (never more than `max_rows` + 1), so an aggregate is not computed twice.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
