"""Regions as boxes and grid cells. The definitions here are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.ordered import join_groups, size_checked


def _level(extent: Column) -> Column:
    """Exponent of the smallest power of two at or above the extent (a point box gets a fine level)."""
    return F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(F.lit(-30)).cast("int")


def clip_bbox(points: DataFrame, boxes: DataFrame, box_id: str = "box") -> DataFrame:
    """Points with every box that contains them, borders included.

    boxes(box_id, min_lon, max_lon, min_lat, max_lat). Each box takes grid cells as wide as itself
    rounded up to a power of two, so it covers at most two cells per axis; each point looks up its cell
    once per cell size in use. The join is an equi-join on (size, cell) followed by the exact test.
    """
    # A float copy of the widest side, nudged up, so rounding cannot make a box span three cells.
    extent = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat")) * 1.000001
    leveled = boxes.select("*", _level(extent).alias("_level"))
    # Powers of two of doubles: at most about 2,100, however many boxes there are.
    levels = [r[0] for r in leveled.select("_level").distinct().collect()]

    def cell(v: str) -> Column:
        return F.floor(F.col(v) / F.pow(F.lit(2.0), F.col("_level")))

    cells = (
        leveled.withColumn("_cx", F.explode(F.sequence(cell("min_lon"), cell("max_lon"))))
        .withColumn("_cy", F.explode(F.sequence(cell("min_lat"), cell("max_lat"))))
    )
    placed = (
        points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in sorted(levels)])) if levels else F.lit(0))
        .withColumn("_cx", cell("lon"))
        .withColumn("_cy", cell("lat"))
    )
    hit = F.col("lon").between(F.col("min_lon"), F.col("max_lon")) & F.col("lat").between(
        F.col("min_lat"), F.col("max_lat")
    )
    joined = placed.join(size_checked(cells, 100_000), ["_level", "_cx", "_cy"]).where(hit)
    return joined.select(*points.columns, box_id)


def region_iou(pred_cells: DataFrame, true_cells: DataFrame, by: list[str], cell: list[str] = ("x", "y")) -> DataFrame:
    """Overlap of predicted and true cell sets per variant: IoU, precision, recall (0 when undefined).

    Both sets go through one grouped pass that marks each cell, in place of a full outer join.
    """
    by, cell = list(by), list(cell)
    marks = pred_cells.select(*by, *cell, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        true_cells.select(*by, *cell, F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    cells = marks.groupBy(*by, *cell).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    g = cells.groupBy(*by).agg(
        F.sum(F.col("p") * F.col("t")).alias("both"),
        F.sum("p").alias("pred_cells"),
        F.sum("t").alias("true_cells"),
        F.count(F.lit(1)).alias("either"),
    )

    def share(of: str) -> Column:
        return F.when(F.col(of) > 0, F.col("both") / F.col(of)).otherwise(0.0)

    return g.select(
        *by, "both", "pred_cells", "true_cells",
        share("either").alias("iou"), share("pred_cells").alias("precision"), share("true_cells").alias("recall"),
    )


def zonal_majority(pixels: DataFrame, zone: list[str], cls: str = "cls") -> DataFrame:
    """Majority class per zone (ties: lowest class), its share, and the zone's size."""
    zone = list(zone)
    counts = pixels.groupBy(*zone, cls).agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by(F.struct(cls, "n"), F.struct(-F.col("n"), F.col(cls)))
    g = counts.groupBy(*zone).agg(top.alias("_t"), F.sum("n").alias("size"))
    return g.select(
        *zone, F.col(f"_t.{cls}").alias("majority"), (F.col("_t.n") / F.col("size")).alias("share"), "size"
    )


def zonal_shares(pixels: DataFrame, zone: list[str], cls: str = "cls") -> DataFrame:
    """Share of every class per zone."""
    zone = list(zone)
    counts = pixels.groupBy(*zone, cls).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*zone).agg(F.sum("n").alias("_size"))
    return join_groups(counts, sizes, zone).select(*zone, cls, "n", (F.col("n") / F.col("_size")).alias("share"))
