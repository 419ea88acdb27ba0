"""Regions of grid cells: labelling by tiles whose seams are merged, and the match of predicted with true regions.

A tile is labelled by itself, in a task that goes through many and holds a batch of rows and one tile. Cells on the two sides of a seam link the regions of their
tiles; the components of these links join them. A region's name is its smallest cell (by x, then y), so names do not depend on the tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.operators.graph import connected, unsent
from harrow.operators.ordered import join_groups
from harrow.session import written

TILE = 256
#: An overlap above this share of the union can hold for one partner only.
MATCH = 0.5


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes by the edges (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_regions(x: np.ndarray, y: np.ndarray, first: np.ndarray, tile: int, diagonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """(x, y) of the smallest cell of each cell's region inside its tile.

    Distinct cells of many tiles one after another, each tile's by x, then y; `first` marks the first cell of each.
    """
    # Places of two tiles, or of two rows of one, are never neighbours.
    span = tile + 2
    code = (np.cumsum(first) - 1) * (span * span) + np.mod(x, tile) * span + np.mod(y, tile)
    a, b = [], []
    for step in (1, span, *((span - 1, span + 1) if diagonal else ())):
        at = np.minimum(np.searchsorted(code, code + step), len(code) - 1)
        i = np.flatnonzero(code[at] == code + step)
        a.append(i)
        b.append(at[i])
    root = roots(len(x), np.concatenate(a), np.concatenate(b))
    return x[root], y[root]


def _label_tiles(tile: int, diagonal: bool):
    """Labels the tiles of sorted rows, all tiles that a batch completes at once; holds a batch and a tile at most."""

    def labelled(held: pa.Table) -> list[pa.RecordBatch]:
        x, y, n = (held.column(c).to_numpy() for c in ("_x", "_y", "_n"))
        rx, ry = tile_regions(x, y, n == 1, tile, diagonal)
        return held.drop_columns(["_n"]).append_column("_rx", pa.array(rx)).append_column("_ry", pa.array(ry)).to_batches()

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(batch.column("_n").to_numpy() == 1)
            cut = int(starts[-1]) if len(starts) else 0
            if len(starts) and (held or cut):
                yield from labelled(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from labelled(pa.Table.from_batches(held))

    return run


def label_regions(cells: DataFrame, by: list[str], cell: list[str] = ("x", "y"), tile: int = TILE, diagonal: bool = False) -> DataFrame:
    """Distinct cells with their region: (*by, x, y, region_x, region_y), the region's smallest cell.

    Cells touch by sides, with `diagonal` also by corners, within one group of `by` (null is a group like any other). Repeated
    cells count once; cells without x or y are left out. Other columns are not read.
    """
    by, (cx, cy) = list(by), cell
    named = cells.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(cx).cast("long").alias("_x"), F.col(cy).cast("long").alias("_y"))
    groups = [f"_by{i}" for i in range(len(by))]
    tiles = [F.floor(F.col(c) / tile).cast("long").alias(t) for c, t in (("_x", "_tx"), ("_y", "_ty"))]
    distinct = named.where("_x is not null and _y is not null").distinct().select("*", *tiles)

    # The number of a cell in its tile shows where a tile begins.
    order = Window.partitionBy(*groups, "_tx", "_ty").orderBy("_x", "_y")
    sorted_tiles = distinct.withColumn("_n", F.row_number().over(order)).select(*groups, "_x", "_y", "_n")
    fields = [f for f in sorted_tiles.schema.fields if f.name != "_n"]
    schema = T.StructType([*fields, T.StructField("_rx", T.LongType()), T.StructField("_ry", T.LongType())])
    local = written(sorted_tiles.mapInArrow(_label_tiles(tile, diagonal), schema), "tiles")
    node = F.struct(*groups, F.col("_rx").alias("x"), F.col("_ry").alias("y"))

    # Only cells at a border have a partner in another tile: they ask for it, and it is at a border, too.
    last = lambda c: F.pmod(F.col(c), F.lit(tile)) == tile - 1
    first = lambda c: F.pmod(F.col(c), F.lit(tile)) == 0
    border = local.where(last("_x") | first("_x") | last("_y") | first("_y"))
    steps = [(1, 0, last("_x")), (0, 1, last("_y"))]
    if diagonal:
        steps += [(1, 1, last("_x") | last("_y")), (1, -1, last("_x") | first("_y"))]
    asks = [F.when(at, F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))) for dx, dy, at in steps]
    asking = border.withColumn("_to", F.explode(F.array_compact(F.array(*asks))))
    asking = asking.select(*groups, (F.col("_x") + F.col("_to.dx")).alias("_x"), (F.col("_y") + F.col("_to.dy")).alias("_y"), node.alias("a"))
    seams = join_groups(asking, unsent(border.select(*groups, "_x", "_y", node.alias("b"))), [*groups, "_x", "_y"]).select("a", "b").distinct()
    joined = connected(written(seams, "seams"))

    out = local.select("*", node.alias("node")).join(unsent(joined), "node", "left")
    region = F.coalesce("component", "node")
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], F.col("_x").alias(cx), F.col("_y").alias(cy), region["x"].alias("region_x"), region["y"].alias("region_y"))


def region_overlaps(pred: DataFrame, true: DataFrame, by: list[str], cell: list[str] = ("x", "y")) -> DataFrame:
    """Predicted regions beside the true ones they share cells with, from two label tables: cells of each, of both, and IoU.

    A region without a partner has one row, with null in place of the partner and 0 for what they share.
    """
    by, cell = list(by), list(cell)
    sides = ("pred", "true")
    label = lambda df, side: df.select(*by, *cell, *[(F.col(f"region_{c}") if s == side else F.lit(None).cast("long")).alias(f"_{s}_{c}") for s in sides for c in "xy"])
    # One grouped pass marks each cell with both labels, in place of a full outer join. A cell has one label at most per side.
    marks = label(pred, "pred").unionByName(label(true, "true"))
    both = marks.groupBy(*by, *cell).agg(*[F.max(f"_{s}_{c}").alias(f"_{s}_{c}") for s in sides for c in "xy"])
    struct = lambda s: F.when(F.col(f"_{s}_x").isNotNull(), F.struct(F.col(f"_{s}_x").alias("x"), F.col(f"_{s}_y").alias("y"))).alias(s)
    both = both.select(*by, *map(struct, sides))
    pairs = written(both.groupBy(*by, "pred", "true").agg(F.count(F.lit(1)).alias("both")), "overlaps")
    size = lambda side: pairs.where(F.col(side).isNotNull()).groupBy(*by, side).agg(F.sum("both").alias(f"{side}_cells"), F.max((F.col("pred").isNotNull() & F.col("true").isNotNull())).alias(f"{side}_met"))
    sized = join_groups(join_groups(pairs, unsent(size("pred")), [*by, "pred"], "left"), unsent(size("true")), [*by, "true"], "left")
    # Cells that only one side has make a row only for regions that meet nobody.
    met = F.col("pred").isNotNull() & F.col("true").isNotNull()
    alone = (F.col("true").isNull() & ~F.col("pred_met")) | (F.col("pred").isNull() & ~F.col("true_met"))
    shared = F.when(met, F.col("both")).otherwise(0)
    cells = [F.coalesce(c, F.lit(0)).alias(c) for c in ("pred_cells", "true_cells")]
    union = F.coalesce("pred_cells", F.lit(0)) + F.coalesce("true_cells", F.lit(0)) - shared
    place = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("pred", "true") for c in "xy"]
    return sized.where(met | alone).select(*by, *place, *cells, shared.cast("long").alias("both"), (shared / union).alias("iou"))


def region_scores(overlaps: DataFrame, by: list[str]) -> DataFrame:
    """Per group: predicted and true regions, matches (IoU above one half, so one to one), precision, recall, F1, mean IoU of the matches,
    true regions split over several predicted ones, predicted regions that merge several true ones.

    Scores are 0 where undefined.
    """
    by = list(by)
    met = F.col("pred_x").isNotNull() & F.col("true_x").isNotNull()
    matched = met & (F.col("iou") > MATCH)
    side = lambda s: F.when(F.col(f"{s}_x").isNotNull(), F.struct(f"{s}_x", f"{s}_y"))
    rows = overlaps.select(*by, side("pred").alias("pred"), side("true").alias("true"), met.alias("met"), matched.alias("matched"), F.col("iou"))
    rows = written(rows, "matches")  # read three times

    def per(s: str, name: str) -> DataFrame:
        each = rows.where(F.col(s).isNotNull()).groupBy(*by, s).agg(F.sum(F.col("met").cast("long")).alias("partners"))
        return each.groupBy(*by).agg(F.count(F.lit(1)).alias(f"{s}_regions"), F.sum((F.col("partners") > 1).cast("long")).alias(name))

    total = rows.groupBy(*by).agg(F.sum(F.col("matched").cast("long")).alias("matches"), F.avg(F.when(F.col("matched"), F.col("iou"))).alias("mean_iou"))
    whole = join_groups(join_groups(total, per("pred", "merged"), by, "left"), per("true", "split"), by, "left")
    count = lambda c: F.coalesce(c, F.lit(0))

    def share(over: Column, of: Column) -> Column:
        return F.when(of > 0, over / of).otherwise(0.0)

    p, t = count("pred_regions"), count("true_regions")
    return whole.select(
        *by, p.alias("pred_regions"), t.alias("true_regions"), "matches", share(F.col("matches"), p).alias("precision"), share(F.col("matches"), t).alias("recall"),
        share(2.0 * F.col("matches"), p + t).alias("f1"), F.coalesce("mean_iou", F.lit(0.0)).alias("mean_iou"), count("split").alias("split"), count("merged").alias("merged"),
    )
