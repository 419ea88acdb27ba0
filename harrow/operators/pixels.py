"""Band maths and composites over pixel tables pixels(scene_ts, x, y, <bands>, dataMask)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions.bands import GAIN, OFFSET, SCALE, STRETCH_BANDS, stretch
from harrow.operators.ordered import exact_quantiles, has_hot_group, join_groups
from harrow.session import hot_rows as session_hot_rows


def highlight(df: DataFrame, gain: float = GAIN, scale: float = SCALE, offset: float = OFFSET, keep=("scene_ts", "x", "y")) -> DataFrame:
    """Stretched R, G, B and the mask band, which passes through: masked pixels are not blanked."""
    return df.select(
        *[c for c in keep if c in df.columns],
        *[stretch(F.col(b), gain, scale, offset).alias(o) for b, o in STRETCH_BANDS.items()],
        F.col("dataMask").alias("mask"),
    )


def mask(df: DataFrame, mask_col: str, bands: list[str]) -> DataFrame:
    """Bands set to null where the mask is not 1 (our definition of applying the mask)."""
    return df.withColumns({b: F.when(F.col(mask_col) == 1, F.col(b)) for b in bands})


def composite(pixels: DataFrame, bands: list[str], how: str = "median", period: str = "period", hot_rows=None) -> DataFrame:
    """One value per (x, y, period) and band over the unmasked scenes, plus the number of clear scenes.

    Our definition: `how` is median, mean or max; a cell with no clear scene has null bands and clear = 0.
    """
    by = ["x", "y", period]
    clear = mask(pixels, "dataMask", bands)
    count = F.sum((F.col("dataMask") == 1).cast("long")).alias("clear")
    if how in ("mean", "max"):
        agg = F.avg if how == "mean" else F.max
        return clear.groupBy(*by).agg(*[agg(b).alias(b) for b in bands], count)
    if how != "median":
        raise ValueError("how is 'median', 'mean' or 'max'")
    limit = session_hot_rows(pixels.sparkSession) if hot_rows is None else hot_rows
    if not has_hot_group(pixels, by, limit):
        return clear.groupBy(*by).agg(*[F.median(b).alias(b) for b in bands], count)
    # A hot cell: medians through counted values, one long row per band.
    long = clear.unpivot(by, bands, "band", "v").where(F.col("v").isNotNull())
    medians = exact_quantiles(long, [*by, "band"], "v", {"m": 0.5}, hot_rows=limit)
    bands_wide = medians.groupBy(*by).pivot("band", bands).agg(F.max("m"))
    counts = clear.groupBy(*by).agg(count)
    return join_groups(counts, bands_wide, by, "left").select(*by, *bands, "clear")
