"""Band maths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gain, scale and offset of the highlight-optimised stretch, and its band order.
GAIN, SCALE, OFFSET = 1.75, 0.6, 0.035
STRETCH_BANDS = {"B04": "R", "B03": "G", "B02": "B"}


def stretch(band: Column, gain: float = GAIN, scale: float = SCALE, offset: float = OFFSET) -> Column:
    """gain * cbrt(scale * band - offset); a real cube root, so dark pixels come out negative, not NaN."""
    return F.lit(gain) * F.cbrt(F.lit(scale) * band - F.lit(offset))
