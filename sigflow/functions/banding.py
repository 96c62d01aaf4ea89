"""Generation band of an hourly mean power."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigflow.schemas import BAND_ABOVE, BANDS


def generation_band(power: Column | str) -> Column:
    """The first band whose upper bound lies above the power; null, NaN (which
    sorts above every number) and powers past the last bound are in none."""
    p = F.col(power) if isinstance(power, str) else power
    label = F.when(F.lit(False), "")
    for below, name in BANDS:
        label = label.when(p < below, name)
    return label.otherwise(BAND_ABOVE)
