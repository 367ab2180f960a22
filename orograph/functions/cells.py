"""Values of cells: NoData, validity, and the stretch from a deviation to a byte."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .aoi import NODATA


def quoted(name: str) -> str:
    """A column's name in SQL."""
    return "`" + name.replace("`", "``") + "`"


def without_nodata(z: Column, nodata: float | Column = NODATA) -> Column:
    """NoData becomes null."""
    return F.nullif(z, (nodata if isinstance(nodata, Column) else F.lit(nodata)).cast("float"))


def valid(v: Column) -> Column:
    """True for finite values: not null, NaN or infinite."""
    return F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))


def stretched(dev: Column, clip: float) -> Column:
    """|dev| cut at clip, as 0 to 255; invalid values give 0.

    In single precision, with ties to even: each product is cut back to float before the next step. Validity is asked first, since NaN and null
    would pass a least() at full brightness."""
    if not (math.isfinite(clip) and clip > 0):
        raise ValueError("clip must be finite and positive")
    share = (F.least(F.abs(dev.cast("float")), F.lit(clip).cast("float")) / F.lit(clip).cast("float")).cast("float")
    return F.when(valid(dev), F.rint((share * F.lit(255.0).cast("float")).cast("float").cast("double")).cast("smallint")).otherwise(F.lit(0).cast("smallint"))
