"""Three deviations as one colour image."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import stretched, valid

#: The labels that give red, green and blue.
ARTWORK_RGB = ("macro", "meso", "micro")


def valid_all(columns: list[Column]) -> Column:
    """A cell is drawn if it is valid in all channels."""
    return reduce(lambda a, b: a & b, map(valid, columns))


def rgb_composite(cells: DataFrame, order: tuple[str, str, str] = ARTWORK_RGB, clip: float = 2.0) -> DataFrame:
    """cells and red, green, blue (0 to 255; 0 where a channel is invalid) and alpha (255 or 0), from dev_<label> of the three labels."""
    missing = [x for x in order if f"dev_{x}" not in cells.columns]
    if missing:
        raise KeyError(", ".join(missing))
    drawn = valid_all([F.col(f"dev_{x}") for x in order])
    zero = F.lit(0).cast("smallint")
    bands = {band: F.when(drawn, stretched(F.col(f"dev_{x}"), clip)).otherwise(zero) for band, x in zip(("red", "green", "blue"), order)}
    return cells.withColumns(bands | {"alpha": F.when(drawn, F.lit(255)).otherwise(F.lit(0)).cast("smallint")})


def joined_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """dev_<label> columns of separately kept layers(r, c, dev), by place; places that a layer lacks drop out."""
    named = [d.select("r", "c", F.col("dev").alias(f"dev_{x}")) for x, d in layers.items()]
    return reduce(lambda a, b: a.join(b, ["r", "c"]), named)
