"""Grids: their header, dense form, and tiles laid over each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Where cells lie: cell (r, c) covers x0 + c * res and y0 - r * res, rows going south."""

    epsg: int
    x0: float
    y0: float
    res: float
    nrows: int
    ncols: int

    def cells(self, spark: SparkSession) -> DataFrame:
        """(r, c) of every cell, made where they are used: no cell number leaves the driver."""
        n = self.nrows * self.ncols
        return spark.range(n).select(F.floor(F.col("id") / self.ncols).cast("int").alias("r"), (F.col("id") % self.ncols).cast("int").alias("c"))

    def x(self, c: Column) -> Column:
        return self.x0 + (c + 0.5) * self.res

    def y(self, r: Column) -> Column:
        return self.y0 - (r + 0.5) * self.res


def densified(cells: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """cells(r, c, ...) with a row for every place from (r0, c0) up to, without, (r1, c1): windows count rows, so holes must be rows."""
    width = c1 - c0
    every = cells.sparkSession.range((r1 - r0) * width).select((F.floor(F.col("id") / width) + r0).cast("int").alias("r"), (F.col("id") % width + c0).cast("int").alias("c"))
    inside = cells.where(F.col("r").between(r0, r1 - 1) & F.col("c").between(c0, c1 - 1))
    return every.join(inside, ["r", "c"], "left")


def mosaic(cells: DataFrame, order: Column, value: str = "z") -> DataFrame:
    """(r, c, value): of cells that lie on each other the last in the order that has a value; null where none has. One partial maximum for each place and task is shuffled."""
    return cells.groupBy("r", "c").agg(F.max_by(value, F.when(F.col(value).isNotNull(), order)).alias(value))
