"""Which of an area's tiles are there."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.aoi import AOI, TILE_SUFFIX, tiles

log = logging.getLogger("orograph")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(tile, path) of the tile files below a folder of any store that Spark reads; contents stay unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{TILE_SUFFIX}").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("tile"), "path")


def present(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """The wanted tiles (column tile) that are there, with what `there` says of them."""
    return wanted.join(there, "tile")


def missing(wanted: DataFrame, there: DataFrame) -> DataFrame:
    return wanted.join(there, "tile", "left_anti")


def fetch_tiles(spark: SparkSession, aoi: AOI, folder: str) -> DataFrame:
    """(tile, ordinal, path) of the area's tiles that are there, in the area's order; what is there and what isn't (open sea) is logged, nothing at all is an error.

    Tasks read tiles where they are, in any store: copying them to one machine first would not serve a cluster."""
    wanted, there = tiles(aoi.frame(spark)).select("tile", "ordinal"), listing(spark, folder)
    ready = present(wanted, there)
    absent = [r.tile for r in missing(wanted, there).orderBy("ordinal").collect()]
    n = ready.count()
    log.info("%s: %d of %d tiles are there", aoi.name, n, n + len(absent))
    if absent:
        log.warning("%s: no file for %s", aoi.name, ", ".join(absent))
    if not n:
        raise RuntimeError(f"no tile of {aoi.name} is below {folder}")
    return ready
