"""Multiscale terrain analysis on Spark DataFrames of grid cells."""

from .functions.aoi import AOI, PRESETS
from .operators.focal import multiscale_dev, multiscale_dev_cells
from .operators.render import rgb_composite
from .operators.warp import mosaic_and_warp
from .plans.terrain import Config, layers_of_file, run
from .sources.tiles import fetch_tiles

__all__ = ["AOI", "PRESETS", "Config", "fetch_tiles", "layers_of_file", "mosaic_and_warp", "multiscale_dev", "multiscale_dev_cells", "rgb_composite", "run"]
