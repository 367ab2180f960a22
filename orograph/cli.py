"""python -m orograph.cli --preset parana --tiles-dir DIR --out DIR"""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from pyspark.sql import SparkSession

from .functions.aoi import AOI, PRESETS
from .plans.terrain import DEFAULT_SCALES_M, Config, run


def config(argv: list[str] | None = None) -> Config:
    parser = argparse.ArgumentParser(prog="orograph", description="Colour image of deviations from the mean elevation at three scales.")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--preset", choices=sorted(PRESETS))
    where.add_argument("--bbox", nargs=4, type=float, metavar=("W", "S", "E", "N"), help="degrees")
    parser.add_argument("--name", help="name of the --bbox area")
    parser.add_argument("--res", type=float, default=30.0, help="cell size in metres")
    parser.add_argument("--epsg", type=int, help="UTM zone on WGS84; default: the area's own")
    parser.add_argument("--scales", nargs=3, type=float, metavar=("MICRO", "MESO", "MACRO"), help="window widths in metres, drawn blue, green, red")
    parser.add_argument("--clip", type=float, default=2.0, help="deviation of full brightness")
    parser.add_argument("--tiles-dir", default="data/raw")
    parser.add_argument("--work-dir", default="data/interim")
    parser.add_argument("--out", default="data/out")
    args = parser.parse_args(argv)
    if args.bbox and not args.name:
        parser.error("--bbox needs --name")
    area = PRESETS[args.preset] if args.preset else AOI(args.name, *args.bbox)
    scales = dict(zip(DEFAULT_SCALES_M, args.scales)) if args.scales else dict(DEFAULT_SCALES_M)
    return Config(area, args.res, args.epsg, scales, args.clip, tiles_dir=args.tiles_dir, work_dir=args.work_dir, out_dir=Path(args.out))


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    run(SparkSession.builder.getOrCreate(), config(argv))


if __name__ == "__main__":
    main()
