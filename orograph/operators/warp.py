"""Reprojection: the target grid, and values taken from the source by inverse mapping."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import quoted
from ..functions.projection import from_system, to_system_number
from .grid import Grid, mosaic


def target_grid(west: float, south: float, east: float, north: float, epsg: int, res: float, steps: int = 64) -> Grid:
    """The smallest grid on multiples of res that covers the box; the box's sides are followed at `steps` points each. EPSG 4326 keeps degrees, 3857 is Web Mercator."""
    points = [(west + (east - west) * i / steps, y) for i in range(steps + 1) for y in (south, north)] + [(x, south + (north - south) * i / steps) for i in range(steps + 1) for x in (west, east)]
    xs, ys = zip(*(to_system_number(*p, epsg) for p in points))
    x0, x1, y0, y1 = math.floor(min(xs) / res), math.ceil(max(xs) / res), math.floor(min(ys) / res), math.ceil(max(ys) / res)
    return Grid(epsg, x0 * res, y1 * res, res, y1 - y0, x1 - x0)


#: Names of the methods, as raster tools have them, and how many source cells each weighs along a side.
METHODS = {"near": 1, "bilinear": 2, "cubic": 4, "cubicspline": 4, "lanczos": 6}
#: Names of the methods that take all source cells below a target cell.
AREAS = ("average", "mode", "min", "max")


def taps(u: str, method: str) -> tuple[str, list[str]]:
    """As SQL: first source cell, and the weights of the cells from there on in t, for a position u in cells (a cell's middle is at its number and a half). t is how far the position is past the middle of the last of the first half of these cells."""
    if method not in METHODS:
        raise ValueError(f"resampling is one of {', '.join([*METHODS, *AREAS])}, not {method}")
    if method == "near":
        return f"cast(floor({u}) as int)", ["1D"]
    weights = {
        "bilinear": ["1 - t", "t"],
        # Keys' kernel, a = -1/2
        "cubic": ["((2 - t) * t - 1) * t / 2", "((3 * t - 5) * t * t + 2) / 2", "((4 - 3 * t) * t + 1) * t / 2", "(t - 1) * t * t / 2"],
        # the cubic B-spline
        "cubicspline": ["(1 - t) * (1 - t) * (1 - t) / 6", "((3 * t - 6) * t * t + 4) / 6", "(((3 - 3 * t) * t + 3) * t + 1) / 6", "t * t * t / 6"],
        # sinc(x) sinc(x / 3) within three cells
        "lanczos": [f"case when abs(t + {k}) < 1e-9 then 1D else 3 * sin(pi() * (t + {k})) * sin(pi() * (t + {k}) / 3) / (pi() * pi() * (t + {k}) * (t + {k})) end" for k in (2, 1, 0, -1, -2, -3)],
    }[method]
    return f"cast(floor({u} - 0.5D) as int) - {METHODS[method] // 2 - 1}", weights


#: Source cells along a side of the squares that are kept together for the join; no less than a method reaches.
SIDE = 64


def squares(source: DataFrame, value: str, reach: int) -> DataFrame:
    """(br, bc, zs): the source in squares of SIDE cells and the `reach` rows and columns after them, as zs[row][column]; null where there is no value.

    One shuffle of the cells: rows of a square, and then the square, are put together within its task."""

    def whole(x: str, k: str) -> str:
        return f"transform(sequence(0, {SIDE + reach - 1}), i -> try_element_at(map_from_entries(collect_list(struct({k}, {x}))), i))"

    cells = source.where(F.col(value).isNotNull()).selectExpr("r", "c", f"cast({quoted(value)} as double) as z", f"explode(array_distinct(array(cast(floor(r / {SIDE}) as int), cast(floor((r - {reach}) / {SIDE}) as int)))) as br")
    cells = cells.selectExpr("r", "c", "z", "br", f"explode(array_distinct(array(cast(floor(c / {SIDE}) as int), cast(floor((c - {reach}) / {SIDE}) as int)))) as bc")
    rows = cells.selectExpr("br", "bc", f"cast(r - br * {SIDE} as int) as kr", f"cast(c - bc * {SIDE} as int) as kc", "z").repartition("br", "bc").groupBy("br", "bc", "kr").agg(F.expr(whole("z", "kc")).alias("zs"))
    return rows.groupBy("br", "bc").agg(F.expr(whole("zs", "kr")).alias("zs"))


def resampled(source: DataFrame, target: DataFrame, method: str = "cubic", value: str = "z") -> DataFrame:
    """(r, c, value) of target(r, c, u, v), u and v being its column and row position in source cells: weighted means over cells with a value, null where none has (or the weights cancel out).

    source has at most one row a place. It is cut into squares with as many cells of overlap as the method reaches, so that each target cell finds all it needs in
    one square: one equi-join of slim rows with squares, nothing to add up after it."""
    (c0, wc), (r0, wr) = taps("u", method), taps("v", method)
    n = len(wc)
    part = "{x} - 0.5D - floor({x} - 0.5D)"

    def weights(ws: list[str], x: str) -> str:
        return f"transform(array({part.format(x=x)}), t -> array({', '.join(ws)}))[0]"

    asked = target.selectExpr("r", "c", "u", "v", f"{c0} as c0", f"{r0} as r0")
    asked = asked.selectExpr("r", "c", f"cast(floor(r0 / {SIDE}) as int) as br", f"cast(floor(c0 / {SIDE}) as int) as bc", f"pmod(r0, {SIDE}) as kr", f"pmod(c0, {SIDE}) as kc", f"{weights(wr, 'v')} as wr", f"{weights(wc, 'u')} as wc")
    met = asked.join(squares(source, value, n - 1), ["br", "bc"], "left")
    met = met.selectExpr("r", "c", "wr", "wc", *(f"slice(zs[kr + {i}], kc + 1, {n}) as z{i}" for i in range(n)))
    cell = [[f"z{i}[{j}]" for j in range(n)] for i in range(n)]
    over = [f"wr[{i}] * (" + " + ".join(f"wc[{j}] * coalesce({cell[i][j]}, 0D)" for j in range(n)) + ")" for i in range(n)]
    held = [f"wr[{i}] * (" + " + ".join(f"if({cell[i][j]} is null, 0D, wc[{j}])" for j in range(n)) + ")" for i in range(n)]
    some = " or ".join(f"{cell[i][j]} is not null" for i in range(n) for j in range(n))
    sums = met.selectExpr("r", "c", " + ".join(over) + " as s", " + ".join(held) + " as w", f"({some}) as some")
    return sums.selectExpr("r", "c", f"case when some and abs(w) > 1e-9 then s / w end as {quoted(value)}")


def covered(source: DataFrame, target: DataFrame, method: str, value: str = "z") -> DataFrame:
    """(r, c, value) of target(r, c, u, v, du, dv), whose cells are boxes of du by dv source cells around u, v: the average weighed by area, the value of most area (the least of several), the
    least or the largest, of source cells with a value that the box meets; null without one. One equi-join of boxes' places with source cells, then sums for each target cell."""
    boxes = target.selectExpr("r", "c", "u - du / 2 as u0", "u + du / 2 as u1", "v - dv / 2 as v0", "v + dv / 2 as v1")
    rows = boxes.selectExpr("*", "explode(sequence(cast(floor(v0) as int), cast(greatest(floor(v0), ceil(v1) - 1) as int))) as sr")
    places = rows.selectExpr("*", "explode(sequence(cast(floor(u0) as int), cast(greatest(floor(u0), ceil(u1) - 1) as int))) as sc")
    places = places.selectExpr("r", "c", "sr", "sc", "(least(u1, sc + 1D) - greatest(u0, cast(sc as double))) * (least(v1, sr + 1D) - greatest(v0, cast(sr as double))) as w")
    cells = source.where(F.col(value).isNotNull()).select(F.col("r").alias("sr"), F.col("c").alias("sc"), F.col(value).cast("double").alias("z"))
    met = places.join(cells, ["sr", "sc"], "left").selectExpr("r", "c", "if(w > 1e-9, z, null) as z", "w")
    if method == "mode":
        by_value = met.groupBy("r", "c", "z").agg(F.sum("w").alias("w"))
        found = F.expr("max_by(z, if(z is null, null, struct(round(w, 9) as w, -z as z)))")
        return by_value.groupBy("r", "c").agg(found.alias(value))
    found = {"average": "sum(w * z) / sum(if(z is null, null, w))", "min": "min(z)", "max": "max(z)"}[method]
    return met.groupBy("r", "c").agg(F.expr(found).alias(value))


def positions(grid: Grid, cells: DataFrame, source: Grid, sizes: bool = False) -> DataFrame:
    """target(r, c, u, v) of a grid's cells over a source grid in degrees; rounded to a millionth of a cell, so that positions on cell borders don't hang on the last bit. sizes: also du, dv, a cell's width and height in source cells, through its middle."""

    def place(across: float, down: float) -> tuple[Column, Column]:
        lon, lat = from_system(grid.x(F.col("c") + across), grid.y(F.col("r") + down), grid.epsg)
        return F.round((lon - source.x0) / source.res, 6), F.round((source.y0 - lat) / source.res, 6)

    u, v = place(0, 0)
    made = {"u": u, "v": v}
    if sizes:
        made |= {"du": F.abs(place(0.5, 0)[0] - place(-0.5, 0)[0]), "dv": F.abs(place(0, 0.5)[1] - place(0, -0.5)[1])}
    return cells.select("r", "c", *(x.alias(n) for n, x in made.items()))


def mosaic_and_warp(tiles: DataFrame, source: Grid, epsg: int, res: float, method: str = "cubic", value: str = "z") -> tuple[DataFrame, Grid]:
    """tiles(r, c, ordinal, value) of one grid in degrees, laid over each other and brought onto the grid of a system (UTM on WGS84, 3857, 4326) that covers them."""
    south, east = source.y0 - source.nrows * source.res, source.x0 + source.ncols * source.res
    grid = target_grid(source.x0, south, east, source.y0, epsg, res)
    laid, target = mosaic(tiles, F.col("ordinal"), value), positions(grid, grid.cells(tiles.sparkSession), source, method in AREAS)
    return (covered if method in AREAS else resampled)(laid, target, method, value), grid
