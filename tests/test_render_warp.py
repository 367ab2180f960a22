import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.functions.cells import stretched, valid, without_nodata
from orograph.operators import render, warp
from orograph.operators.grid import Grid


def test_stretch_golden_values(spark):
    rows = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (-2.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "d double")
    assert [r[0] for r in rows.select(stretched(F.col("d"), 2.0)).collect()] == [0, 64, 128, 255, 255, 0, 0, 0]
    assert [r[0] for r in rows.select(valid(F.col("d"))).collect()] == [True] * 5 + [False] * 3


def test_stretch_is_single_precision_with_ties_to_even(spark):
    d = np.concatenate([(np.arange(511) / 510 * 2).astype("f4"), np.random.default_rng(0).uniform(-3, 3, 2000).astype("f4")])
    for clip in (2.0, 1.7):
        want = np.round(np.clip(np.abs(d), np.float32(0), np.float32(clip)) / np.float32(clip) * np.float32(255)).astype(int)
        found = spark.createDataFrame([(i, float(x)) for i, x in enumerate(d)], "i int, d double").select("i", stretched(F.col("d"), clip).alias("b")).orderBy("i").collect()
        assert [r.b for r in found] == want.tolist()


@pytest.mark.parametrize("clip", [0.0, -2.0, float("inf"), float("nan")])
def test_clip_is_checked(clip):
    with pytest.raises(ValueError):
        stretched(None, clip)


def test_one_invalid_channel_blanks_all(spark):
    rows = spark.createDataFrame([(0, 2.0, 0.0, 0.0), (1, 2.0, None, 2.0), (2, 0.0, 0.0, 0.0), (3, 2.0, -2.0, 2.0)], "r int, dev_micro double, dev_meso double, dev_macro double")
    found = [tuple(r) for r in render.rgb_composite(rows).orderBy("r").select("red", "green", "blue", "alpha").collect()]
    assert found == [(0, 0, 255, 255), (0, 0, 0, 0), (0, 0, 0, 255), (255, 255, 255, 255)]
    with pytest.raises(KeyError):
        render.rgb_composite(rows.drop("dev_meso"))


def test_nodata(spark):
    rows = spark.createDataFrame([(-9999.0,), (1.5,)], "z float")
    assert [r[0] for r in rows.select(without_nodata(F.col("z"))).collect()] == [None, 1.5]


def test_target_grid_lies_on_multiples():
    g = warp.target_grid(-50, -26, -48, -25, 32722, 30.0)
    assert g.x0 % 30 == 0 and g.y0 % 30 == 0 and 6500 < g.ncols < 7000 and 3600 < g.nrows < 3900
    assert warp.target_grid(0.1, 0.1, 0.9, 0.9, 4326, 0.25) == Grid(4326, 0.0, 1.0, 0.25, 4, 4)


def kernel(x):
    x = abs(x)
    return 1.5 * x**3 - 2.5 * x**2 + 1 if x <= 1 else -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0.0


KERNELS = {
    "bilinear": (1, lambda x: max(0.0, 1 - abs(x))),
    "cubic": (2, kernel),
    "cubicspline": (2, lambda x: (abs(x) ** 3 / 2 - x**2 + 2 / 3) if abs(x) < 1 else (2 - abs(x)) ** 3 / 6 if abs(x) < 2 else 0.0),
    "lanczos": (3, lambda x: float(np.sinc(x) * np.sinc(x / 3)) if abs(x) < 3 else 0.0),
}


@pytest.mark.parametrize("side", [64, 6])
@pytest.mark.parametrize("method", ["near", *KERNELS])
def test_resampling_against_brute_force(spark, monkeypatch, method, side):
    monkeypatch.setattr(warp, "SIDE", side)
    rng = np.random.default_rng(3)
    z = rng.normal(100, 10, (9, 8))
    z[rng.random(z.shape) < 0.15] = np.nan
    source = spark.createDataFrame([(r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(9) for c in range(8)], "r int, c int, z double")
    at = [(i, 0, float(u), float(v)) for i, (u, v) in enumerate(rng.uniform(-2, 11, (60, 2)))]
    found = {r.r: r.z for r in warp.resampled(source, spark.createDataFrame(at, "r int, c int, u double, v double"), method).collect()}
    assert len(found) == 60
    for i, _, u, v in at:
        if method == "near":
            taps = {(int(np.floor(v)), int(np.floor(u))): 1.0}
        else:
            reach, weight = KERNELS[method]
            r0, c0 = int(np.floor(v - 0.5)), int(np.floor(u - 0.5))
            taps = {(r, c): weight(v - 0.5 - r) * weight(u - 0.5 - c) for r in range(r0 - reach + 1, r0 + reach + 1) for c in range(c0 - reach + 1, c0 + reach + 1)}
        have = {k: w for k, w in taps.items() if 0 <= k[0] < 9 and 0 <= k[1] < 8 and not np.isnan(z[k])}
        if not have or abs(sum(have.values())) <= 1e-9:
            assert found[i] is None
        else:
            assert found[i] == pytest.approx(sum(w * z[k] for k, w in have.items()) / sum(have.values()), abs=1e-6)


@pytest.mark.parametrize("method", warp.AREAS)
def test_areas_against_brute_force(spark, method):
    rng = np.random.default_rng(4)
    z = rng.integers(0, 4, (9, 8)).astype(float)
    z[rng.random(z.shape) < 0.3] = np.nan
    source = spark.createDataFrame([(r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(9) for c in range(8)], "r int, c int, z double")
    at = [(i, 0, *(float(round(x, 3)) for x in (u, v, du, dv))) for i, (u, v, du, dv) in enumerate(zip(rng.uniform(-2, 10, 60), rng.uniform(-2, 11, 60), rng.uniform(0.3, 4, 60), rng.uniform(0.3, 4, 60)))]
    at += [(60, 0, 2.0, 2.0, 2.0, 2.0), (61, 0, 2.5, 2.5, 1.0, 1.0)]
    found = {r.r: r.z for r in warp.covered(source, spark.createDataFrame(at, "r int, c int, u double, v double, du double, dv double"), method).collect()}
    assert len(found) == 62
    for i, _, u, v, du, dv in at:
        weights = {}
        for r in range(9):
            for c in range(8):
                w = max(0.0, min(u + du / 2, c + 1) - max(u - du / 2, c)) * max(0.0, min(v + dv / 2, r + 1) - max(v - dv / 2, r))
                if w > 1e-9 and not np.isnan(z[r, c]):
                    weights[z[r, c]] = weights.get(z[r, c], 0) + w
        if not weights:
            assert found[i] is None
        elif method == "average":
            assert found[i] == pytest.approx(sum(k * w for k, w in weights.items()) / sum(weights.values()))
        else:
            assert found[i] == {"min": min(weights), "max": max(weights), "mode": min(weights, key=lambda k: (-round(weights[k], 9), k))}[method]


def test_coarse_cells_take_averages(spark):
    source = Grid(4326, -50.0, -25.0, 0.01, 40, 40)
    tiles = spark.range(1600).select(F.floor(F.col("id") / 40).cast("int").alias("r"), (F.col("id") % 40).cast("int").alias("c"), F.lit(0).alias("ordinal"), (F.col("id") % 2).cast("double").alias("z"))
    found, g = warp.mosaic_and_warp(tiles, source, 32722, 8000.0, "average")
    inside = found.join(warp.positions(g, g.cells(spark), source), ["r", "c"]).where("u between 5 and 35 and v between 5 and 35")
    assert inside.count() > 5 and inside.where("abs(z - 0.5) > 0.1").isEmpty()


def test_other_methods_are_refused():
    with pytest.raises(ValueError):
        warp.taps("u", "median")


@pytest.mark.parametrize("epsg", [32722, 3857])
def test_plane_survives_the_warp(spark, epsg):
    source = Grid(4326, -50.0, -25.0, 0.01, 40, 40)
    tiles = spark.range(1600).select(F.floor(F.col("id") / 40).cast("int").alias("r"), (F.col("id") % 40).cast("int").alias("c"), F.lit(0).alias("ordinal"), (F.floor(F.col("id") / 40) * 2 + F.col("id") % 40).cast("double").alias("z"))
    found, g = warp.mosaic_and_warp(tiles, source, epsg, 2000.0)
    placed = found.join(warp.positions(g, g.cells(spark), source), ["r", "c"]).where("u between 3 and 37 and v between 3 and 37")
    assert placed.count() > 200
    assert placed.select(F.max(F.abs(F.col("z") - ((F.col("v") - 0.5) * 2 + F.col("u") - 0.5)))).first()[0] < 1e-6
    assert found.count() == g.nrows * g.ncols
