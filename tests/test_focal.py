import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.operators import focal, grid

SHAPE = (23, 17)


def frame(spark, z):
    rows = [(r, c, None if z[r][c] is None or z[r][c] != z[r][c] else z[r][c].item() if hasattr(z[r][c], "item") else z[r][c]) for r in range(len(z)) for c in range(len(z[0]))]
    whole = all(isinstance(x[2], int) or x[2] is None for x in rows)
    return spark.createDataFrame(rows, f"r int, c int, z {'long' if whole else 'double'}")


def brute(z, h):
    out = np.full(z.shape, np.nan)
    for r in range(z.shape[0]):
        for c in range(z.shape[1]):
            box = z[max(0, r - h) : r + h + 1, max(0, c - h) : c + h + 1]
            box = box[~np.isnan(box)]
            if not np.isnan(z[r, c]):
                out[r, c] = (z[r, c] - box.mean()) / box.std() if box.std() > 1e-12 else 0.0
    return out


def got(df, name):
    out = np.full(SHAPE, np.nan)
    for r in df.select("r", "c", name).collect():
        out[r.r, r.c] = np.nan if r[2] is None else r[2]
    return out


@pytest.mark.parametrize("holes", [False, True])
@pytest.mark.parametrize("whole", [False, True])
def test_dev_against_brute_force(spark, holes, whole):
    rng = np.random.default_rng(1)
    z = rng.integers(-500, 500, SHAPE).astype(float) if whole else rng.normal(1000, 3, SHAPE)
    if holes:
        z[rng.random(SHAPE) < 0.2] = np.nan
    values = [[None if np.isnan(x) else int(x) if whole else float(x) for x in row] for row in z]
    found = focal.dev(frame(spark, values), {"a": 1, "b": 4, "c": 40})
    for label, h in (("a", 1), ("b", 4), ("c", 40)):
        np.testing.assert_allclose(got(found, f"dev_{label}"), brute(z, h), atol=1e-9)


def test_shift_sign_and_scale(spark):
    rng = np.random.default_rng(2)
    z = rng.integers(0, 90, SHAPE)
    dev = lambda a: got(focal.dev(frame(spark, a.tolist()), {"x": 2}), "dev_x")
    base = dev(z)
    np.testing.assert_allclose(dev(z + 1000), base, atol=1e-12)
    np.testing.assert_allclose(dev(-z), -base, atol=1e-12)
    np.testing.assert_allclose(dev(z * 7), base, atol=1e-12)


def test_special_surfaces(spark):
    flat = got(focal.dev(frame(spark, np.full(SHAPE, 5).tolist()), {"x": 3}), "dev_x")
    assert (flat == 0).all()
    plane = np.add.outer(np.arange(SHAPE[0]) * 3, np.arange(SHAPE[1]) * 2)
    inner = got(focal.dev(frame(spark, plane.tolist()), {"x": 2}), "dev_x")[2:-2, 2:-2]
    np.testing.assert_allclose(inner, 0, atol=1e-12)
    ridge = np.zeros(SHAPE, int)
    ridge[:, 8] = 10
    d = got(focal.dev(frame(spark, ridge.tolist()), {"x": 2}), "dev_x")
    assert (d[:, 8] > 0).all() and (d[:, 7] < 0).all()


def test_peak_golden_value(spark):
    z = np.zeros((3, 3), int)
    z[1, 1] = 10
    r = focal.dev(frame(spark, z.tolist()), {"x": 1}).where("r = 1 and c = 1").first()
    assert r.dev_x == pytest.approx(2.8284271247461903, abs=1e-12)


def test_large_values_use_decimals(spark):
    z = np.array([[3_000_000_000, -3_000_000_000], [2_999_999_999, 0]])
    found = focal.dev(frame(spark, z.tolist()), {"x": 1}).orderBy("r", "c").collect()
    np.testing.assert_allclose([r.dev_x for r in found], ((z - z.mean()) / z.std()).ravel(), atol=1e-9)


def test_plan_has_two_exchanges_for_all_scales(spark):
    z = frame(spark, np.zeros((4, 4), int).tolist())
    plan = focal.dev(z, {"a": 1, "b": 2, "c": 3}, most=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_cells_variant_makes_widths_odd(spark):
    z = frame(spark, np.arange(25).reshape(5, 5).tolist())
    a = focal.multiscale_dev_cells(z, {"x": 2, "y": 4}).orderBy("r", "c").collect()
    b = focal.multiscale_dev_cells(z, {"x": 3, "y": 5}).orderBy("r", "c").collect()
    assert a == b and all(r.dev_abs_x == abs(r.dev_x) for r in a)


def test_metres_to_cells(spark):
    z = frame(spark, np.arange(25).reshape(5, 5).tolist())
    assert focal.multiscale_dev(z, {"w": 105.0}, 30.0).collect() == focal.dev(z, {"w": 2}).collect()


def test_densify_and_mosaic(spark):
    sparse = spark.createDataFrame([(0, 0, 1), (1, 2, 5), (9, 9, 9)], "r int, c int, z int")
    dense = grid.densified(sparse, 0, 2, 0, 3)
    assert dense.count() == 6 and dense.where("z is not null").count() == 2
    laid = spark.createDataFrame([(0, 0, 1, 1.0), (0, 0, 2, 2.0), (0, 0, 3, None), (1, 1, 1, None)], "r int, c int, o int, z double")
    assert sorted((r.r, r.z) for r in grid.mosaic(laid, F.col("o")).collect()) == [(0, 2.0), (1, None)]


def test_empty_grid(spark):
    assert focal.dev(spark.createDataFrame([], "r int, c int, z double"), {"x": 1}).count() == 0
