import math

import pytest
from pyspark.sql import functions as F

from orograph.cli import config
from orograph.functions import aoi, projection
from orograph.functions.aoi import AOI, PRESETS


def test_preset_golden_values():
    p = PRESETS["parana"]
    assert p.tiles() == ["S26W050_FABDEM_V1-2.tif", "S26W049_FABDEM_V1-2.tif"]
    assert p.utm_epsg() == 32722
    assert p.width_km == pytest.approx(200.95158770765295, abs=1e-12)
    assert p.height_km == pytest.approx(110.57)


@pytest.mark.parametrize("lat,lon,name", [(-26, -50, "S26W050_FABDEM_V1-2.tif"), (0, 0, "N00E000_FABDEM_V1-2.tif"), (5, 100, "N05E100_FABDEM_V1-2.tif")])
def test_tile_names(spark, lat, lon, name):
    assert aoi.tile_text(lat, lon) == name
    assert spark.range(1).select(aoi.tile_name(F.lit(lat), F.lit(lon))).first()[0] == name


def test_expressions_agree_with_the_class(spark):
    boxes = [AOI("a", -50, -26, -48, -25), AOI("b", 0.25, -0.5, 2.75, 1.5), AOI("c", 179.5, 10, 180.5, 11), AOI("d", 5, 5, 5, 5), AOI("e", 10, 1, 9, 2), AOI("f", -188, 0, -186, 0)]
    frame = spark.createDataFrame([(b.name, float(b.west), float(b.south), float(b.east), float(b.north)) for b in boxes], aoi.SCHEMA)
    found = {}
    for r in aoi.tiles(frame).collect():
        found.setdefault(r.name, {})[r.ordinal] = r.tile
    for b in boxes:
        assert [found.get(b.name, {})[i] for i in range(len(b.tiles()))] == b.tiles()
    cols = [F.col(x) for x in ("west", "south", "east", "north")]
    for r in frame.select("name", aoi.utm_epsg(*cols).alias("e"), aoi.width_km(*cols).alias("w")).collect():
        b = next(x for x in boxes if x.name == r.name)
        assert r.e == b.utm_epsg()
        assert r.w == pytest.approx(b.width_km)
    assert AOI("z", 180, 0, 180, 0).utm_epsg() == 32661


def test_odd_cells(spark):
    for metres, cells in [(10, 3), (75, 3), (105, 5), (135, 5), (500, 17), (5000, 167), (25000, 833), (3e3, 101), (3e4, 1001), (3e5, 10001)]:
        assert aoi.odd_cells_of(metres, 30) == cells
        assert spark.range(1).select(aoi.odd_cells(F.lit(float(metres)), F.lit(30.0))).first()[0] == cells


def test_projection_round_trip_and_known_point(spark):
    assert projection.to_utm_number(-51.0, 0.0, 32722) == pytest.approx((500000.0, 10000000.0))
    # a point of the equator three degrees off its meridian lies 333,978.556 m east of it, by published tables
    assert projection.to_utm_number(3.0, 0.0, 32631)[0] == pytest.approx(500000.0, abs=1e-6)
    assert projection.to_utm_number(6.0, 0.0, 32631)[0] - 500000 == pytest.approx(333978.556, abs=2e-3)
    points = spark.range(400).select((F.col("id") % 20 * 0.3 - 54).alias("lon"), (F.floor(F.col("id") / 20) * 4.0 - 40).alias("lat"))
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), 32722)
    there = points.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = projection.from_utm(F.col("x"), F.col("y"), 32722)
    worst = there.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-9
    r = there.first()
    assert projection.to_utm_number(r.lon, r.lat, 32722) == pytest.approx((r.x, r.y), abs=1e-6)


@pytest.mark.parametrize("epsg", [3857, 32600, 32661, 4326])
def test_other_systems_are_refused(epsg):
    with pytest.raises(ValueError):
        projection.zone_of(epsg)


def test_target_epsg(spark):
    rows = spark.createDataFrame([(0,), (None,), (3857,)], "a int").select(aoi.target_epsg(F.col("a"), F.lit(32722))).collect()
    assert [r[0] for r in rows] == [32722, 32722, 3857]


def test_cli():
    c = config(["--bbox", "-50", "-26", "-48", "-25", "--name", "p", "--scales", "500", "5000", "25000"])
    assert c.aoi == AOI("p", -50, -26, -48, -25) and c.scales_m == {"micro": 500, "meso": 5000, "macro": 25000} and c.clip == 2.0
    assert config(["--preset", "parana"]).scales_m["macro"] == 300000.0
    for bad in (["--bbox", "1", "2", "3", "4"], [], ["--preset", "parana", "--bbox", "1", "2", "3", "4"]):
        with pytest.raises(SystemExit):
            config(bad)


def test_width_uses_the_middle_latitude():
    assert AOI("x", 0, 50, 1, 70).width_km == pytest.approx(111.32 * math.cos(math.radians(60)))
