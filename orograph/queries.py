"""The terrain queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import aoi, cells, projection
from .operators import focal, grid, render, warp
from .sources import geotiff, png, tiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Stand-ins for rasters and areas

#: Largest |z| of the embeddings' grid (values within -1 to 1, times 10,000).
EMB_MOST = 10_000
HALVES = {"micro": 2, "meso": 8, "macro": 31}
EMB = """emb as (
  select vec_id::int as r, (i - 1)::int as c, case when (vec_id * 64 + i - 1) % 37 = 0 then null else cast(round(embedding[i]::double * 10000) as bigint) end as z
  from embeddings, unnest(range(1, 65)) as u(i))"""


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as a grid: a row for each vector, a column for each of its 64 numbers, and regular holes."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("r"), F.posexplode("embedding").alias("c", "x"))
    return rows.select("r", "c", F.when((F.col("r").cast("long") * 64 + F.col("c")) % 37 != 0, F.round(F.col("x").cast("double") * 10000).cast("long")).alias("z"))


AREAS = """areas as (
  select c_custkey as id, ((c_custkey * 37) % 1400) / 4.0::double - 178 as west, ((c_custkey * 53) % 600) / 4.0::double - 78 as south,
         ((c_custkey * 37) % 1400) / 4.0::double - 178 + (c_custkey % 9) / 4.0::double as east, ((c_custkey * 53) % 600) / 4.0::double - 78 + (c_custkey % 7) / 4.0::double as north
  from customer)"""


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box on quarter degrees for each customer, on both hemispheres; some are empty."""
    k = F.col("c_custkey")
    west, south = (k * 37) % 1400 / F.lit(4.0) - 178, (k * 53) % 600 / F.lit(4.0) - 78
    return table(spark, sf_dir, "customer").select(k.alias("id"), west.alias("west"), south.alias("south"), (west + k % 9 / F.lit(4.0)).alias("east"), (south + k % 7 / F.lit(4.0)).alias("north"))


NAME = "printf('%s%02d%s%03d_FABDEM_V1-2.tif', case when lat >= 0 then 'N' else 'S' end, abs(lat), case when lon >= 0 then 'E' else 'W' end, abs(lon))"
TILES = f"""tiles as (
  select id, lat, lon, {NAME} as tile, ((lat - floor(south)) * greatest(1, ceil(east) - floor(west)) + lon - floor(west))::int as ordinal
  from (select *, unnest(range(floor(west)::int, ceil(east)::int))::int as lon from (select *, unnest(range(floor(south)::int, ceil(north)::int))::int as lat from areas)))"""
LISTED = f"""listed as (
  select distinct {NAME} as tile from (select ((s_suppkey * 29) % 150 - 78)::int as lat, ((s_suppkey * 31 + k) % 350 - 178)::int as lon from supplier, range(0, 40) as u(k)))"""


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of tile files that are there."""
    k = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("k"))
    corner = k.select(((F.col("s_suppkey") * 29) % 150 - 78).cast("int").alias("lat"), ((F.col("s_suppkey") * 31 + F.col("k")) % 350 - 178).cast("int").alias("lon"))
    return corner.select(aoi.tile_name(F.col("lat"), F.col("lon")).alias("tile")).distinct()


# Areas of interest


@query(f"select lat, lon, {NAME} as tile from (select ((c_custkey * 7) % 180 - 90)::int as lat, ((c_custkey * 11) % 360 - 180)::int as lon from customer)")
def tile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    corner = table(spark, sf_dir, "customer").select(((k * 7) % 180 - 90).cast("int").alias("lat"), ((k * 11) % 360 - 180).cast("int").alias("lon"))
    return corner.withColumn("tile", aoi.tile_name(F.col("lat"), F.col("lon")))


@query(f"with {AREAS}, {TILES} select id, lat, lon, tile, ordinal from tiles")
def aoi_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aoi.tiles(areas(spark, sf_dir)).select("id", "lat", "lon", "tile", "ordinal")


@query(f"""with {AREAS} select id, own::int as own, coalesce(nullif(case when id % 3 = 0 then 0 when id % 3 = 1 then 3857 end, 0), own)::int as epsg
  from (select id, case when (south + north) / 2 < 0 then 32700 else 32600 end + trunc(((west + east) / 2 + 180) / 6)::int + 1 as own from areas)""")
def utm_epsg(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = aoi.utm_epsg(*(F.col(x) for x in ("west", "south", "east", "north")))
    asked = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 3857)
    return areas(spark, sf_dir).select("id", own.alias("own"), aoi.target_epsg(asked, own).alias("epsg"))


@query(f"with {AREAS} select id, round((east - west) * 111.32::double * cos(radians((south + north) / 2)), 7) as width_km, round((north - south) * 110.57::double, 7) as height_km from areas")
def aoi_extent_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = [F.col(x) for x in ("west", "south", "east", "north")]
    return areas(spark, sf_dir).select("id", F.round(aoi.width_km(*box), 7).alias("width_km"), F.round(aoi.height_km(box[1], box[3]), 7).alias("height_km"))


@query("""select p_partkey, (k + case when k % 2 = 0 then 1 else 0 end)::int as cells
  from (select p_partkey, greatest(3, round_even(p_retailprice * 10 / (p_size % 5 * 10 + 10), 0))::int as k from part)""")
def odd_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", aoi.odd_cells(F.col("p_retailprice") * 10, (F.col("p_size") % 5 * 10 + 10).cast("double")).alias("cells"))


@query(f"with {AREAS}, {TILES}, {LISTED} select id, tile, ordinal from tiles where tile in (select tile from listed)")
def tiles_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.present(aoi.tiles(areas(spark, sf_dir)), listed(spark, sf_dir)).select("id", "tile", "ordinal")


@query(f"with {AREAS}, {TILES}, {LISTED} select id, tile, ordinal from tiles where tile not in (select tile from listed)")
def tiles_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.missing(aoi.tiles(areas(spark, sf_dir)), listed(spark, sf_dir)).select("id", "tile", "ordinal")


# Grids


@query("""select l_orderkey, l_linenumber, nullif(z, -9999) as z, (z <> -9999) as valid
  from (select l_orderkey, l_linenumber, case when l_quantity > 45 then -9999 else l_quantity end::float as z from lineitem)""")
def nodata_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.when(F.col("l_quantity") > 45, aoi.NODATA).otherwise(F.col("l_quantity")).cast("float")
    found = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cells.without_nodata(z).alias("z"))
    return found.withColumn("valid", cells.valid(F.col("z")))


EVT = "evt as (select user_id::int as r, date_diff('day', date '1970-01-01', ts::date)::int as c, count(*) as z from events group by all)"


def evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events by user and day: a grid with holes."""
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("int").alias("r"), F.unix_date(F.to_date("ts")).alias("c")).agg(F.count("*").alias("z"))


@query(f"""with {EVT}, box as (select min(r) r0, max(r) r1, min(c) c0, max(c) c1 from evt)
  select g.r, g.c, evt.z from (select unnest(range(r0, r1 + 1))::int as r, c from (select r0, r1, unnest(range(c0, c1 + 1))::int as c from box)) g left join evt using (r, c)""")
def densify_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evt(spark, sf_dir)
    box = found.agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")).first()
    return grid.densified(found, box.r0, box.r1 + 1, box.c0, box.c1 + 1)


@query("""select r, c, z from (select r, c, z, row_number() over (partition by r, c order by z is null, l_shipdate desc, l_partkey desc, l_suppkey desc, z desc) as k
  from (select l_orderkey as r, l_linenumber as c, case when l_returnflag = 'R' then null else l_quantity end as z, l_shipdate, l_partkey, l_suppkey from lineitem)) where k = 1""")
def mosaic_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    laid = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("r"), F.col("l_linenumber").alias("c"), z.alias("z"), "l_shipdate", "l_partkey", "l_suppkey")
    return grid.mosaic(laid, F.struct("l_shipdate", "l_partkey", "l_suppkey", "z"))


# Moments and deviation


def boxes(halves: dict[str, int]) -> str:
    """Moments by two bounded windows, one along rows and one along columns."""
    inner = ", ".join(f"sum(z) over {x}1 as s1_{x}, sum(z * z) over {x}1 as q1_{x}, count(z) over {x}1 as n1_{x}" for x in halves)
    one = ", ".join(f"{x}1 as (partition by r order by c rows between {h} preceding and {h} following)" for x, h in halves.items())
    two = ", ".join(f"{x}2 as (partition by c order by r rows between {h} preceding and {h} following)" for x, h in halves.items())
    outer = ", ".join(f"coalesce(sum(s1_{x}) over {x}2, 0)::bigint as s_{x}, coalesce(sum(q1_{x}) over {x}2, 0)::bigint as q_{x}, (sum(n1_{x}) over {x}2)::bigint as n_{x}" for x in halves)
    return f"{EMB}, along as (select r, c, z, {inner} from emb window {one}), box as (select r, c, z, {outer} from along window {two})"


def dev_of(x: str) -> str:
    spread = f"(n_{x}::hugeint * q_{x} - s_{x}::hugeint * s_{x})"
    return f"case when z is null then null when {spread} <= 0 then 0.0 else (n_{x} * z - s_{x})::double / sqrt({spread}::double) end"


def devs(halves: dict[str, int]) -> str:
    return f"{boxes(halves)}, devs as (select r, c, z, {', '.join(f'{dev_of(x)} as dev_{x}' for x in halves)} from box)"


def emb_dev(spark: SparkSession, sf_dir: str, halves: dict[str, int] = HALVES) -> DataFrame:
    return focal.dev(emb(spark, sf_dir), halves, most=EMB_MOST)


def focal_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.moments(emb(spark, sf_dir), {"w": 5})


@query(f"with {boxes({'w': 5})} select r, c, n_w as n from box")
def focal_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal_moments(spark, sf_dir).select("r", "c", F.col("n_w").alias("n"))


@query(f"with {boxes({'w': 5})} select r, c, case when n_w > 0 then s_w::double / n_w end as mean from box")
def focal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal_moments(spark, sf_dir).select("r", "c", F.when(F.col("n_w") > 0, F.col("s_w").cast("double") / F.col("n_w")).alias("mean"))


@query(f"with {boxes({'w': 5})} select r, c, case when n_w > 0 then sqrt((n_w * q_w - s_w * s_w)::double) / n_w end as stddev from box")
def focal_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = F.sqrt((F.col("n_w") * F.col("q_w") - F.col("s_w") * F.col("s_w")).cast("double"))
    return focal_moments(spark, sf_dir).select("r", "c", F.when(F.col("n_w") > 0, spread / F.col("n_w")).alias("stddev"))


@query(f"with {devs({'w': 2})} select r, c, dev_w as dev from devs")
def dev_single_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emb_dev(spark, sf_dir, {"w": 2}).select("r", "c", F.col("dev_w").alias("dev"))


@query(f"with {devs(HALVES)} select r, c, dev_micro, dev_meso, dev_macro from devs")
def dev_multiscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emb_dev(spark, sf_dir).select("r", "c", "dev_micro", "dev_meso", "dev_macro")


@query(f"with {devs({'a': 5, 'b': 50})} select r, c, dev_a, dev_b, abs(dev_a) as dev_abs_a, abs(dev_b) as dev_abs_b from devs")
def dev_cells_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.multiscale_dev_cells(emb(spark, sf_dir), {"a": 10, "b": 100}, most=EMB_MOST).select("r", "c", "dev_a", "dev_b", "dev_abs_a", "dev_abs_b")


@query(f"with {devs({'w': 8})} select r, c, abs(dev_w) as dev_abs from devs")
def dev_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emb_dev(spark, sf_dir, {"w": 8}).select("r", "c", F.abs("dev_w").alias("dev_abs"))


# Rendering


def byte_of(x: str, clip: str = "2") -> str:
    return f"round_even(cast(cast(least(abs(dev_{x}::float), {clip}::float) / {clip}::float as float) * 255::float as double), 0)::smallint"


def bands_of(order: tuple[str, str, str], clip: str = "2") -> str:
    drawn = " and ".join(f"dev_{x} is not null" for x in order)
    return ", ".join(f"case when {drawn} then {byte_of(x, clip)} else 0::smallint end as {b}" for b, x in zip(("red", "green", "blue"), order)) + f", case when {drawn} then 255 else 0 end::smallint as alpha"


@query(f"with {devs({'w': 2})} select r, c, case when dev_w is null then 0::smallint else {byte_of('w')} end as byte from devs")
def abs_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emb_dev(spark, sf_dir, {"w": 2}).select("r", "c", cells.stretched(F.col("dev_w"), 2.0).alias("byte"))


LAYERS = "layers as (select r, c, dev_micro, case when (r + c) % 11 <> 0 then dev_meso end as dev_meso, case when c % 13 <> 0 then dev_macro end as dev_macro from devs)"


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers with holes of their own."""
    found = emb_dev(spark, sf_dir)
    return found.withColumns({"dev_meso": F.when((F.col("r") + F.col("c")) % 11 != 0, F.col("dev_meso")), "dev_macro": F.when(F.col("c") % 13 != 0, F.col("dev_macro"))})


@query(f"with {devs(HALVES)}, {LAYERS} select r, c, (dev_micro is not null and dev_meso is not null and dev_macro is not null) as valid from layers")
def valid_all_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).select("r", "c", render.valid_all([F.col(f"dev_{x}") for x in HALVES]).alias("valid"))


@query(f"with {devs(HALVES)}, {LAYERS} select r, c, {bands_of(render.ARTWORK_RGB)} from layers")
def rgb_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.rgb_composite(layers(spark, sf_dir)).select("r", "c", "red", "green", "blue", "alpha")


@query(f"with {devs(HALVES)}, {LAYERS}, bands as (select r, c, {bands_of(render.ARTWORK_RGB)} from layers) select r, c, concat_ws(',', red, green, blue, alpha) as rgba from bands")
def rgba_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.rgb_composite(layers(spark, sf_dir)).select("r", "c", F.array_join(F.array("red", "green", "blue", "alpha"), ",").alias("rgba"))


@query(f"with {devs(HALVES)}, {LAYERS} select r, c, {bands_of(('micro', 'macro', 'meso'), '1.5')} from layers")
def rgb_custom_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.rgb_composite(layers(spark, sf_dir), ("micro", "macro", "meso"), 1.5).select("r", "c", "red", "green", "blue", "alpha")


@query(f"with {devs(HALVES)} select r, c, dev_micro, dev_meso, dev_macro from devs where dev_meso is not null")
def layers_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers kept apart and brought together by place; one of them has no rows for its holes."""
    found = emb_dev(spark, sf_dir)
    apart = {x: found.select("r", "c", F.col(f"dev_{x}").alias("dev")) for x in HALVES}
    apart["meso"] = apart["meso"].where("dev is not null")
    return render.joined_layers(apart).select("r", "c", "dev_micro", "dev_meso", "dev_macro")


# Projection and warping


def sql_series(first: str, terms: tuple[float, ...], f: Callable) -> str:
    return " + ".join([first, *(f"({k!r}::double) * {f(2 * j)}" for j, k in enumerate(terms, 1))])


def utm_sql(source: str, lon: str, lat: str, meridian: str, north: str) -> str:
    e = f"{projection.ECCENTRICITY!r}::double"
    x = sql_series("eta", projection.ALPHA, lambda m: f"cos({m} * xi) * sinh({m} * eta)")
    y = sql_series("xi", projection.ALPHA, lambda m: f"sin({m} * xi) * cosh({m} * eta)")
    k = f"{projection.SCALE * projection.RADIUS!r}::double"
    return f"""(select *, 500000 + {k} * ({x}) as x, {north} + {k} * ({y}) as y
      from (select *, atan2(t, cos(away)) as xi, atanh(sin(away) / sqrt(1 + t * t)) as eta
        from (select *, sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) as t, radians({lon} - {meridian}) as away from {source})))"""


def degrees_sql(source: str, meridian: str, north: str) -> str:
    k = f"{projection.SCALE * projection.RADIUS!r}::double"
    xi0 = sql_series("xi", tuple(-b for b in projection.BETA), lambda m: f"sin({m} * xi) * cosh({m} * eta)")
    eta0 = sql_series("eta", tuple(-b for b in projection.BETA), lambda m: f"cos({m} * xi) * sinh({m} * eta)")
    lat = sql_series("chi", projection.DELTA, lambda m: f"sin({m} * chi)")
    return f"""(select *, {meridian} + degrees(atan(sinh(eta0) / cos(xi0))) as lon, degrees({lat}) as lat
      from (select *, asin(sin(xi0) / cosh(eta0)) as chi from (select *, {xi0} as xi0, {eta0} as eta0
        from (select *, (y - {north}) / {k} as xi, (x - 500000) / {k} as eta from {source}))))"""


#: Points within a zone: of customers, around the middle of zone 22 south.
POINTS = "(select c_custkey as id, -54.0::double + ((c_custkey * 7919) % 60000) / 10000.0::double as lon0, -34.0::double + ((c_custkey * 104729) % 340000) / 10000.0::double as lat0 from customer)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("id"), (-54.0 + (k * 7919) % 60000 / F.lit(10000.0)).alias("lon0"), (-34.0 + (k * 104729) % 340000 / F.lit(10000.0)).alias("lat0"))


@query(f"select id, round(x, 5) as x, round(y, 5) as y from {utm_sql(POINTS, 'lon0', 'lat0', '(-51)', '10000000')}")
def utm_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = projection.to_utm(F.col("lon0"), F.col("lat0"), 32722)
    return points(spark, sf_dir).select("id", F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))


METRES = "(select c_custkey as id, 200000.0::double + (c_custkey * 7919) % 600000 as x, 6300000.0::double + (c_custkey * 104729) % 3600000 as y from customer)"


@query(f"select id, round(lon, 10) as lon, round(lat, 10) as lat from {degrees_sql(METRES, '(-51)', '10000000')}")
def utm_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    at = table(spark, sf_dir, "customer").select(k.alias("id"), (200000.0 + (k * 7919) % 600000).alias("x"), (6300000.0 + (k * 104729) % 3600000).alias("y"))
    lon, lat = projection.from_utm(F.col("x"), F.col("y"), 32722)
    return at.select("id", F.round(lon, 10).alias("lon"), F.round(lat, 10).alias("lat"))


@query("select c_custkey as id, round(degrees(x / 6378137.0::double), 10) as lon, round(degrees(2 * atan(exp(y / 6378137.0::double)) - pi() / 2), 9) as lat from (select c_custkey, -20000000.0::double + (c_custkey * 7919) % 40000 * 1000 as x, -15000000.0::double + (c_custkey * 104729) % 30000 * 1000 as y from customer)")
def mercator_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    at = table(spark, sf_dir, "customer").select(k.alias("id"), (-20000000.0 + (k * 7919) % 40000 * 1000).alias("x"), (-15000000.0 + (k * 104729) % 30000 * 1000).alias("y"))
    lon, lat = projection.from_system(F.col("x"), F.col("y"), 3857)
    return at.select("id", F.round(lon, 10).alias("lon"), F.round(lat, 9).alias("lat"))


#: Steps of the box's sides and its bounds in degrees, for the query of the target grid.
BOX = (-50.0, -26.0, -48.0, -25.0)
SIDES = f"""(select {BOX[0]}::double + {BOX[2] - BOX[0]}::double * i / 64 as lon0, y as lat0 from range(0, 65) as u(i), (values ({BOX[1]}::double), ({BOX[3]}::double)) as v(y)
  union all select x, {BOX[1]}::double + {BOX[3] - BOX[1]}::double * i / 64 from range(0, 65) as u(i), (values ({BOX[0]}::double), ({BOX[2]}::double)) as v(x))"""


@query(f"""select n_nationkey as id, res, floor(x0 / res) * res as x0, ceil(y1 / res) * res as y0, (ceil(y1 / res) - floor(y0 / res))::bigint as nrows, (ceil(x1 / res) - floor(x0 / res))::bigint as ncols
  from (select n_nationkey, (n_nationkey + 1) * 10.0::double as res from nation), (select min(x) x0, max(x) x1, min(y) y0, max(y) y1 from {utm_sql(SIDES, 'lon0', 'lat0', '(-51)', '10000000')})""")
def target_aligned_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect()]
    grids = [(k, warp.target_grid(*BOX, 32722, (k + 1) * 10.0)) for k in keys]
    return spark.createDataFrame([(k, g.res, g.x0, g.y0, g.nrows, g.ncols) for k, g in grids], "id int, res double, x0 double, y0 double, nrows long, ncols long")


TARGET = "target as (select r, c, (c + 0.5::double) * 0.8125::double + 3 as u, (r + 0.5::double) * 0.96875::double - 1 as v from emb)"


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the embeddings' grid, turned into places on it; some fall outside."""
    return emb(spark, sf_dir).select("r", "c", ((F.col("c") + 0.5) * 0.8125 + 3).alias("u"), ((F.col("r") + 0.5) * 0.96875 - 1).alias("v"))


def resample_sql(method: str, z: str = "emb", t: str = "target", digits: int = 6) -> str:
    if method == "near":
        side = lambda p: f"(values (floor({p})::int, 1.0::double))"
    elif method == "bilinear":
        side = lambda p: f"(values (floor({p} - 0.5)::int, 1 - ({p} - 0.5 - floor({p} - 0.5))), (floor({p} - 0.5)::int + 1, {p} - 0.5 - floor({p} - 0.5)))"
    else:
        kernel = {
            "cubic": "case when {x} <= 1 then 1.5 * {x} ** 3 - 2.5 * {x} ** 2 + 1 else -0.5 * {x} ** 3 + 2.5 * {x} ** 2 - 4 * {x} + 2 end",
            "cubicspline": "case when {x} < 1 then {x} ** 3 / 2 - {x} ** 2 + 2.0::double / 3 else (2 - {x}) ** 3 / 6 end",
            "lanczos": "case when {x} < 1e-9 then 1.0::double else 3 * sin(pi() * {x}) * sin(pi() * {x} / 3) / (pi() * {x}) ** 2 end",
        }[method]
        reach = range(-2, 4) if method == "lanczos" else range(-1, 3)

        def side(p: str) -> str:
            d = [f"abs({p} - 0.5 - (floor({p} - 0.5) + {i}))" for i in reach]
            return "(values " + ", ".join(f"(floor({p} - 0.5)::int + {i}, {kernel.format(x=x)})" for i, x in zip(reach, d)) + ")"
    return f"""select r, c, case when abs(w) > 1e-9 then round(s / w, {digits}) end as z from (
      select t.r, t.c, sum(a.w * b.w * e.z) as s, sum(case when e.z is not null then a.w * b.w end) as w
      from {t} t, lateral {side('t.v')} a(i, w), lateral {side('t.u')} b(i, w) left join {z} e on e.r = a.i and e.c = b.i group by t.r, t.c)"""


def resample(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    found = warp.resampled(emb(spark, sf_dir), target(spark, sf_dir), method)
    return found.withColumn("z", F.round("z", 6))


@query(f"with {EMB}, {TARGET} {resample_sql('near')}")
def resample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, sf_dir, "near")


@query(f"with {EMB}, {TARGET} {resample_sql('bilinear')}")
def resample_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, sf_dir, "bilinear")


@query(f"with {EMB}, {TARGET} {resample_sql('cubic')}")
def resample_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, sf_dir, "cubic")


@query(f"with {EMB}, {TARGET} {resample_sql('cubicspline')}")
def resample_cubicspline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, sf_dir, "cubicspline")


@query(f"with {EMB}, {TARGET} {resample_sql('lanczos')}")
def resample_lanczos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, sf_dir, "lanczos")


def covered_sql(found: str) -> str:
    """Source cells that meet boxes of 2.5 by 3.25 cells, with the area they share; the values are cut to tens, so that some are equal."""
    return f"""with {EMB}, boxes as (select r, c, (c + 0.5::double) * 2.5::double + 1 - 1.25::double as u0, (r + 0.5::double) * 3.25::double - 2 - 1.625::double as v0 from emb where c < 30 and r % 3 = 0),
  places as (select *, unnest(range(floor(v0)::int, ceil(v0 + 3.25::double)::int))::int as sr from (select *, unnest(range(floor(u0)::int, ceil(u0 + 2.5::double)::int))::int as sc from boxes)),
  met as (select p.r, p.c, floor(e.z / 1000.0)::double as z, (least(u0 + 2.5::double, sc + 1) - greatest(u0, sc)) * (least(v0 + 3.25::double, sr + 1) - greatest(v0, sr)) as w
    from places p left join emb e on e.r = sr and e.c = sc) {found}"""


def covered(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    cells_ = emb(spark, sf_dir)
    boxes = cells_.where("c < 30 and r % 3 = 0").selectExpr("r", "c", "(c + 0.5D) * 2.5D + 1 as u", "(r + 0.5D) * 3.25D - 2 as v", "2.5D as du", "3.25D as dv")
    found = warp.covered(cells_.withColumn("z", F.floor(F.col("z") / 1000)), boxes, method)
    return found.withColumn("z", F.round("z", 6))


@query(covered_sql("select r, c, round(sum(w * z) / sum(w) filter (where z is not null), 6) as z from met group by r, c"))
def resample_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered(spark, sf_dir, "average")


@query(covered_sql(""", sums as (select r, c, z, round(sum(w), 9) as w from met group by r, c, z)
  select r, c, z from (select r, c, z, row_number() over (partition by r, c order by z is null, w desc, z) as k from sums) where k = 1"""))
def resample_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered(spark, sf_dir, "mode")


@query(covered_sql("select r, c, min(z) as z from met group by r, c"))
def resample_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered(spark, sf_dir, "min")


#: The embeddings' grid as two tiles that share columns, laid in degrees; its target in UTM.
RES_DEGREES, RES_METRES, EPSG = 1 / 256, 500.0, 32722


def source_grid(rows: int) -> grid.Grid:
    return grid.Grid(4326, -50.0, -25.0, RES_DEGREES, rows, 64)


def emb_rows(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] + 1


def warped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, grid.Grid]:
    whole = emb(spark, sf_dir)
    first = whole.where("c < 40").select("r", "c", F.lit(0).alias("ordinal"), "z")
    second = whole.where("c >= 30").select("r", "c", F.lit(1).alias("ordinal"), (F.col("z") + 7).alias("z"))
    return warp.mosaic_and_warp(first.unionByName(second), source_grid(emb_rows(spark, sf_dir)), EPSG, RES_METRES)


WARP_SIDES = f"""(select -50.0::double + 0.25::double * i / 64 as lon0, -25.0::double - k * n / 256.0::double as lat0 from range(0, 65) as u(i), (values (0), (1)) as v(k), rows_
  union all select -50.0::double + 0.25::double * k, -25.0::double - n / 256.0::double * (1 - i / 64.0::double) from range(0, 65) as u(i), (values (0), (1)) as v(k), rows_)"""
WARP = f"""{EMB}, rows_ as (select max(vec_id) + 1 as n from embeddings),
laid as (select r, c, z from (select r, c, z, row_number() over (partition by r, c order by z is null, o desc) as k
  from (select r, c, 0 as o, z from emb where c < 40 union all select r, c, 1, z + 7 from emb where c >= 30)) where k = 1),
bounds as (select floor(min(x) / 500) as x0, ceil(max(x) / 500) as x1, floor(min(y) / 500) as y0, ceil(max(y) / 500) as y1 from {utm_sql(WARP_SIDES, 'lon0', 'lat0', '(-51)', '10000000')}),
places as (select r, c, x0 * 500.0::double + (c + 0.5::double) * 500 as x, y1 * 500.0::double - (r + 0.5::double) * 500 as y
  from (select *, unnest(range(0, (y1 - y0)::bigint))::int as r from (select *, unnest(range(0, (x1 - x0)::bigint))::int as c from bounds))),
target as (select r, c, round((lon - -50.0::double) * 256, 6) as u, round((-25.0::double - lat) * 256, 6) as v from {degrees_sql('places', '(-51)', '10000000')})"""


@query(f"with {WARP} {resample_sql('cubic', 'laid', digits=3)}")
def mosaic_and_warp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warped(spark, sf_dir)[0].withColumn("z", F.round("z", 3))


PIPELINE_HALVES = {"micro": 1, "meso": 3, "macro": 10}


@query(f"""with {WARP}, warped as ({resample_sql('cubic', 'laid', digits=3)}), {boxes(PIPELINE_HALVES).replace(EMB + ', ', '').replace('from emb ', 'from whole ').replace('along as', 'whole as (select r, c, round(z)::bigint as z from warped), along as', 1)},
  devs as (select r, c, z, {', '.join(f'{dev_of(x)} as dev_{x}' for x in PIPELINE_HALVES)} from box) select r, c, {bands_of(render.ARTWORK_RGB)} from devs""")
def pipeline_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles to colours: mosaic, warp, deviations at 3, 7 and 21 cells (1,500, 3,500 and 10,500 m), composite."""
    dem, g = warped(spark, sf_dir)
    whole = dem.select("r", "c", F.round(F.round("z", 3)).cast("long").alias("z"))
    found = focal.multiscale_dev(whole, {"micro": 1500.0, "meso": 3500.0, "macro": 10500.0}, g.res, most=10 * EMB_MOST)
    return render.rgb_composite(found).select("r", "c", "red", "green", "blue", "alpha")


# Files: what a reader makes of the image's encoded parts


def image(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, grid.Grid]:
    return render.rgb_composite(layers(spark, sf_dir)), grid.Grid(EPSG, 0.0, 0.0, RES_METRES, emb_rows(spark, sf_dir), 64)


@query(f"with {devs(HALVES)}, {LAYERS}, bands as (select r, c, {bands_of(render.ARTWORK_RGB)} from layers) select r, c, red, green, blue from bands")
def geotiff_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (cells_, g), bands = image(spark, sf_dir), ["red", "green", "blue"]
    return geotiff.decoded_blocks(geotiff.encoded_blocks(cells_, g, bands, "u1", 0.0), g, bands, "u1")


@query(f"with {devs(HALVES)}, {LAYERS} select r, c, dev_micro::float as dev_micro from layers")
def geotiff_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of single-precision values as a file's tiles and back; NoData is null again."""
    found, g = layers(spark, sf_dir).select("r", "c", "dev_micro"), grid.Grid(EPSG, 0.0, 0.0, RES_METRES, emb_rows(spark, sf_dir), 64)
    back = geotiff.decoded_blocks(geotiff.encoded_blocks(found, g, ["dev_micro"], "f4", aoi.NODATA), g, ["dev_micro"], "f4")
    return back.withColumn("dev_micro", cells.without_nodata(F.col("dev_micro")))


@query(f"with {devs(HALVES)}, {LAYERS}, bands as (select r, c, {bands_of(render.ARTWORK_RGB)} from layers) select r, c, red, green, blue, alpha from bands")
def png_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    (cells_, g), bands = image(spark, sf_dir), ["red", "green", "blue", "alpha"]
    return png.inflated_bands(png.deflated_bands(cells_, g, bands, 256), g, bands, 256)
