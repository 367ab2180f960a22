import struct
import zlib

import numpy as np
import pytest

from orograph.functions.aoi import AOI
from orograph.operators.grid import Grid
from orograph.plans.terrain import Config, common_grid, layers_of_file, run
from orograph.sources import geotiff, png, tiles


def cells_of(spark, bands):
    n, h, w = bands.shape
    rows = [(r, c, *(bands[b, r, c].item() for b in range(n))) for r in range(h) for c in range(w)]
    kind = "float" if bands.dtype.kind == "f" else "smallint"
    return spark.createDataFrame(rows, ", ".join(["r int", "c int", *(f"b{i} {kind}" for i in range(n))]))


@pytest.mark.parametrize("kind,n,nodata", [("u1", 3, None), ("u1", 4, None), ("f4", 1, -9999.0), ("i2", 1, -9999.0)])
def test_geotiff_round_trip(spark, tmp_path, kind, n, nodata):
    bands = np.random.default_rng(0).integers(0, 255, (n, 37, 53)).astype(kind)
    grid = Grid(32722, 500010.0, 7200030.0, 30.0, 37, 53)
    path = geotiff.write(cells_of(spark, bands), grid, [f"b{i}" for i in range(n)], tmp_path / "x.tif", kind, nodata, side=16)
    back = geotiff.decode(path.read_bytes())
    assert (back.bands == bands).all() and back.bands.dtype == np.dtype(kind)
    assert (back.x0, back.y0, back.res, back.epsg, back.nodata) == (500010.0, 7200030.0, 30.0, 32722, nodata)


def lzw(data):
    """A plain encoder."""
    table, width, out, held, bits = {bytes([i]): i for i in range(256)}, 9, bytearray(), 0, 0

    def put(code):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)

    put(256)
    now, size = b"", 258
    for x in data:
        now += bytes([x])
        if now in table:
            continue
        put(table[now[:-1]])
        table[now], size, now = size, size + 1, now[-1:]
        width = max(9, size.bit_length())
        if size == 4094:
            put(256)
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
    if now:
        put(table[now])
        width = max(9, (size + 1).bit_length())
    put(257)
    put(0)
    return bytes(out)


def packbits(data):
    return b"".join(bytes([257 - n, data[i]]) if (n := 3) and data[i : i + 3] == data[i : i + 1] * 3 else bytes([len(data[i : i + 3]) - 1]) + data[i : i + 3] for i in range(0, len(data), 3)) + b"\x80"


@pytest.mark.parametrize("n", [0, 1, 5, 700, 40_000])
def test_lzw_and_packbits(n):
    rng = np.random.default_rng(n)
    for data in (rng.integers(0, 256, n).astype("u1").tobytes(), rng.integers(0, 3, n).astype("u1").tobytes(), b"ab" * (n // 2)):
        assert geotiff.unlzw(lzw(data)) == data
        assert geotiff.unpacked_bits(packbits(data)) == data


def strips(z, predictor, packing=8, place=None, point=False):
    """A classic file with two strips and single-precision values, made by hand."""
    h, w = z.shape
    half = h // 2
    def pack(part):
        if packing != 8:
            import zstandard

            return {1: bytes, 5: lzw, 32773: packbits, 50000: zstandard.compress}[packing](part.astype("<f4").tobytes())
        if predictor == 3:
            planes = part.astype(">f4").view(np.uint8).reshape(len(part), w, 4).transpose(0, 2, 1).reshape(len(part), -1)
            return zlib.compress(np.diff(planes, axis=1, prepend=np.zeros((len(part), 1), np.uint8)).astype(np.uint8).tobytes())
        return zlib.compress(part.astype("<f4").tobytes())
    data = [pack(z[:half]), pack(z[half:])]
    body, at = b"", []
    for d in data:
        at.append(8 + len(body))
        body += d
    scale, tie, keys = struct.pack("<3d", 0.25, 0.25, 0), struct.pack("<6d", 0, 0, 0, -50.0, -25.0, 0), struct.pack("<12H", 1, 1, 0, 2, 1025, 0, 1, 1 + point, 2048, 0, 1, 4326)
    where = 8 + len(body)
    extra = struct.pack("<2I", *at) + struct.pack("<2I", *map(len, data)) + scale + tie + keys + b"-9999\0" + (struct.pack("<16d", *place) if place else b"")
    tags = [(256, 3, 1, w), (257, 3, 1, h), (258, 3, 1, 32), (259, 3, 1, packing), (273, 4, 2, where), (277, 3, 1, 1), (278, 3, 1, half), (279, 4, 2, where + 8), (317, 3, 1, predictor), (339, 3, 1, 3), *([(34264, 12, 16, where + 118)] if place else [(33550, 12, 3, where + 16), (33922, 12, 6, where + 40)] if place is None else []), (34735, 3, 12, where + 88), (42113, 2, 6, where + 112)]
    tags.sort()
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + b"\0" * 4
    return struct.pack("<2sHI", b"II", 42, where + len(extra)) + body + extra + ifd


@pytest.mark.parametrize("predictor", [1, 3])
def test_scan_of_strips(spark, tmp_path, predictor):
    z = np.arange(24, dtype="f4").reshape(4, 6)
    z[1, 2] = -9999
    (tmp_path / "a.tif").write_bytes(strips(z, predictor))
    found = geotiff.scan(spark, str(tmp_path)).orderBy("r", "c").collect()
    assert [r.z for r in found] == [None if x == -9999 else x for x in z.ravel().tolist()]
    assert {(r.x0, r.y0, r.res, r.epsg) for r in found} == {(-50.0, -25.0, 0.25, 4326)}


@pytest.mark.parametrize("packing", [1, 5, 32773, 50000])
def test_other_compressions(packing):
    z = np.random.default_rng(3).normal(500, 100, (40, 30)).astype("f4").round(1)
    assert (geotiff.decode(strips(z, 1, packing)).bands[0] == z).all()


def test_planes_and_unknown_compressions():
    """Samples in planes of their own: the strips of one after those of the other."""
    z = np.arange(24, dtype="f4").reshape(4, 6)
    data = strips(z, 1, 1).replace(struct.pack("<HHII", 277, 3, 1, 1), struct.pack("<HHII", 277, 3, 1, 2)).replace(struct.pack("<HHII", 278, 3, 1, 2), struct.pack("<HHII", 278, 3, 1, 4)).replace(struct.pack("<HHII", 317, 3, 1, 1), struct.pack("<HHII", 284, 3, 1, 2))
    data = data.replace(struct.pack("<HHII", 257, 3, 1, 4), struct.pack("<HHII", 257, 3, 1, 2))
    assert (geotiff.decode(data).bands == z.reshape(2, 2, 6)).all()
    with pytest.raises(ValueError):
        geotiff.decode(strips(z, 1, 1).replace(struct.pack("<HHII", 259, 3, 1, 1), struct.pack("<HHII", 259, 3, 1, 7)))


def test_where_cells_lie(spark, tmp_path):
    z = np.zeros((4, 6), "f4")
    place = [0.25, 0, 0, -50.0, 0, -0.25, 0, -25.0, *[0] * 7, 1]
    assert geotiff.header(strips(z, 1)).__dict__ == geotiff.header(strips(z, 1, place=place)).__dict__ == dict(nrows=4, ncols=6, x0=-50.0, y0=-25.0, res=0.25, epsg=4326, nodata=-9999.0)
    assert (geotiff.header(strips(z, 1, point=True)).x0, geotiff.header(strips(z, 1, point=True)).y0) == (-50.125, -24.875)
    for odd in ([], [0.25, 0.1, 0, -50.0, 0.1, -0.25, 0, -25.0, *[0] * 7, 1], [0.25, 0, 0, -50.0, 0, -0.3, 0, -25.0, *[0] * 7, 1]):
        with pytest.raises(ValueError):
            geotiff.header(strips(z, 1, place=odd))
    for i, x0 in enumerate((-50.0, -48.5, -48.4)):
        (tmp_path / f"{i}.tif").write_bytes(strips(z, 1, place=[*place[:3], x0, *place[4:]]))
    found = geotiff.headers(spark, str(tmp_path)).orderBy("path").collect()
    assert common_grid(found[:2]) == Grid(4326, -50.0, -25.0, 0.25, 4, 12)
    with pytest.raises(ValueError):
        common_grid(found)


def test_png(spark, tmp_path):
    bands = np.random.default_rng(1).integers(0, 255, (4, 9, 7)).astype("u1")
    path = png.write(cells_of(spark, bands), Grid(0, 0, 0, 1, 9, 7), tmp_path / "x.png", ("b0", "b1", "b2", "b3"))
    data, at, idat = path.read_bytes(), 8, b""
    while at < len(data):
        n = struct.unpack_from(">I", data, at)[0]
        if data[at + 4 : at + 8] == b"IDAT":
            idat += data[at + 8 : at + 8 + n]
        assert zlib.crc32(data[at + 4 : at + 8 + n]) == struct.unpack_from(">I", data, at + 8 + n)[0]
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(idat), "u1").reshape(9, 1 + 28)
    assert (lines[:, 0] == 1).all()
    assert (np.cumsum(lines[:, 1:].reshape(9, 7, 4), axis=1, dtype="u1").transpose(2, 0, 1) == bands).all()


def test_checksums_join():
    a, b = b"abc" * 50_000, bytes(range(256)) * 300
    assert png.joined_checksum(zlib.adler32(a), zlib.adler32(b), len(b)) == zlib.adler32(a + b)


def test_area_to_image(spark, tmp_path, caplog):
    caplog.set_level("INFO", "orograph")
    z = np.add.outer(np.arange(8) * 3.0, np.sin(np.arange(8))).astype("f4")
    (tmp_path / "in").mkdir()
    for name, x in (("S26W050", -50.0), ("S26W049", -49.0)):
        data = bytearray(strips(np.tile(z, (1, 1)), 1))
        data = bytes(data).replace(struct.pack("<3d", 0.25, 0.25, 0), struct.pack("<3d", 0.125, 0.125, 0)).replace(struct.pack("<6d", 0, 0, 0, -50.0, -25.0, 0), struct.pack("<6d", 0, 0, 0, x, -25.0, 0))
        (tmp_path / "in" / f"{name}_FABDEM_V1-2.tif").write_bytes(data)
    cfg = Config(AOI("p", -50, -26, -48, -25), res=10000.0, scales_m={"micro": 30000.0, "meso": 50000.0, "macro": 90000.0}, tiles_dir=str(tmp_path / "in"), work_dir=str(tmp_path / "w"), out_dir=tmp_path / "o")
    paths = run(spark, cfg)
    image = geotiff.decode(paths.rgb_tif.read_bytes())
    devs = spark.read.parquet(paths.dev_cells)
    assert image.bands.shape[0] == 3 and image.epsg == 32722 and devs.count() == image.bands[0].size
    assert image.bands.max() > 100 and paths.rgb_png.read_bytes()[:4] == b"\x89PNG"
    dem = geotiff.decode(paths.dem.read_bytes())
    kept = {(r.r, r.c): r.z for r in spark.read.parquet(paths.dem_cells).collect()}
    assert dem.bands.dtype == np.float32 and dem.nodata == -9999 and (dem.epsg, dem.res) == (32722, 10000.0) and len(kept) == dem.bands.size
    assert all(dem.bands[0, r, c] == (-9999 if z is None else np.float32(z)) for (r, c), z in kept.items())
    for label, path in paths.devs.items():
        layer = geotiff.decode(path.read_bytes()).bands[0]
        assert all(layer[r.r, r.c] == (-9999 if (d := r[f"dev_{label}"]) is None else np.float32(d)) for r in devs.collect())
    for said in ("p: 2 of 2 tiles", "windows of 3 cells", "windows of 5 cells", "windows of 9 cells"):
        assert said in caplog.text
    # the elevations by themselves, with windows in cells
    files = layers_of_file(spark, str(paths.dem), tmp_path / "f", {"a": 4, "b": 9})
    assert sorted(files) == ["dev_a", "dev_abs_a", "dev_abs_b", "dev_b"]
    a, b = (geotiff.decode(files[x].read_bytes()).bands[0] for x in ("dev_a", "dev_abs_a"))
    assert (np.where(a == -9999, -9999, np.abs(a)) == b).all() and (b > 0).any()
    nine = geotiff.decode(files["dev_b"].read_bytes()).bands[0]
    assert nine == pytest.approx(geotiff.decode(paths.devs["macro"].read_bytes()).bands[0], abs=1e-4)


def test_missing_tiles(spark, tmp_path, caplog):
    (tmp_path / "S26W050_FABDEM_V1-2.tif").write_bytes(b"x")
    ready = tiles.fetch_tiles(spark, AOI("p", -50, -26, -48, -25), str(tmp_path))
    assert [(r.tile, r.ordinal) for r in ready.collect()] == [("S26W050_FABDEM_V1-2.tif", 0)]
    assert "S26W049" in caplog.text
    with pytest.raises(RuntimeError):
        tiles.fetch_tiles(spark, AOI("q", 10, 10, 11, 11), str(tmp_path))


def test_unreadable_file():
    with pytest.raises(ValueError):
        geotiff.decode(b"PNG and so on")
