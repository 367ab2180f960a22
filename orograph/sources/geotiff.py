"""GeoTIFF in plain Python and NumPy: decoded in tasks, encoded block by block in tasks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import without_nodata
from ..operators.grid import Grid

#: TIFF's field types (bytes, code), tags and GeoTIFF's keys.
KINDS = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, FORMAT = 284, 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, TRANSFORMATION, GEO_KEYS, NODATA_TAG = 33550, 33922, 34264, 34735, 42113
MODEL_TYPE, RASTER_TYPE, GEOGRAPHIC_TYPE, PROJECTED_TYPE = 1024, 1025, 2048, 3072
#: Ways of compression, and the raster type in which a cell's number is its middle.
PLAIN, LZW, DEFLATE, PACKBITS, OLD_DEFLATE, ZSTD = 1, 5, 8, 32773, 32946, 50000
POINT = 2
FORMATS = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


@dataclass
class Header:
    """Rows and columns, the upper left corner, the cell's size, the system, and NoData (None without one)."""

    nrows: int
    ncols: int
    x0: float
    y0: float
    res: float
    epsg: int
    nodata: float | None


@dataclass
class Raster(Header):
    """bands[band, row, column]."""

    bands: np.ndarray


def fields(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the first directory's values by tag; classic and big files."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    head, entry, number, inline = (8, 20, "Q", 8) if big else (4, 12, "I", 4)
    at = struct.unpack_from(order + number, data, head)[0]
    count = struct.unpack_from(order + ("Q" if big else "H"), data, at)[0]
    at += 8 if big else 2
    found = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(order + "HH" + number, data, at + i * entry)
        if kind not in KINDS:
            continue
        size, code = KINDS[kind]
        where = at + i * entry + entry - inline
        if size * n > inline:
            where = struct.unpack_from(order + number, data, where)[0]
        found[tag] = tuple(data[where : where + n].split(b"\0")[:1]) if kind == 2 else struct.unpack_from(f"{order}{n * len(code)}{code[0]}", data, where)
    return order, found


def unpredicted(block: np.ndarray, predictor: int, order: str) -> np.ndarray:
    """block[row, column, sample]: differences along rows (2) or of byte planes (3) undone."""
    if predictor == 1:
        return block
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=block.dtype)
    rows, columns, samples = block.shape
    planes = np.cumsum(np.ascontiguousarray(block).view(np.uint8).reshape(rows, -1, samples), axis=1, dtype=np.uint8).reshape(rows, -1)
    size = block.dtype.itemsize
    mixed = planes.reshape(rows, size, columns * samples).transpose(0, 2, 1)
    return np.ascontiguousarray(mixed).view(f">f{size}").reshape(rows, columns, samples).astype(f"=f{size}")


def unlzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; each width ends one code early. 256 clears the table, 257 ends."""
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, out, last = list(single), 9, [], b""
    held = bits = 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = list(single), 9, b""
            continue
        if code < len(table):
            text = table[code]
        elif last and code == len(table):
            text = last + last[:1]
        else:
            raise ValueError("an LZW code comes before its text")
        out.append(text)
        if last and len(table) < 4096:
            table.append(last + text[:1])
            width = min(12, (len(table) + 1).bit_length())
        last = text
    return b"".join(out)


def unpacked_bits(data: bytes) -> bytes:
    """A count, then that many bytes and one more as they are, or (negative) one byte so many times and once more."""
    out, at = [], 0
    while at < len(data):
        n, at = data[at], at + 1
        if n < 128:
            out.append(data[at : at + n + 1])
            at += n + 1
        elif n > 128:
            out.append(data[at : at + 1] * (257 - n))
            at += 1
    return b"".join(out)


def uncompressed(data: bytes, packing: int, size: int) -> bytes:
    if packing == PLAIN:
        return data
    if packing in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    if packing == LZW:
        return unlzw(data)
    if packing == PACKBITS:
        return unpacked_bits(data)
    if packing == ZSTD:
        import pyarrow as pa

        return pa.Codec("zstd").decompress(data, size, asbytes=True)
    raise ValueError(f"compression {packing} isn't read")


def header(data: bytes, f: dict[int, tuple] | None = None) -> Header:
    """From a file's directory; cells stay unread. Files that don't say where they lie, or whose cells aren't upright squares, are refused."""
    f = fields(data)[1] if f is None else f
    keys = f.get(GEO_KEYS, ())
    by_key = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
    if m := f.get(TRANSFORMATION):
        dx, dy, x0, y0, turned = m[0], -m[5], m[3], m[7], m[1] or m[4]
    elif (tie := f.get(TIE_POINT)) and (scale := f.get(PIXEL_SCALE)):
        dx, dy, turned = scale[0], scale[1], False
        x0, y0 = tie[3] - tie[0] * dx, tie[4] + tie[1] * dy
    else:
        raise ValueError("the file doesn't say where its cells lie")
    if turned or dx <= 0 or abs(dx - dy) > 1e-9 * dx:
        raise ValueError("cells are not upright squares")
    if by_key.get(RASTER_TYPE) == POINT:
        x0, y0 = x0 - dx / 2, y0 + dy / 2
    nodata = float(f[NODATA_TAG][0]) if f.get(NODATA_TAG) else None
    return Header(f[HEIGHT][0], f[WIDTH][0], x0, y0, dx, by_key.get(PROJECTED_TYPE, by_key.get(GEOGRAPHIC_TYPE, 0)), nodata)


def decode(data: bytes) -> Raster:
    """A whole file: strips or tiles, samples side by side or in planes, plain or compressed (Deflate, LZW, PackBits, Zstandard); other layouts are refused."""
    order, f = fields(data)
    width, height, samples = f[WIDTH][0], f[HEIGHT][0], f.get(SAMPLES, (1,))[0]
    kind = np.dtype(FORMATS[f.get(FORMAT, (1,))[0], f[BITS][0]]).newbyteorder(order)
    packing, predictor, planes = f.get(COMPRESSION, (1,))[0], f.get(PREDICTOR, (1,))[0], f.get(PLANAR, (1,))[0] == 2
    tiled = TILE_WIDTH in f
    w, h = (f[TILE_WIDTH][0], f[TILE_HEIGHT][0]) if tiled else (width, min(height, f.get(STRIP_ROWS, (height,))[0]))
    out = np.zeros((height, width, samples), kind.newbyteorder("="))
    across, down, deep = -(-width // w), -(-height // h), 1 if planes else samples
    for i, (at, n) in enumerate(zip(f[TILE_AT if tiled else STRIP_AT], f[TILE_BYTES if tiled else STRIP_BYTES])):
        plane, block = divmod(i, across * down) if planes else (0, i)
        r, c = block // across * h, block % across * w
        rows = h if tiled else min(h, height - r)
        raw = uncompressed(data[at : at + n], packing, rows * w * deep * kind.itemsize)
        cells = np.frombuffer(raw, kind, rows * w * deep).reshape(rows, w, deep)
        cells = unpredicted(cells if predictor == 3 else cells.astype(kind.newbyteorder("=")), predictor, order)
        out[r : r + rows, c : c + w, plane : plane + deep] = cells[: height - r, : width - c]
    return Raster(**header(data, f).__dict__, bands=out.transpose(2, 0, 1))


def files(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def headers(spark: SparkSession, path: str | list[str], pattern: str = "*.tif") -> DataFrame:
    """(path, nrows, ncols, x0, y0, res, epsg) of each file; no cell is decoded."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [header(bytes(x)) for x in batch["content"]]
            yield pd.DataFrame({"path": batch["path"]} | {k: [getattr(x, k) for x in found] for k in ("nrows", "ncols", "x0", "y0", "res", "epsg")})

    return files(spark, path, pattern).mapInPandas(read, "path string, nrows int, ncols int, x0 double, y0 double, res double, epsg int")


def scan(spark: SparkSession, path: str | list[str], pattern: str = "*.tif", band: int = 0) -> DataFrame:
    """(path, r, c, z float, x0, y0, res, epsg): a row for each cell of each file at a path (or several) that Spark can read; the file's NoData is null.

    Files are decoded in the tasks that read them, one file at a time and in strips of rows."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                t = decode(bytes(content))
                z = t.bands[band].astype("f4")
                step = max(1, 500_000 // z.shape[1])
                for r in range(0, z.shape[0], step):
                    part = z[r : r + step]
                    rows, columns = np.indices(part.shape, np.int32)
                    yield pd.DataFrame({"path": file, "r": rows.ravel() + np.int32(r), "c": columns.ravel(), "z": part.ravel(), "x0": t.x0, "y0": t.y0, "res": t.res, "epsg": t.epsg, "nodata": np.float32("nan" if t.nodata is None else t.nodata)})

    found = files(spark, path, pattern).mapInPandas(cells, "path string, r int, c int, z float, x0 double, y0 double, res double, epsg int, nodata float")
    return found.withColumn("z", without_nodata(F.nanvl("z", F.lit(None).cast("float")), F.col("nodata"))).drop("nodata")


def encoded_blocks(cells: DataFrame, grid: Grid, bands: list[str], kind: str, fill: float, side: int = 256) -> DataFrame:
    """(block, data): deflated tiles of side x side cells, differences along rows for whole numbers; each block is one group of at most side² rows."""
    across, whole = -(-grid.ncols // side), np.dtype(kind).kind in "iu"

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        block = np.full((side, side, len(bands)), fill, kind)
        at = rows["r"].to_numpy() % side, rows["c"].to_numpy() % side
        for i, b in enumerate(bands):
            block[(*at, i)] = rows[b].fillna(fill).to_numpy()
        if whole:
            block[:, 1:] -= block[:, :-1].copy()
        return pd.DataFrame({"block": rows["block"].iloc[:1], "data": [zlib.compress(block.astype(np.dtype(kind).newbyteorder("<")).tobytes(), 6)]})

    number = (F.floor(F.col("r") / side) * across + F.floor(F.col("c") / side)).cast("long")
    return cells.select("r", "c", *bands, number.alias("block")).groupBy("block").applyInPandas(encode, "block long, data binary")


def decoded_blocks(blocks: DataFrame, grid: Grid, bands: list[str], kind: str, side: int = 256) -> DataFrame:
    """(r, c, bands) of encoded_blocks(): what a reader of the file makes of its tiles."""
    across, whole = -(-grid.ncols // side), np.dtype(kind).kind in "iu"

    def decode_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data in zip(batch["block"], batch["data"]):
                found = np.frombuffer(zlib.decompress(bytes(data)), np.dtype(kind).newbyteorder("<")).reshape(side, side, len(bands))
                found = unpredicted(found.astype(kind), 2 if whole else 1, "<")
                r, c = number // across * side, number % across * side
                rows, columns = (x.ravel() for x in np.indices((min(side, grid.nrows - r), min(side, grid.ncols - c)), np.int32))
                yield pd.DataFrame({"r": rows + np.int32(r), "c": columns + np.int32(c)} | {b: found[rows, columns, i] for i, b in enumerate(bands)})

    return blocks.mapInPandas(decode_, ", ".join(["r int, c int", *(f"{b} {'short' if whole else 'float'}" for b in bands)]))


def write(cells: DataFrame, grid: Grid, bands: list[str], path: Path, kind: str = "u1", nodata: float | None = None, side: int = 256) -> Path:
    """One tiled GeoTIFF on the driver's disk; three or four bytes a cell are colours. Blocks come to the driver one partition at a time."""
    across, down = -(-grid.ncols // side), -(-grid.nrows // side)
    dtype, n = np.dtype(kind), len(bands)
    fill = 0.0 if nodata is None else nodata
    empty = zlib.compress(np.diff(np.full((side, side, n), fill, kind), axis=1, prepend=np.zeros((side, 1, n), kind)).astype(kind).tobytes() if dtype.kind in "iu" else np.full((side, side, n), fill, dtype.newbyteorder("<")).tobytes())
    path.parent.mkdir(parents=True, exist_ok=True)
    at, size = np.zeros(across * down, np.uint64), np.zeros(across * down, np.uint64)
    own = path.with_name(path.name + ".part")
    with own.open("wb") as f:
        f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0))
        for row in encoded_blocks(cells, grid, bands, kind, fill, side).toLocalIterator():
            at[row.block], size[row.block] = f.tell(), len(row.data)
            f.write(row.data)
        if (missing := size == 0).any():
            at[missing], size[missing] = f.tell(), len(empty)
            f.write(empty)
        colours = n >= 3 and kind == "u1"
        keys = [(MODEL_TYPE, 2 if grid.epsg == 4326 else 1), (RASTER_TYPE, 1), (GEOGRAPHIC_TYPE if grid.epsg == 4326 else PROJECTED_TYPE, grid.epsg)]
        entries = {
            WIDTH: (4, [grid.ncols]), HEIGHT: (4, [grid.nrows]), BITS: (3, [8 * dtype.itemsize] * n), COMPRESSION: (3, [8]), PHOTOMETRIC: (3, [2 if colours else 1]), SAMPLES: (3, [n]), PLANAR: (3, [1]),
            PREDICTOR: (3, [2 if dtype.kind in "iu" else 1]), TILE_WIDTH: (4, [side]), TILE_HEIGHT: (4, [side]), TILE_AT: (16, at.tolist()), TILE_BYTES: (16, size.tolist()), FORMAT: (3, [{"u": 1, "i": 2, "f": 3}[dtype.kind]] * n),
            PIXEL_SCALE: (12, [grid.res, grid.res, 0.0]), TIE_POINT: (12, [0.0, 0.0, 0.0, grid.x0, grid.y0, 0.0]), GEO_KEYS: (3, [1, 1, 0, len(keys), *(x for k, v in keys for x in (k, 0, 1, v))]),
        }
        if colours and n == 4:
            entries[338] = (3, [2])  # the fourth sample is alpha
        if nodata is not None:
            entries[NODATA_TAG] = (2, list(f"{nodata:g}\0".encode()))
        raw = {}
        for tag, (k, values) in sorted(entries.items()):
            body = bytes(values) if k == 2 else struct.pack(f"<{len(values)}{KINDS[k][1]}", *values)
            if len(body) > 8:
                where = f.tell()
                f.write(body)
                body = struct.pack("<Q", where)
            raw[tag] = struct.pack("<HHQ", tag, k, len(values)) + body.ljust(8, b"\0")
        directory = f.tell()
        f.write(struct.pack("<Q", len(raw)) + b"".join(raw.values()) + struct.pack("<Q", 0))
        f.seek(8)
        f.write(struct.pack("<Q", directory))
    own.replace(path)
    return path
