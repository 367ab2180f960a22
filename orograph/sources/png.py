"""PNG previews: bands of rows are filtered and deflated in tasks and strung together by the driver."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grid import Grid

BASE = 65521


def joined_checksum(a: int, b: int, length: int) -> int:
    """Adler-32 of two stretches from their own and the second's length."""
    low = ((a & 0xFFFF) + (b & 0xFFFF) - 1) % BASE
    high = ((a >> 16) + (b >> 16) + length % BASE * ((a & 0xFFFF) - 1)) % BASE
    return high << 16 | low


def deflated_bands(cells: DataFrame, grid: Grid, bands: list[str], rows: int) -> DataFrame:
    """(band, data, adler, length) of each `rows` rows of the image: raw deflate that ends on a byte."""

    def encode(part: pd.DataFrame) -> pd.DataFrame:
        number = int(part["band"].iloc[0])
        height = min(rows, grid.nrows - number * rows)
        lines = np.zeros((height, grid.ncols, len(bands)), np.uint8)
        at = part["r"].to_numpy() - number * rows, part["c"].to_numpy()
        for i, b in enumerate(bands):
            lines[(*at, i)] = part[b].to_numpy()
        lines[:, 1:] -= lines[:, :-1].copy()
        raw = np.concatenate([np.ones((height, 1), np.uint8), lines.reshape(height, -1)], axis=1).tobytes()
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        return pd.DataFrame({"band": [number], "data": [packer.compress(raw) + packer.flush(zlib.Z_FULL_FLUSH)], "adler": [zlib.adler32(raw)], "length": [len(raw)]})

    number = F.floor(F.col("r") / rows).cast("int")
    return cells.select("r", "c", *bands, number.alias("band")).groupBy("band").applyInPandas(encode, "band int, data binary, adler long, length long")


def inflated_bands(packed: DataFrame, grid: Grid, bands: list[str], rows: int) -> DataFrame:
    """(r, c, bands) of deflated_bands(): what a reader of the image makes of them."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data in zip(batch["band"], batch["data"]):
                raw = np.frombuffer(zlib.decompressobj(-15).decompress(bytes(data)), np.uint8).reshape(-1, 1 + grid.ncols * len(bands))
                found = np.cumsum(raw[:, 1:].reshape(len(raw), grid.ncols, len(bands)), axis=1, dtype=np.uint8)
                r, c = (x.ravel() for x in np.indices(found.shape[:2], np.int32))
                yield pd.DataFrame({"r": r + np.int32(number * rows), "c": c} | {b: found[r, c, i] for i, b in enumerate(bands)})

    return packed.mapInPandas(decode, ", ".join(["r int, c int", *(f"{b} short" for b in bands)]))


def write(cells: DataFrame, grid: Grid, path: Path, bands: tuple[str, ...] = ("red", "green", "blue", "alpha")) -> Path:
    """An RGBA (or RGB) image on the driver's disk. cells must be dense."""
    rows = max(1, min(grid.nrows, 1_000_000 // grid.ncols))
    path.parent.mkdir(parents=True, exist_ok=True)
    own = path.with_name(path.name + ".part")

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    total = 1
    with own.open("wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", grid.ncols, grid.nrows, 8, {3: 2, 4: 6}[len(bands)], 0, 0, 0)))
        f.write(chunk(b"IDAT", b"\x78\x9c"))
        for row in deflated_bands(cells, grid, list(bands), rows).orderBy("band").toLocalIterator():
            f.write(chunk(b"IDAT", row.data))
            total = joined_checksum(total, row.adler, row.length)
        f.write(chunk(b"IDAT", b"\x03\x00" + struct.pack(">I", total)) + chunk(b"IEND", b""))
    own.replace(path)
    return path
