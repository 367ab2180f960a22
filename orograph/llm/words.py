"""Words of UTF-8 texts as numpy arrays, and a mapInArrow frame for functions of one text column."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A-Z lower-cased, all other bytes kept.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: A-Z lower-cased, digits, a-z and bytes from 0x80 kept, all others turned into spaces.
ALNUM = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)).translate(LOWER) + bytes(range(128, 256))
#: Bytes of text that are cut into words at once, and that are worked on at once.
SLICE, CHUNK = 1 << 20, 2 << 20


def words(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists that each come from about SLICE bytes, so that long texts need little memory."""
    data = data.translate(table)
    at = 0
    while len(data) - at > SLICE:
        space = next((m for m in range(at + SLICE, len(data)) if data[m] in b" \t\n\r\x0b\x0c"), len(data))
        yield data[at:space].split()
        at = space
    yield data[at:].split() if at else data.split()


class Hashes(dict):
    """Word to its XXH64, remembered for up to `most` words."""

    def __init__(self, most: int = 300_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def numbers(texts: list[bytes], table: bytes, number: Callable, dtype, between: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """number(word) of all words of all texts in one array, and the texts' bounds in it. between: a value put after each text (within its bounds)."""
    parts, ends, n = [], [0], 0
    for text in texts:
        for ws in words(text, table):
            parts.append(np.fromiter(map(number, ws), dtype, len(ws)))
            n += len(ws)
        if between is not None:
            parts.append(np.array([between], dtype))
            n += 1
        ends.append(n)
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), np.array(ends)


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each window of k values."""
    if len(values) < k:
        return np.empty(0, np.uint64)
    a = values.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(31)
    n, h = len(a) - k + 1, np.zeros(len(a) - k + 1, np.uint64)
    for j in range(k):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += a[j : j + n]
    h ^= h >> np.uint64(29)
    return h


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: faster here than by a hash table."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def slices(lengths: Iterable[int], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of at most 65,536 rows of about `most` bytes; a longer row ends its run."""
    start = n = at = 0
    for at, length in enumerate(lengths, 1):
        n += length
        if n >= most or at - start == 1 << 16:
            yield start, at
            start, n = at, 0
    if start < at:
        yield start, at


def texts_of(column: pa.Array) -> list[bytes]:
    """Null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


BATCH = 8 << 20


def small_batches(spark) -> None:
    """No more than BATCH bytes (or one row) at once between Spark and Python, on both sides; the session's setting is lowered where it is larger. 10,000 rows of long texts would fill a worker's memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.sub(r"\D", "", spark.conf.get(name))) <= BATCH:
        spark.conf.set(name, str(BATCH))


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], start: Callable[[], Callable], keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all columns) and the new fields; a kept column with a new field's name gives way to it.

    start() is called once in each task; what it returns turns a list of texts (bytes) into one Arrow array or list for each field."""
    small_batches(df.sparkSession)
    new = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, types = start(), to_arrow_schema(schema)
        for batch in batches:
            column = batch.column(len(kept))
            lengths = column.cast(pa.binary()).to_pylist() if len(column) == 0 else pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
            for a, b in slices(lengths):
                part = batch.slice(a, b - a)
                made = [x if isinstance(x, pa.Array) else pa.array(x, type=types.field(len(kept) + i).type) for i, x in enumerate(work(texts_of(part.column(len(kept)))))]
                yield pa.RecordBatch.from_arrays([*(part.column(i).cast(types.field(i).type) for i in range(len(kept))), *made], schema=types)

    return df.select(*(df[c] for c in kept), df[text].alias(*fresh(df, "text"))).mapInArrow(run, schema)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of df has, however it is cased."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        own = next(c for c in itertools.chain([f"_{name}"], (f"_{name}_{i}" for i in itertools.count(2))) if c.lower() not in taken)
        taken.add(own.lower())
        out.append(own)
    return out


def flat(lists: Iterable[list]) -> list:
    return list(itertools.chain.from_iterable(lists))
