"""Runs of lines, and passages of words, that repeat across (or within) documents: found by winnowing and cut where they come again."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import forget, materialised, stored
from .words import LOWER, fresh, numbers, slices, small_batches, texts_of

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SPANS = "array<struct<start:int,end:int>>"
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Multiplier of the polynomial over a run of hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def chosen(h: np.ndarray, w: int, counts: np.ndarray) -> np.ndarray:
    """Places that hold the least hash of some w hashes in a row; counts[j]: whether the w from j on count. Of a row of equal hashes every w-th and the last are enough."""
    low, have = h, 1
    while have < w:
        step = min(have, w - have)
        low, have = np.minimum(low[: len(low) - step], low[step:]), have + step
    # h[i] is the least of a window if it equals the largest of the minima of the windows that hold it
    low = np.where(counts[: len(low)], low, 0).astype(h.dtype)
    edge = np.zeros(w - 1, h.dtype)
    top, have = np.concatenate([edge, low, edge]), 1
    while have < w:
        step = min(have, w - have)
        top, have = np.maximum(top[: len(top) - step], top[step:]), have + step
    at = np.nonzero((top == h) & (h > 0))[0]
    if not len(at):
        return at
    new = np.concatenate([[True], (h[at[1:]] != h[at[:-1]]) | (at[1:] != at[:-1] + 1)])
    begin = at[new][np.cumsum(new) - 1]
    return at[((at - begin) % w == 0) | np.concatenate([new[1:], [True]])]


def stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """64-bit hashes of any runs of units in O(1) each, from sums of hash times a power of BASE."""

    powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, units: np.ndarray):
        while len(Hashed.powers[0]) <= len(units):
            factors = np.ones(max(1 << 16, 2 * len(units)), np.uint64)
            made = []
            for x in (BASE, INVERSE):
                factors[1:] = x
                made.append(np.multiply.accumulate(factors))
            Hashed.powers = tuple(made)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(stirred(units) * Hashed.powers[0][: len(units)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return stirred((self.sums[end] - self.sums[start]) * Hashed.powers[1][start] + (end - start).astype(np.uint64))


class Texts:
    """The units of some texts, one after the other: words, and lines with a word, as hashes; and where each line's words begin."""

    def __init__(self, texts: list[bytes]):
        self.words, self.ends = numbers(texts, LOWER, xxhash.xxh64_intdigest, np.uint64)
        data = np.frombuffer(b"\n".join([b"", *texts]), np.uint8)
        space = SPACE[data]
        begins = np.nonzero(~space[1:] & space[:-1])[0] + 1
        line = np.searchsorted(np.nonzero(data == 10)[0], begins)
        self.first = np.nonzero(np.diff(line, prepend=-1))[0]
        self.runs = Hashed(self.words)
        self.lines = self.runs.of(self.first, np.append(self.first[1:], len(self.words))) if len(self.first) else np.empty(0, np.uint64)
        self.line_ends = np.searchsorted(self.first, self.ends)

    def kind(self, lines: bool) -> tuple[np.ndarray, np.ndarray, Hashed]:
        return (self.lines, self.line_ends, Hashed(self.lines)) if lines else (self.words, self.ends, self.runs)

    def as_words(self, lines: bool, at: np.ndarray) -> np.ndarray:
        """Places of units as places of words."""
        return np.append(self.first, len(self.words))[at] if lines else at


def split(least: int) -> tuple[int, int]:
    """k, w: of windows of k units each w in a row are `least` units. Longer ones are rarer, but so more of them are fingerprints."""
    return least // 2 + 1, least - least // 2


def batched(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Rows and the units of their texts (column `at`), a bounded number of bytes (or one text) at a time."""
    for b in batches:
        for x, y in slices(pa.compute.fill_null(pa.compute.binary_length(b.column(at)), 0).to_pylist()):
            yield (part := b.slice(x, y - x)), Texts(texts_of(part.column(at)))


def fingerprints(docs: DataFrame, text: str, sizes: dict[bool, int]) -> DataFrame:
    """(fp, context, k1, k2, start, end, lines) for each chosen window: its hash, that of it with w - 1 units on either side (as far as the text goes), and the words of these.

    Windows of sizes[lines] units that hold the chosen one are those of its context: equal contexts have equal windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in batched(batches, 2):
            out = []
            for lines, least in sizes.items():
                (units, ends, runs), (k, w) = found.kind(lines), split(least)
                n = len(units)
                if n < least:
                    continue
                text_end = np.repeat(ends[1:], np.diff(ends))
                here = np.arange(n - k + 1)
                h = np.where(here + k <= text_end[: n - k + 1], runs.of(here, here + k), np.uint64(0xFFFFFFFFFFFFFFFF))
                pos = chosen(h, w, here + least <= text_end[: n - k + 1])
                row = np.searchsorted(ends, pos, "right") - 1
                start, end = np.maximum(pos - w + 1, ends[row]), np.minimum(pos + k + w - 1, ends[row + 1])
                seed = np.uint64(lines)
                around = stirred(runs.of(start, end) + ((pos - start) << 32).astype(np.uint64) + (end - pos).astype(np.uint64))
                base = found.ends[row]
                out.append((h[pos] ^ seed, around ^ seed, *(part.column(i).to_numpy(zero_copy_only=False)[row] for i in (0, 1)), found.as_words(lines, start) - base, found.as_words(lines, end) - base, np.full(len(pos), lines)))
            if out:
                fp, around, k1, k2, start, end, lines = (np.concatenate(x) for x in zip(*out))
                columns = [fp.view(np.int64), around.view(np.int64), k1, k2, start.astype(np.int32), end.astype(np.int32), lines]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["fp", "context", "k1", "k2", "start", "end", "lines"])

    return docs.mapInArrow(run, "fp long, context long, k1 long, k2 long, start int, end int, lines boolean")


def windows(docs: DataFrame, sizes: dict[bool, int]) -> DataFrame:
    """(h, k1, k2, start, end): hashes and words of the windows within the contexts of docs(k1, k2, contexts, text), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in batched(batches, 3):
            contexts = part.column(2)
            row = np.repeat(np.arange(len(part)), pa.compute.list_value_length(contexts).to_numpy(zero_copy_only=False))
            a, z, kind = (contexts.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            a, z = a + found.ends[row], z + found.ends[row]
            out = []
            for lines, least in sizes.items():
                _, ends, runs = found.kind(lines)
                x, y = (np.searchsorted(found.first, v[kind == lines]) if lines else v[kind == lines] for v in (a, z))
                count = y - x - least + 1
                begin = np.repeat(x, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                begin = np.unique(begin)
                of = np.searchsorted(ends, begin, "right") - 1
                start, end = found.as_words(lines, begin), found.as_words(lines, begin + least)
                out.append((runs.of(begin, begin + least) ^ np.uint64(lines), *(part.column(i).to_numpy(zero_copy_only=False)[of] for i in (0, 1)), start - found.ends[of], end - found.ends[of]))
            h, k1, k2, start, end = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), k1, k2, start.astype(np.int32), end.astype(np.int32))], names=["h", "k1", "k2", "start", "end"])

    return docs.mapInArrow(run, "h long, k1 long, k2 long, start int, end int")


def united(spans: DataFrame) -> DataFrame:
    """(k1, k2, spans) of (k1, k2, start, end): those that touch or overlap joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            found = []
            for x in b.column(2):
                start, end = (x.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                order = np.argsort(start)
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.nonzero(start[1:] > end[:-1])[0]
                found.append([{"start": s, "end": e} for s, e in zip(start[[0, *(new + 1)]].tolist(), end[[*new, -1]].tolist())])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, kind)], names=["k1", "k2", "spans"])

    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("all")).mapInArrow(run, f"k1 long, k2 long, spans {SPANS}")


def place() -> Column:
    """The order of places as one number: document, a part of its text's hash, first word."""
    return F.col("k1").cast("decimal(20,0)") * F.lit(1 << 62).cast("decimal(19,0)") + (F.shiftrightunsigned("k2", 33) * F.lit(1 << 31) + F.col("start")).cast("decimal(19,0)")


def repeated(docs: DataFrame, *, min_words: int = 50, min_lines: int = 3) -> DataFrame:
    """(k1, k2, spans) of docs(k1, k2, text) that hold repeated runs: the words to cut, which are those of each min_lines lines and of each min_words words that came before.

    Winnowing twice over: of windows of k lines (of k words) each w in a row are min_lines (min_words), and the least of them is a fingerprint, so
    that equal runs share one. Places of fingerprints that come more than once are joined; a match reaches w - 1 units to both ways, its context.
    Where a context came before, all its windows did: they are cut. What is left are first places of contexts of a fingerprint that has
    several: their windows are hashed one by one, joined with the first place of each, and cut where that is another. Nothing depends on
    what surrounds the first place of a fingerprint, and nothing is compared with more than first places.
    Frequent keys become a row for each task before the shuffle, and the joins back can be split by adaptive execution."""
    small_batches(docs.sparkSession)
    spark, sizes = docs.sparkSession, {True: min_lines, False: min_words}
    every, of_every = stored(fingerprints(docs, "text", sizes), "fingerprints")
    # what is joined is kept apart from the join, whose sides are then plain shuffles that adaptive execution can split at a frequent key
    again, of_again = stored(every.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "again")
    places, of_places = stored(every.join(again, "fp"), "places")
    forget(spark, of_every, of_again)
    contexts, of_contexts = stored(places.groupBy("fp", "context").agg(F.min(place()).alias("first"), F.count("*").alias("n")), "contexts")
    several, of_several = stored(contexts.groupBy("fp").agg(F.count("*").alias("contexts")).where("contexts > 1").select("fp"), "several")
    open_ = contexts.join(several, "fp", "left_semi").select("fp", "context", F.lit(True).alias("open"))
    known = contexts.join(open_, ["fp", "context"], "left").where("n > 1 or open").select("fp", "context", "first", F.coalesce("open", F.lit(False)).alias("open"))
    known, of_known = stored(known, "known")
    forget(spark, of_contexts, of_several)
    later = place() > F.col("first")
    marked, of_marked = stored(places.join(known, ["fp", "context"]).where(later | F.col("open")).select("k1", "k2", "start", "end", "lines", later.alias("later")), "marked")
    forget(spark, of_places, of_known)
    lists = materialised(marked.where("not later").groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end", "lines")).alias("contexts")))
    found, of_found = stored(windows(docs.join(lists, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("k1", "k2", "contexts", "text"), sizes), "windows")
    forget(spark)
    first, of_first = stored(found.groupBy("h").agg(F.min(place()).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first"), "first")
    repeats = found.join(first, "h").where(place() > F.col("first")).select("k1", "k2", "start", "end")
    out = materialised(united(marked.where("later").select("k1", "k2", "start", "end").unionByName(repeats)))
    forget(spark, of_marked, of_found, of_first)
    return out


def without(text: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """The text without the words of the spans (lines that lose all their words go), how many words are left, and how many there were."""
    at = [m.span() for m in WORD.finditer(text)]
    out, done = b"", 0
    for s in [*spans, None]:
        piece = text[done : at[s["start"]][0]] if s else text[done:]
        if done and (not out or out.endswith(b"\n")):
            piece = piece.lstrip(b" \t\n\r\x0b\x0c")
        elif done and piece.startswith((b"\n", b"\r")):
            out = out.rstrip(b" \t")
        elif done:
            piece = piece.lstrip(b" \t")
        out += piece
        done = at[s["end"] - 1][1] if s else done
    return out, len(at) - sum(s["end"] - s["start"] for s in spans), len(at)


def marked(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", carry: list[Column] | None = None, **how) -> DataFrame:
    """docs (or the columns of `carry`) and spans, the words to cut as (from, to); empty for most.

    Documents come in the order of doc (an integer; null last), then of the text hash: the first place of a run stays. Rows that agree in doc and text
    are one document: they get the same spans, and don't count as repeats of each other. Null and empty texts have no runs, no rows give no rows.
    Whole texts are compared, of any length; every repeat is linked to the first place, never to all others. Words are compared with A-Z lower-cased, lines by
    their words; lines without a word don't count. A column `spans` of docs gives way; any other name may be there."""
    k1, k2, spans, _ = fresh(docs, "k1", "k2", "spans", "text")
    rows = docs.withColumns({k1: F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)), k2: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    found = repeated(rows.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(text).alias("text")), **how)
    kept = [F.col(c) for c in docs.columns if c != "spans"] if carry is None else carry
    joined = rows.select(*kept, k1, k2).join(found.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans)), [k1, k2], "left")
    return joined.withColumn("spans", F.coalesce(spans, F.array().cast(SPANS))).drop(k1, k2, *([spans] if spans != "spans" else []))


def cut(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", least_words: int = 0, least_share: float = 0.0, **how) -> DataFrame:
    """The documents' own columns, which may have any name, later repeats cut out of the texts.

    Documents of which nothing is left are dropped, and those that keep both fewer than least_words words and less than least_share of them: remnants of near-copies. Those that lose nothing stay.

    See marked() for nulls, ties, repeated rows, long texts and empty tables."""
    # the columns go through marked() under names that it hasn't
    own = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    rows = marked(docs.select(*(docs[c].alias(n) for c, n in own.items())), doc=own[doc], text=own[text], **how)
    names, at = list(own.values()), docs.columns.index(text)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("gone", T.BooleanType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        for b in batches:
            spans = b.column(len(names)).to_pylist()
            texts, gone = b.column(at).to_pylist(), np.zeros(len(b), bool)
            for i, s in enumerate(spans):
                if s:
                    left, n, whole = without(texts[i].encode(), s)
                    texts[i], gone[i] = left.decode(), not n or n < least_words and n < least_share * whole
            columns = [pa.array(texts, types.field(i).type) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone)], schema=types)

    left = rows.mapInArrow(run, schema).where(~F.col("gone"))
    return left.select(*(F.col(n).alias(c) for c, n in own.items()))
