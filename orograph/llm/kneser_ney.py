"""Interpolated modified Kneser-Ney model of any order: counted in Spark, kept as sorted arrays that workers map into memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Folder, materialised
from .words import LOWER, map_texts, numbers, small_batches, texts_of

#: Hash of the end of a text, counted as a token; no word has a line end in it.
END = xxhash.xxh64_intdigest(b"\n")
#: N-grams that a shard is meant to hold, and that a task sorts at once.
GRAMS = 4_000_000
#: Words of a file of words.
WORDS = 1 << 20
#: Bits of a key. Word numbers of an n-gram that fit stand in it side by side, others are hashed into it.
KEY = 64


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney; where a count of counts is 0, the plain discount. Kept above 0, so that no probability is 0."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return tuple(min(float(k), max(0.05, k - (k + 1) * y * b / a if a and b else y)) for k, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1))


def taken(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count."""
    return np.where(counts == 0, 0.0, np.where(counts == 1, d[0], np.where(counts == 2, d[1], d[2])))


def mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def summed(keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, the sums of their counts, and a value of each further array."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.empty(0, int)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts, *(x[order[new]] for x in more)


class Grams:
    """Keys of n-grams of word numbers below 2**bits."""

    def __init__(self, n: int, bits: int):
        self.n, self.bits, self.whole = n, bits, n * bits <= KEY

    def keys(self, ids: list[np.ndarray]) -> np.ndarray:
        k = ids[0].astype(np.uint64)
        for x in ids[1:]:
            k = (k << np.uint64(self.bits)) | x.astype(np.uint64) if self.whole else mixed(mixed(k + np.uint64(0x632BE59BD9B4E019)) + x.astype(np.uint64))
        return k

    def ids(self, keys: np.ndarray) -> list[np.ndarray]:
        return [(keys >> np.uint64(self.bits * i)) & np.uint64((1 << self.bits) - 1) for i in range(self.n - 1, -1, -1)]

    def pack(self, keys: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> bytes:
        """Sorted keys (as differences) and counts as compressed byte planes; the numbers too where keys don't hold them."""
        columns = [np.diff(keys, prepend=np.uint64(0)), counts.astype(np.uint64), *([] if self.whole else [x.astype(np.uint64) for x in ids])]
        raw = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
        return len(keys).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)

    def unpack(self, blob: bytes) -> list[np.ndarray]:
        """Keys, counts, and the numbers where keys don't hold them."""
        n, columns = int.from_bytes(blob[:8], "little"), 2 + (0 if self.whole else self.n)
        raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], 8 * n * columns), np.uint8)
        found = [np.ascontiguousarray(raw[8 * n * i : 8 * n * (i + 1)].reshape(8, n).T).view(np.uint64).reshape(-1) for i in range(columns)]
        return [np.cumsum(found[0], dtype=np.uint64), found[1].astype(np.int64), *found[2:]]


class Table:
    """Sorted keys with values in files of the shared folder, by parts. A file is opened when a key of its part is looked up; a part without keys has none."""

    def __init__(self, folder: Folder, name: str, *kinds: str):
        self.folder, self.name, self.kinds, self.files = folder, name, kinds, {}

    def __getstate__(self):
        return self.__dict__ | {"files": {}}

    def part(self, p: int) -> list[np.ndarray] | None:
        if p not in self.files:
            self.files[p] = self.folder.read(f"{self.name}-{p}", "<u8", *self.kinds)
        return self.files[p]

    def write(self, p: int, keys: np.ndarray, *values: np.ndarray) -> None:
        self.folder.write(f"{self.name}-{p}", keys.astype("<u8"), *(v.astype(k) for v, k in zip(values, self.kinds)))

    def look_up(self, parts: np.ndarray, keys: np.ndarray, *missing: float) -> list[np.ndarray]:
        """The values of each key, `missing` for keys that are not there."""
        out = [np.full(len(keys), m, k) for m, k in zip(missing, self.kinds)]
        for at, place in self.places(parts, keys):
            values = self.part(int(parts[at[0]]))[1:]
            for to, v in zip(out, values):
                to[at] = v[place]
        return out

    def places(self, parts: np.ndarray, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each part: which of the keys it has, and where."""
        order = np.lexsort((keys, parts))
        cuts = np.nonzero(np.concatenate([[True], np.diff(parts[order]) != 0, [True]]))[0] if len(keys) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = order[a:b]
            if (file := self.part(int(parts[at[0]]))) is not None and len(file[0]):
                place = np.searchsorted(file[0], keys[at])
                place[place == len(file[0])] = 0
                hit = file[0][place] == keys[at]
                if hit.any():
                    yield at[hit], place[hit]


class Vocabulary:
    """Words by hash, in parts by leading bits; a word's number is its place in all of them together."""

    def __init__(self, folder: Folder, parts: int, size: int, tokens: int):
        self.table, self.parts, self.size, self.tokens = Table(folder, "words", "<u8"), parts, size, tokens
        self.start, self.unknown, self.bits = size, size + 1, (size + 2).bit_length()
        self.starts = None

    def __getstate__(self):
        return self.__dict__ | {"starts": None}

    def before(self) -> np.ndarray:
        """How many words come before each part."""
        if self.starts is None:
            self.starts = self.table.folder.read("words", "<u8")[0] if self.size else np.zeros(self.parts + 1, np.uint64)
        return self.starts

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each; unknown words have a number of their own and count 0."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts, starts = np.full(len(distinct), self.unknown, np.uint64), np.zeros(len(distinct), np.int64), self.before()
        parts = part_of(distinct, self.parts)
        for at, place in self.table.places(parts, distinct):
            p = int(parts[at[0]])
            ids[at] = place.astype(np.uint64) + starts[p]
            counts[at] = self.table.part(p)[1][place]
        return ids[back], counts[back]

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts by number; the start of a text is the most frequent context."""
        distinct, back = np.unique(ids, return_inverse=True)
        out, starts = np.where(distinct == self.start, self.tokens, 0).astype(np.int64), self.before()
        known = np.nonzero(distinct < self.size)[0]
        parts = np.searchsorted(starts, distinct[known], "right") - 1
        for p in np.unique(parts).tolist():
            at = known[parts == p]
            out[at] = self.table.part(p)[1][(distinct[at] - starts[p]).astype(np.int64)]
        return out[back]

    def tokens_of(self, texts: list[bytes], order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For each token of each text the numbers of the order - 1 tokens before it and its own, and their counts (the start of the text where there is none); and the texts' bounds."""
        hashes, ends = numbers(texts, LOWER, xxhash.xxh64_intdigest, np.uint64, between=END)
        own, count = self.look_up(hashes)
        place = np.arange(len(own)) - np.repeat(ends[:-1], np.diff(ends))
        ids, counts = [own], [count]
        for lag in range(1, order):
            inside = place >= lag
            ids.insert(0, np.where(inside, np.roll(own, lag), np.uint64(self.start)))
            counts.insert(0, np.where(inside, np.roll(count, lag), self.tokens))
        return ids, counts, ends


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """By leading bits; parts is a power of 2."""
    return (hashes >> np.uint64(65 - parts.bit_length())).astype(np.int64) if parts > 1 else np.zeros(len(hashes), np.int64)


def part_column(name: str, parts: int) -> F.Column:
    return F.shiftrightunsigned(name, 65 - parts.bit_length()) if parts > 1 else F.lit(0).cast("long")


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def vocabulary(docs: DataFrame, text: str, folder: Folder) -> Vocabulary:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            keys, n = summed(*map(np.concatenate, zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

        for b in batches:
            for a in range(0, b.num_rows, 500):
                held.append(np.unique(numbers(texts_of(b.column(0).slice(a, 500)), LOWER, xxhash.xxh64_intdigest, np.uint64, between=END)[0], return_counts=True))
                if sum(len(k) for k, _ in held) > GRAMS // 4:
                    held = [summed(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > GRAMS // 8:
                        yield out()
        if held:
            yield out()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialised(docs.select(text).mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")))
    size, tokens = counted.agg(F.count("*"), F.sum("n")).first()
    found = Vocabulary(folder, power_of_two(size / WORDS), size, tokens or 0)
    placed = counted.select(part_column("hash", found.parts).alias("part"), "hash", "n").repartition(n, "part").sortWithinPartitions("part")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (hashes, counts) in runs(batches):
            hashes = hashes.view(np.uint64)
            order = np.argsort(hashes)
            found.table.write(part, hashes[order], counts[order])
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([len(hashes)])], names=["part", "words"])

    sizes = np.zeros(found.parts, np.uint64)
    for r in placed.mapInArrow(write, "part long, words long").collect():  # a row for about a million words
        sizes[r.part] = r.words
    folder.write("words", np.concatenate([np.zeros(1, "<u8"), np.cumsum(sizes, dtype="<u8")]))
    return found


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows that come in order of their first column, by its value: the other columns as arrays."""
    held, now = [], None
    for b in batches:
        first = b.column(0).to_numpy(zero_copy_only=False)
        rest = [c.to_numpy(zero_copy_only=False) for c in b.columns[1:]]
        cuts = [0, *(np.nonzero(np.diff(first))[0] + 1).tolist(), len(first)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if x == y:
                continue
            if now is not None and first[x] != now:
                yield int(now), [np.concatenate(c) for c in zip(*held)]
                held = []
            now = first[x]
            held.append([c[x:y] for c in rest])
    if held:
        yield int(now), [np.concatenate(c) for c in zip(*held)]


class Model:
    """p(word | words before it); see train()."""

    def __init__(self, folder: Folder, vocabulary: Vocabulary, order: int):
        self.folder, self.vocabulary, self.order = folder, vocabulary, order
        self.shards = max(8, -(-vocabulary.tokens // GRAMS))
        self.codecs = {n: Grams(n, vocabulary.bits) for n in range(1, order + 1)}
        self.grams = {n: Table(folder, f"grams{n}", "<u8") for n in range(2, order + 1)}
        self.contexts = {n: Table(folder, f"contexts{n}", "<f8", "<f8") for n in range(3, order + 1)}
        #: By word number: how often it is a context, what that leaves to shorter n-grams, and its own share.
        self.words = Table(folder, "numbers", "<f8", "<f8", "<f8")
        self.cuts: dict[int, tuple] = {}
        self.even = 1.0

    def delete(self) -> None:
        self.folder.delete()

    def hot(self, counts: np.ndarray) -> np.ndarray:
        """Whether a word with this count would, as a context, fill a quarter of a shard."""
        return counts > self.vocabulary.tokens // (4 * self.shards)

    def shard(self, n: int, ids: list[np.ndarray], keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """N-grams of one context share a shard, but where the word before is hot they are dealt out."""
        return (mixed(np.where(hot, keys, self.codecs[n - 1].keys(ids[:-1]))) % np.uint64(self.shards)).astype(np.int64)

    def of_words(self, ids: np.ndarray, which: tuple[int, ...], missing: tuple[float, ...]) -> list[np.ndarray]:
        out = [np.full(len(ids), m) for m in missing]
        part = (ids // np.uint64(WORDS)).astype(np.int64)
        for p in np.unique(part).tolist():
            if (file := self.words.part(p)) is not None:
                at = np.nonzero(part == p)[0]
                for to, i in zip(out, which):
                    to[at] = file[i][(ids[at] % np.uint64(WORDS)).astype(np.int64)]
        return out

    def log10(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, sum of log10 p, and of log10 (count + 1) / (tokens + words + 1)."""
        v = self.vocabulary
        ids, counts, ends = v.tokens_of(texts, self.order)
        (p,) = self.of_words(ids[-1], (3,), (self.even,))
        for n in range(2, self.order + 1):
            own = ids[-n:]
            keys = self.codecs[n].keys(own)
            seen = self.grams[n].look_up(self.shard(n, own, keys, self.hot(counts[-2])), keys, 0)[0].astype(np.float64)
            if n == 2:
                total, spare = self.of_words(own[0], (1, 2), (0.0, 1.0))
            else:
                context = mixed(self.codecs[n - 1].keys(own[:-1]))
                total, spare = self.contexts[n].look_up(part_of(context, power_of_two(self.shards)), context, 0.0, 1.0)
            p = (seen - taken(seen, self.cuts[n])) / np.maximum(total, 1) + spare * p
        base = np.log10((counts[-1] + 1) / (v.tokens + v.size + 1))
        return np.diff(ends), np.add.reduceat(counts[-1] > 0, ends[:-1], dtype=np.int64), np.add.reduceat(np.log10(p), ends[:-1]), np.add.reduceat(base, ends[:-1])

    def score(self, docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
        """`keep` (default: all columns) and n_tokens, n_known, score (log10 probability), base_score, perplexity.

        A null or empty text is its end alone; texts of any length are scored whole; repeated rows get equal scores; no rows: no rows. Columns with the new names give way, others may have any name."""
        kinds = {"n_tokens": T.LongType(), "n_known": T.LongType(), "score": T.DoubleType(), "base_score": T.DoubleType(), "perplexity": T.DoubleType()}

        def start():
            def work(texts: list[bytes]) -> tuple:
                n, known, score, base = self.log10(texts)
                return tuple(pa.array(x) for x in (n.astype(np.int64), known, score, base, 10 ** np.minimum(-score / n, 300)))

            return work

        return map_texts(docs, text, [T.StructField(n, k, False) for n, k in kinds.items()], start, keep)


def of_texts(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """(shard, blob) of the highest order's n-grams: a few million tokens' distinct ones at a time, by shard."""
    n, codec = model.order, model.codecs[model.order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            keys, hot, *ids = (np.concatenate(x) for x in zip(*held))
            held.clear()
            found, counts, hot, *ids = summed(keys, np.ones(len(keys), np.int32), hot, *ids)
            ids = codec.ids(found) if codec.whole else ids
            return dealt(model, n, found, counts, ids, hot)

        for b in batches:
            for a in range(0, b.num_rows, 500):
                ids, counts, _ = model.vocabulary.tokens_of(texts_of(b.column(0).slice(a, 500)), n)
                held.append((codec.keys(ids), model.hot(counts[-2]), *([] if codec.whole else ids)))
                if sum(len(x[0]) for x in held) >= GRAMS:
                    yield flush()
        if held:
            yield flush()

    return docs.select(text).mapInArrow(count, "shard int, blob binary")


def dealt(model: Model, n: int, keys: np.ndarray, counts: np.ndarray, ids: list[np.ndarray], hot: np.ndarray) -> pa.RecordBatch:
    """Distinct n-grams (sorted by key) as a row for each shard."""
    shard = model.shard(n, ids, keys, hot)
    order = np.argsort(shard, kind="stable")
    cuts = np.nonzero(np.concatenate([[True], np.diff(shard[order]) != 0, [True]]))[0] if len(keys) else [0]
    rows = [(int(shard[order[a]]), model.codecs[n].pack(keys[order[a:b]], counts[order[a:b]], [x[order[a:b]] for x in ids])) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "blob"])


#: What a shard says: of n-grams with counts 1 to 4, of contexts (sum of counts, how many of counts 1, 2 and more), of last words (how many n-grams), and blobs of the next lower order.
COUNTS, CONTEXT, WORD, LOWER_ORDER = range(4)
SAID = "what int, key long, c long, n1 long, n2 long, n3 long, shard int, blob binary"


def stored(blobs: DataFrame, n: int, model: Model) -> DataFrame:
    """Writes the n-grams' sorted arrays, a file for each shard; gives what SAID names."""
    codec, context_codec = model.codecs[n], model.codecs[n - 1]

    def rows(what: int, keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        values = [v.astype(np.int64) for v in values]
        return [np.full(len(keys), what, np.int32), keys.view(np.int64), *values, *[np.zeros(len(keys), np.int64)] * (4 - len(values))]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SAID.split(", ")]

        def store(shard: int, keys: np.ndarray, counts: np.ndarray, *ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            ids = codec.ids(keys) if codec.whole else list(ids)
            model.grams[n].write(shard, keys, counts)
            said = [rows(COUNTS, np.array([1], np.uint64), *(np.array([int((counts == k).sum())]) for k in (1, 2, 3, 4)))]
            context = context_codec.keys(ids[:-1])
            order = np.argsort(context, kind="stable")
            at = np.nonzero(np.concatenate([[True], np.diff(context[order]) != 0]))[0]
            said.append(rows(CONTEXT, context[order[at]], *(np.add.reduceat(x[order].astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts > 2))))
            if n == 2:
                said.append(rows(WORD, *np.unique(ids[1], return_counts=True)))
            columns = [np.concatenate(x) for x in zip(*said)]
            none = [pa.nulls(len(columns[0]), pa.int32()), pa.nulls(len(columns[0]), pa.binary())]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *none], names=names)
            if n > 2:  # each distinct n-gram is one context more of what stands without its first word
                lower, found, *own = summed(context_codec.keys(ids[1:]), np.ones(len(keys), np.int64), *ids[1:])
                blobs = dealt(model, n - 1, lower, found, own, model.hot(model.vocabulary.counts(own[-2])))
                zeros = [pa.array(np.zeros(len(blobs), np.int64))] * 5
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blobs), LOWER_ORDER, np.int32)), *zeros, *blobs.columns], names=names)

        now, held, size = None, [], 0
        for b in batches:
            for shard, blob in zip(b.column(0).to_pylist(), b.column(1)):
                if now is not None and shard != now:
                    yield from store(now, *summed(*map(np.concatenate, zip(*held))))
                    held, size = [], 0
                now = shard
                held.append(codec.unpack(blob.as_py()))
                size += len(held[-1][0])
                if size > 2 * GRAMS:
                    held, size = [list(summed(*map(np.concatenate, zip(*held))))], 0
        if held:
            yield from store(now, *summed(*map(np.concatenate, zip(*held))))

    parts = int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blobs.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(write, SAID)


def train(docs: DataFrame, *, text: str = "text", order: int = 2) -> Model:
    """Counts all of docs and writes the model below the shared folder; delete() removes it (at the latest, the driver's end does).

    A token is a word (A-Z lower-cased) or the end of a text; order - 1 starts of the text come before its first one.
    p(w|h) = (c(hw) - D(c(hw))) / c(h) + g(h) p(w|h'), h' being h without its first word. For the highest order c counts n-grams, below it counts the
    words that come before them; what single words leave goes evenly to all words and one unknown word. Discounts D1, D2, D3+ of each order come from its counts of counts.
    Every n-gram is kept: no cutoff, no cap. Counts have 64 bits. A task maps the files that its words need.
    Repeated rows count each time; null and empty texts count one end; texts of any length are counted whole; an empty table gives a model of unknown words only."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    small_batches(docs.sparkSession)
    folder = Folder(docs.sparkSession, "kneser-ney")
    v = vocabulary(docs, text, folder)
    model = Model(folder, v, order)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = [F.sum(x).alias(x) for x in ("c", "n1", "n2", "n3")]
    blobs = of_texts(docs, text, model)
    for n in range(order, 1, -1):
        said = stored(blobs, n, model)
        said = materialised(said if n > 2 else said.drop("shard", "blob").groupBy("what", "key").agg(*sums))
        counts = said.where(F.col("what") == COUNTS).agg(*sums).first()
        model.cuts[n] = discounts(*(x or 0 for x in counts))
        if n > 2:
            blobs = said.where(F.col("what") == LOWER_ORDER).select("shard", "blob")
            write_contexts(said.where(F.col("what") == CONTEXT).groupBy("key").agg(*sums), n, model, n_parts)
    write_words(said, model, n_parts)
    return model


def spare(n: int, model: Model) -> F.Column:
    d = model.cuts[n]
    return (d[0] * F.col("n1") + d[1] * F.col("n2") + d[2] * F.col("n3")) / F.col("c")


def write_contexts(contexts: DataFrame, n: int, model: Model, n_parts: int) -> None:
    table, parts = model.contexts[n], power_of_two(model.shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = mixed(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(part_of(key, parts)), pa.array(key.view(np.int64)), *b.columns[1:]], names=["part", "key", "c", "spare"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (key, c, left) in runs(batches):
            order = np.argsort(key.view(np.uint64))
            table.write(part, key.view(np.uint64)[order], c[order], left[order])
            yield pa.RecordBatch.from_arrays([pa.array([part])], names=["part"])

    kept = contexts.select("key", F.col("c").cast("double").alias("c"), spare(n, model).cast("double").alias("spare"))
    placed = kept.mapInArrow(place, "part long, key long, c double, spare double").repartition(n_parts, "part").sortWithinPartitions("part")
    placed.mapInArrow(write, "part long").count()


def write_words(said: DataFrame, model: Model, n_parts: int) -> None:
    """The arrays by word number, from what the pairs' shards said: WORDS numbers a file."""
    k = F.col("c")
    low = said.where(F.col("what") == WORD).agg(*(F.count_if(k == i).alias(f"n{i}") for i in (1, 2, 3, 4)), F.count_if(k > 2).alias("n3up"), F.sum(k).alias("total")).first()
    d, total = discounts(low.n1, low.n2, low.n3, low.n4), low.total or 0
    model.cuts[1] = d
    even = model.even = ((d[0] * low.n1 + d[1] * low.n2 + d[2] * low.n3up) / total if total else 1.0) / (model.vocabulary.size + 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (ids, what, c, left) in runs(batches):
            totals, spares, lows = np.zeros(WORDS), np.ones(WORDS), np.full(WORDS, even)
            at, context = ids - part * WORDS, what == CONTEXT
            totals[at[context]], spares[at[context]] = c[context], left[context]
            lows[at[~context]] += (c[~context] - taken(c[~context], d)) / max(total, 1)
            model.words.write(part, np.zeros(0, np.uint64), totals, spares, lows)
            yield pa.RecordBatch.from_arrays([pa.array([part])], names=["part"])

    rows = said.where(F.col("what") != COUNTS).select(F.floor(F.col("key") / WORDS).cast("long").alias("part"), "key", "what", "c", F.when(F.col("what") == CONTEXT, spare(2, model)).otherwise(F.lit(0.0)).cast("double").alias("left"))
    rows.repartition(n_parts, "part").sortWithinPartitions("part").mapInArrow(write, "part long").count()
