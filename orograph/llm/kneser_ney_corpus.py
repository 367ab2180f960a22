"""The model of kneser_ney.py learned from a table and laid on the same table, shard by shard: n-grams of all orders meet where they are counted, so that no model is kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .kneser_ney import END, WORDS, Table, Vocabulary, discounts, mixed, part_column, part_of, power_of_two, runs, taken, vocabulary
from .shared import Folder, forget, stored
from .words import LOWER, fresh, numbers, small_batches, texts_of

#: Tokens that a shard is meant to hold; a word that comes more often is hot. Tokens that a task gathers before it deals them out.
SHARD, GATHERED = 1_000_000, 1_000_000
#: Numbers of the start of a text and of words that were not learned; learned words follow, frequent ones first.
START, UNKNOWN = 0, 1

#: What a shard says: how many n-grams of an order have a count of 1 to 4; n-grams whose context does not name a shard.
COUNTS, SPLIT = range(2)
SAID = "what int, n int, context long, w long, c long"


class Plan:
    """Numbers of words, and the shard of each n-gram.

    The last word of the context names the shard; where it is hot, the word before it too, and so on for as many hot words as there are. N-grams of which
    the whole context is hot are split over shards: their counts are added up apart. All others are whole in one shard, at every order."""

    def __init__(self, words: Vocabulary, order: int, limit: int):
        self.words, self.order, self.shards = words, order, max(8, -(-words.tokens // limit))
        self.kind, self.files = "<u4", {}
        self.hot, self.bits, self.deepest = np.zeros(0, np.uint64), 1, 1

    def __getstate__(self):
        return self.__dict__ | {"files": {}}

    def number(self, spark: SparkSession) -> "Plan":
        """Numbers the words of each part by how often they come; looks for hot words."""
        words, limit, folder, parts = self.words, max(1, self.words.tokens // self.shards), self.words.table.folder, self.words.parts
        sizes = np.diff(words.before())
        self.kind = "<u4" if (int(sizes.max(initial=0)) + 1) * parts + 2 < 1 << 32 else "<u8"

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for p in b.column(0).to_pylist():
                    if (file := words.table.part(p)) is None:
                        continue
                    order = np.argsort(-file[1].astype(np.int64), kind="stable")
                    places = np.empty(len(order), np.uint64)
                    places[order] = np.arange(len(order), dtype=np.uint64)
                    folder.write(f"ranks-{p}", places.astype("<u4"))
                    hot = np.nonzero(file[1] > limit)[0]
                    ids = places[hot] * np.uint64(parts) + np.uint64(p + 2)
                    starts = np.full(int((file[0][hot] == END).sum()), START, np.uint64)  # as many starts as ends
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, starts]).astype(np.int64))], names=["id"])

        found = spark.range(parts, numPartitions=min(parts, 64)).mapInArrow(rank, "id long").collect()  # no more rows than shards
        self.hot = np.sort(np.array([r.id for r in found], np.uint64))
        self.bits = max(1, len(self.hot).bit_length())
        self.deepest = min(self.order - 1, 63 // self.bits + 1) if len(self.hot) else 1
        return self

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each word."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts, table = np.full(len(distinct), UNKNOWN, self.kind), np.zeros(len(distinct), np.int64), self.words.table
        parts = part_of(distinct, self.words.parts)
        for at, place in table.places(parts, distinct):
            p = int(parts[at[0]])
            if p not in self.files:
                (self.files[p],) = self._ranks(p)
            ids[at] = self.files[p][place].astype(np.uint64) * np.uint64(self.words.parts) + np.uint64(p + 2)
            counts[at] = table.part(p)[1][place]
        return ids[back], counts[back]

    def _ranks(self, p: int) -> list[np.ndarray]:
        return self.words.table.folder.read(f"ranks-{p}", "<u4")

    def place_of_hot(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is hot, and its place among the hot ones."""
        place = np.searchsorted(self.hot, ids)
        place[place == len(self.hot)] = 0
        return (self.hot[place] == ids if len(self.hot) else np.zeros(len(ids), bool)), place.astype(np.uint64)

    def depth(self, columns: list[np.ndarray]) -> np.ndarray:
        """How many words of its context name an n-gram's shard."""
        out, hot = np.ones(len(columns[0]), np.uint8), np.ones(len(columns[0]), bool)
        for k in range(1, self.deepest):
            hot &= self.place_of_hot(columns[-1 - k])[0]
            out += hot
        return out

    def shard(self, columns: list[np.ndarray]) -> np.ndarray:
        depth, h = self.depth(columns), mixed(columns[-2].astype(np.uint64))
        for k in range(2, self.deepest + 1):
            at = np.nonzero(depth >= k)[0]
            h[at] = mixed(mixed(h[at] + np.uint64(0x632BE59BD9B4E019)) + columns[-1 - k][at].astype(np.uint64))
        return (mixed(h) % np.uint64(self.shards)).astype(np.int64)

    def context(self, columns: list[np.ndarray], n: int) -> np.ndarray:
        """A hot context as one number, its last word in the lowest bits."""
        out = np.zeros(len(columns[0]), np.uint64)
        for k in range(1, n):
            out |= self.place_of_hot(columns[-1 - k])[1] << np.uint64(self.bits * (k - 1))
        return out

    def tokens(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """N-grams of the texts as a column for each place, the tokens' counts, the texts' bounds."""
        hashes, ends = numbers(texts, LOWER, xxhash.xxh64_intdigest, np.uint64, between=END)
        own, counts = self.of(hashes)
        place = np.arange(len(own)) - np.repeat(ends[:-1], np.diff(ends))
        return [np.where(place >= lag, np.roll(own, lag), own.dtype.type(START)) for lag in range(self.order - 1, 0, -1)] + [own], counts, ends


def planes(*arrays: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unplaned(blob: bytes, *shapes: tuple[int, str]) -> list[np.ndarray]:
    raw, out, at = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little")), np.uint8), [], 0
    for n, kind in shapes:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(-1))
        at += n * size
    return out


BLOB = "shard int, batch long, texts int, grams int, places int, blob binary, docs binary"


def dealt(plan: Plan, columns: list[np.ndarray], learned: np.ndarray, text: np.ndarray | None, batch: int, texts: int) -> pa.RecordBatch:
    """Rows of BLOB, one a shard: distinct n-grams, how often they are learned and, if asked for, the texts that they stand in."""
    key, rest = columns[-2].astype(np.uint64) << np.uint64(40), columns[-1].astype(np.uint64)
    if len(columns) > 2:
        key ^= columns[-3].astype(np.uint64) << np.uint64(16)
        for c in columns[:-3]:
            rest = mixed(rest) + c
    order = np.argsort(key ^ (mixed(mixed(rest)) >> np.uint64(48)))  # equal n-grams stand together, alike ones near; a missed one is added up later
    shard = plan.shard(columns)
    order = order[np.argsort(shard[order].astype(np.uint16 if plan.shards < 1 << 16 else np.int64), kind="stable")]
    shard, columns = shard[order], [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = shard[1:] != shard[:-1]
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.nonzero(new)[0]
    counts, often = np.add.reduceat(learned[order], at, dtype=np.uint32), np.diff(at, append=len(order)).astype("<u4")
    shard, columns = shard[at], [c[at] for c in columns]
    cuts, rows = np.nonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))[0], []
    places = np.append(at, len(order))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = [c[a:b] for c in columns]
        own[-2] = np.diff(own[-2], prepend=own[-2].dtype.type(0))
        docs = b"" if text is None else planes(often[a:b], text[order[places[a] : places[b]]].astype("<u4"))
        rows.append((int(shard[a]), batch, texts, b - a, int(places[b] - places[a]), planes(*own, counts[a:b].astype("<u4")), docs))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in BLOB.split(", ")])


def by_shard(df: DataFrame) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "shard").sortWithinPartitions("shard")


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of BLOB, a shard at a time."""
    now, held = None, []
    for b in batches:
        for row in b.to_pylist():
            if now is not None and row["shard"] != now:
                yield held
                held = []
            now = row["shard"]
            held.append(row)
    if held:
        yield held


class Level:
    """The n-grams of one order in a shard."""

    def __init__(self, keys: np.ndarray, of_row: np.ndarray, contexts: int):
        #: Of each n-gram: its context's place; of each row: its n-gram's place; a row of each n-gram.
        self.context, self.of_row, self.contexts = (keys >> np.uint64(32)).astype(np.int32), of_row.astype(np.int32), contexts
        self.row = np.empty(len(keys), np.int32)
        self.row[of_row] = np.arange(len(of_row), dtype=np.int32)
        self.split = self.counts = None


class Shard:
    """All orders of the n-grams of a shard. Rows are the n-grams of its blobs, one after another; equal ones may come again."""

    def __init__(self, plan: Plan, blobs: list[dict]):
        self.plan, n = plan, plan.order
        found = [unplaned(b["blob"], *[(b["grams"], plan.kind)] * n, (b["grams"], "<u4")) for b in blobs]
        for x in found:
            x[-3] = np.cumsum(x[-3], dtype=x[-3].dtype)
        *self.columns, learned = (np.concatenate(x) for x in zip(*found))
        del found, x
        self.ends = np.cumsum([0, *(b["grams"] for b in blobs)])
        self.levels: dict[int, Level] = {}
        depth, last, context = plan.depth(self.columns), self.narrow(self.columns[-1]), None
        for k in range(1, n):
            word = self.narrow(self.columns[-1 - k])
            _, context = np.unique(word if context is None else (context << np.uint64(32)) | word, return_inverse=True)
            context = context.astype(np.uint64)
            keys, of_row = np.unique((context << np.uint64(32)) | last, return_inverse=True)
            level = self.levels[k + 1] = Level(keys, of_row, int(context.max()) + 1)
            level.split = depth[level.row] > k
        level = self.levels[n]
        level.counts = np.bincount(level.of_row, learned, len(level.row)).astype(np.int64)
        for k in range(n - 1, 0, -1):  # below the highest order: words that come before
            longer = self.levels[k + 1]
            whole = (longer.counts > 0) & ~longer.split
            if k > 1:
                lower = self.levels[k]
                lower.counts = np.bincount(lower.of_row[longer.row[whole]], minlength=len(lower.row))
            else:
                self.ones = np.unique(self.columns[-1][longer.row[whole]], return_counts=True)

    @staticmethod
    def narrow(ids: np.ndarray) -> np.ndarray:
        """In 32 bits."""
        return (ids if ids.itemsize == 4 else np.unique(ids, return_inverse=True)[1]).astype(np.uint64)

    def said(self) -> pa.RecordBatch:
        out = [(np.full(len(self.ones[0]), SPLIT), np.ones(len(self.ones[0])), np.zeros(len(self.ones[0])), *self.ones)]
        for n, level in self.levels.items():
            whole, at = level.counts[~level.split], np.nonzero(level.split & (level.counts > 0))[0]
            out.append((np.full(4, COUNTS), np.full(4, n), np.zeros(4), np.arange(1, 5), np.array([(whole == k).sum() for k in range(1, 5)])))
            if len(at):
                own = [c[level.row[at]] for c in self.columns]
                out.append((np.full(len(at), SPLIT), np.full(len(at), n), self.plan.context(own, n), own[-1], level.counts[at]))
        names, kinds = zip(*(x.split() for x in SAID.split(", ")))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a.astype(np.int32 if k == "int" else np.int64) for a in x])) for x, k in zip(zip(*out), kinds)], names=list(names))

    def log10(self, model: "Learned") -> np.ndarray:
        """Of each row."""
        p = model.alone(self.columns[-1][self.levels[2].row])
        for n, level in self.levels.items():
            d, counts = model.cuts[n], level.counts
            sums = lambda x: np.bincount(level.context, x, level.contexts)  # noqa: E731, B023
            total = sums(counts)
            left = (d[0] * sums(counts == 1) + d[1] * sums(counts == 2) + d[2] * sums(counts > 2)) / np.maximum(total, 1)
            spare = np.where(total > 0, left, 1.0)
            counts, total, spare = counts.astype(np.float64), total[level.context], spare[level.context]
            if (at := np.nonzero(level.split)[0]).size:
                own = [c[level.row[at]] for c in self.columns]
                counts[at], total[at], spare[at] = model.of_split(n, self.plan.context(own, n), own[-1])
            if n > 2:
                p = p[self.levels[n - 1].of_row[level.row]]
            p = (counts - taken(counts, d)) / np.maximum(total, 1) + spare * p
        return np.log10(p)[self.levels[self.plan.order].of_row]


def split_key(context: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(mixed(context.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) + w.astype(np.uint64))


class Learned:
    """What holds for all shards: discounts, words without context, and n-grams that are split over shards, in files."""

    def __init__(self, folder: Folder, plan: Plan):
        self.folder, self.cuts = folder, {}
        self.words, self.total, self.even = Table(folder, "ones", "<u8"), 0, 1.0
        self.grams = {n: Table(folder, f"split{n}", "<u8") for n in range(2, plan.deepest + 1)}
        self.contexts = {n: Table(folder, f"hot{n}", "<f8", "<f8") for n in range(2, plan.deepest + 1)}
        self.parts: dict[int, tuple[int, int]] = {}

    def alone(self, ids: np.ndarray) -> np.ndarray:
        """The words' probability without context."""
        distinct, back = np.unique(ids, return_inverse=True)
        (counts,) = self.words.look_up((distinct // WORDS).astype(np.int64), distinct.astype(np.uint64), 0)
        return (self.even + (counts - taken(counts, self.cuts[1])) / max(self.total, 1))[back]

    def of_split(self, n: int, context: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
        """Count, the context's sum of counts, and what it leaves to shorter n-grams."""
        key, (grams, contexts) = split_key(context, w), self.parts[n]
        (counts,) = self.grams[n].look_up(part_of(key, grams), key, 0)
        distinct, back = np.unique(mixed(context + np.uint64(1)), return_inverse=True)
        total, spare = self.contexts[n].look_up(part_of(distinct, contexts), distinct, 0.0, 1.0)
        return counts, total[back], spare[back]


def write(df: DataFrame, table: Table) -> None:
    """Rows (part, key, values) as the table's files."""
    kinds = table.kinds

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (key, *values) in runs(batches):
            order = np.argsort(key.view(np.uint64))
            table.write(part, key.view(np.uint64)[order], *(v[order].astype(k) for v, k in zip(values, kinds)))
            yield pa.RecordBatch.from_arrays([pa.array([part])], names=["part"])

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, "part").sortWithinPartitions("part").mapInArrow(work, "part long").count()


def keyed(df: DataFrame, key, schema: str) -> DataFrame:
    """Rows whose first `key` columns are turned into one: key(columns) as a long."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            n = len(columns) - len(names) + 1
            yield pa.RecordBatch.from_arrays([pa.array(key(*(c.view(np.uint64) for c in columns[:n])).view(np.int64)), *map(pa.array, columns[n:])], names=names)

    return df.mapInArrow(work, schema)


def learn(docs: DataFrame, text: str, plan: Plan, folder: Folder) -> Learned:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            return dealt(plan, columns, np.ones(len(columns[0]), bool), None, 0, 0)

        for b in batches:
            for a in range(0, b.num_rows, 500):
                held.append(plan.tokens(texts_of(b.column(0).slice(a, 500)))[0])
                if sum(len(x[0]) for x in held) >= GATHERED:
                    yield flush()
        if held:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in shards(batches):
            yield Shard(plan, blobs).said()

    spark, model, folders = docs.sparkSession, Learned(folder, plan), []
    said = by_shard(docs.select(text).mapInArrow(deal, BLOB)).mapInArrow(count, SAID).groupBy("what", "n", "context", "w").agg(F.sum("c").alias("c"))
    said, own = stored(said, "kneser-ney-said")
    forget(spark)
    seen = {n: [0] * 4 for n in range(1, plan.order + 1)}
    for r in said.where(F.col("what") == COUNTS).collect():  # four rows an order
        seen[r.n][r.w - 1] += r.c
    longer, c = None, F.col("c")
    for n in range(plan.deepest, 0, -1):
        rows = said.where((F.col("what") == SPLIT) & (F.col("n") == n)).select("context", "w", "c")
        if longer is not None:
            rows = rows.unionByName(longer.select(F.col("context").bitwiseAND(F.lit((1 << plan.bits * (n - 1)) - 1).cast("long")).alias("context"), "w", F.lit(1).cast("long").alias("c")))
        longer, table = stored(rows.groupBy("context", "w").agg(F.sum("c").alias("c")), "kneser-ney-split")
        folders.append(table)
        found = longer.agg(*(F.count_if(c == k).alias(f"n{k}") for k in range(1, 5)), F.count_if(c > 2).alias("up"), F.sum("c").alias("total"), F.count("*").alias("rows")).first()
        model.cuts[n] = d = discounts(*(s + found[f"n{k}"] for k, s in enumerate(seen[n], 1)))
        if n == 1:
            model.total = found.total or 0
            model.even = ((d[0] * found.n1 + d[1] * found.n2 + d[2] * found.up) / model.total if model.total else 1.0) / (plan.words.size + 1)
            write(longer.select(F.floor(F.col("w") / WORDS).cast("long").alias("part"), "w", "c"), model.words)
        else:
            contexts = longer.groupBy("context").agg(F.sum("c").cast("double").alias("total"), *(F.count_if(x).alias(f"n{k}") for k, x in enumerate((c == 1, c == 2, c > 2), 1)))
            contexts = contexts.select("context", "total", ((d[0] * F.col("n1") + d[1] * F.col("n2") + d[2] * F.col("n3")) / F.col("total")).alias("spare"))
            model.parts[n] = tuple([power_of_two(found.rows / WORDS)] * 2)
            for table, df in ((model.grams[n], keyed(longer, split_key, "key long, c long")), (model.contexts[n], keyed(contexts, lambda x: mixed(x + np.uint64(1)), "key long, total double, spare double"))):
                write(df.select(part_column("key", model.parts[n][0]).alias("part"), *df.columns), table)
    for n in range(plan.deepest + 1, plan.order + 1):
        model.cuts[n] = discounts(*seen[n])
    forget(spark, own, *folders)
    return model


def lay(docs: DataFrame, text: str, learned: str, keep: list[str], plan: Plan, model: Learned, folder: Folder) -> DataFrame:
    new = {"n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "perplexity": T.DoubleType()}
    kept = [c for c in keep if c not in new]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(n, k, False) for n, k in new.items())])
    names = [f"_{i}" for i in range(len(kept) + 2)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, batch, held, rows, texts, size = TaskContext.get().partitionId(), 0, [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal batch, texts, size
            columns, known, of = [np.concatenate(x) for x in zip(*(h[0] for h in held))], *(np.concatenate(x) for x in zip(*(h[1:] for h in held)))
            key = task << 24 | batch
            with pa.BufferOutputStream() as out:
                with pa.ipc.new_stream(out, rows[0].schema) as f:
                    for r in rows:
                        f.write_batch(r)
                folder.write(f"rows-{key}", np.frombuffer(out.getvalue(), np.uint8))
            made = dealt(plan, columns, known, of, key, texts)
            held.clear(), rows.clear()
            batch, texts, size = batch + 1, 0, 0
            return made

        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                columns, counts, ends = plan.tokens(texts_of(part.column(0)))
                n = np.diff(ends)
                held.append((columns, np.repeat(np.array([x is True for x in part.column(1).to_pylist()]), n), np.repeat(np.arange(texts, texts + len(n), dtype=np.uint32), n)))
                base = np.log10((counts + 1) / (plan.words.tokens + plan.words.size + 1))
                more = [pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(counts > 0, ends[:-1], dtype=np.int64)), pa.array(np.add.reduceat(base, ends[:-1]))]
                rows.append(pa.RecordBatch.from_arrays([*part.columns[2:], *more], names=[*names, "base"]))
                texts, size = texts + len(n), size + len(columns[0])
                if size >= GATHERED:
                    yield flush()
        if held:
            yield flush()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([planes(x) for x in sums.values()], pa.binary())], names=["batch", "blob"])
            sums.clear()
            return made

        for blobs in shards(batches):
            shard = Shard(plan, blobs)
            p = shard.log10(model)
            for b, x, y in zip(blobs, shard.ends[:-1], shard.ends[1:]):
                often, of = unplaned(b["docs"], (b["grams"], "<u4"), (b["places"], "<u4"))
                found = np.bincount(of, np.repeat(p[x:y], often), b["texts"])
                sums[b["batch"]] = sums[b["batch"]] + found if b["batch"] in sums else found
            if sum(len(x) for x in sums.values()) > 8 * SHARD:
                yield out()
        if sums:
            yield out()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema)

        def rows(batch: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
            (raw,), at = folder.read(f"rows-{batch}", "<u1"), 0
            for r in pa.ipc.open_stream(pa.py_buffer(raw)):
                lp = total[at : at + r.num_rows]
                at += r.num_rows
                n = r.column(len(kept)).to_numpy()
                columns = [*(r.column(i).cast(types.field(i).type) for i in range(len(kept) + 2)), r.column(len(kept) + 2), pa.array(lp), pa.array(10 ** np.minimum(-lp / n, 300))]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

        now, total = None, None
        for b in batches:
            for batch, blob in zip(b.column(0).to_pylist(), b.column(1)):
                blob = blob.as_py()
                found = unplaned(blob, (int.from_bytes(blob[:8], "little") // 8, "<f8"))[0]
                if now is not None and batch != now:
                    yield from rows(now, total)
                    total = None
                now, total = batch, found if total is None else total + found
        if now is not None:
            yield from rows(now, total)

    alias = fresh(docs, "text", "learned")
    dealt_out = docs.select(docs[text].alias(alias[0]), docs[learned].alias(alias[1]), *(docs[c] for c in kept)).mapInArrow(deal, BLOB)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_shard(dealt_out).mapInArrow(score, "batch long, blob binary").repartition(parts, "batch").sortWithinPartitions("batch").mapInArrow(join, schema)


def score_corpus(docs: DataFrame, learned: str, *, text: str = "text", order: int = 5, keep: list[str] | None = None) -> tuple[DataFrame, int]:
    """`keep` (default: all columns) and n_tokens, n_known, base_score, score (log10 probability), perplexity of all rows by the model of those where the column `learned` is true; and how many tokens were learned.

    The model is that of kneser_ney.train(), of any order from 2: every n-gram of every order is counted, no cutoff, no cap. N-grams go through one shuffle to be counted and, when the
    discounts are known, through one more to be counted again and scored; all orders of an n-gram are in the shard that its context names.
    Null and empty texts are their end alone; repeated rows count, and are scored, each time; texts of any length are taken whole; nothing learned gives a model of unknown words only; no rows: no rows."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark = docs.sparkSession
    small_batches(spark)
    folder = Folder(spark, "kneser-ney")
    known = docs.where(docs[learned])
    words = vocabulary(known, text, folder)
    forget(spark)
    plan = Plan(words, order, SHARD).number(spark)
    model = learn(known, text, plan, folder)
    scored, _ = stored(lay(docs, text, learned, docs.columns if keep is None else keep, plan, model, folder), "kneser-ney-scores")
    forget(spark, folder)
    return scored, words.tokens
