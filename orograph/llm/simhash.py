"""SimHash fingerprints and near-duplicates by tiled exact comparison, of fingerprints or, with these as a filter, of shingles."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import materialised
from .words import LOWER, distinct, fresh, map_texts, numbers, rolling, words

#: Rows of a tile: a task compares one tile with itself or one other.
TILE = 2048
#: Shingles of a tile whose rows are compared by them.
SHINGLES = 4_000_000
#: Of a text's shingles so many, those with the least hashes, bring it together with others.
LEAST = 8


def spread(hashes: np.ndarray, parts: int) -> np.ndarray:
    """hashes[n, parts]: the hashes themselves, then each part mixed from the one before."""
    out = [hashes]
    for _ in range(parts - 1):
        h = out[-1] + np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(h ^ (h >> np.uint64(31)))
    return np.stack(out, axis=1)


def fingerprint(text: bytes, shingle: int, parts: int = 1) -> np.ndarray:
    """Bit b is set if more than half of the shingles' hashes (of 64 bits times parts) have it; shingles are runs of words joined by a blank, repeats included."""
    ones, n, tail = np.zeros(64 * parts, np.int64), 0, []
    for ws in words(text, LOWER):
        ws, tail = tail + ws, (tail + ws)[-(shingle - 1) :] if shingle > 1 else []
        if len(ws) < shingle:
            continue
        joined = b" ".join(ws)
        ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[: len(ws) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
        bits = np.unpackbits(spread(np.array(hashes, "<u8"), parts).view(np.uint8).reshape(-1, 8 * parts), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        n += len(hashes)
    if not n:
        return spread(np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], "<u8"), parts)[0] if tail else np.zeros(parts, "<u8")
    return np.packbits(2 * ones > n, bitorder="little").view("<u8")


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes (64 bits) of a text's runs of words; of a shorter text one, of all its words; none without words."""
    hashes = numbers([text], LOWER, xxhash.xxh64_intdigest, np.uint64)[0]
    return distinct(rolling(hashes, min(shingle, len(hashes)))) if len(hashes) else hashes


def sketch(own: np.ndarray, parts: int) -> list:
    """The fingerprint of distinct shingles, a hash of the whole set, as signed longs, and the least LEAST of them. No shingles: zeros."""
    ones = np.zeros(64 * parts, np.int64)
    for x in range(0, len(own), 1 << 16):
        mixed = np.ascontiguousarray(spread(own[x : x + (1 << 16)], parts + 1)[:, 1:])
        ones += np.unpackbits(mixed.view(np.uint8).reshape(-1, 8 * parts), axis=1, bitorder="little").sum(0, dtype=np.int64)
    whole = np.array([xxhash.xxh64_intdigest(own.tobytes()) if len(own) else 0], np.uint64).view(np.int64)
    return [*np.packbits(2 * ones > len(own), bitorder="little").view("<i8").tolist(), int(whole[0]), own[:LEAST].view(np.int64).tolist()]


def sketches(docs: DataFrame, *, shingle: int, parts: int, text: str, keep: list[str]) -> DataFrame:
    """`keep`, the fingerprint of each text's distinct shingles, `same`, a hash of their set, and `least`, the least of them."""

    def start():
        def work(texts: list[bytes]) -> list:
            return [list(x) for x in zip(*(sketch(shingles(t, shingle), parts) for t in texts))]

        return work

    fields = [T.StructField(n, T.LongType(), False) for n in [*names(parts), "same"]]
    return map_texts(docs, text, [*fields, T.StructField("least", T.ArrayType(T.LongType(), False), False)], start, keep)


def names(parts: int) -> list[str]:
    return ["fingerprint", *(f"fingerprint_{i}" for i in range(2, parts + 1))]


def fingerprints(docs: DataFrame, *, shingle: int = 3, parts: int = 1, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all columns) and fingerprint, for more parts fingerprint_2 and so on (64 bits each, as signed longs). Null and empty texts have 0."""

    def start():
        def work(texts: list[bytes]) -> list:
            found = np.array([fingerprint(t, shingle, parts) for t in texts], "<u8").reshape(-1, parts).view(np.int64)
            return [found[:, i].tolist() for i in range(parts)]

        return work

    return map_texts(docs, text, [T.StructField(n, T.LongType(), False) for n in names(parts)], start, keep)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n, so that a tile gives a link for each row at most and not its pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
        keep = root[i] != root[j]
        i, j = i[keep], j[keep]
    return root


def links(distinct: DataFrame, radius: int, *, tile: int = TILE) -> DataFrame:
    """(a, b) that connect all fingerprints (column fp, distinct) which differ in `radius` bits or fewer, through each other.

    The 64 bits are cut into radius + 2 blocks; two linked fingerprints agree in at least two blocks, so each pair meets in a bucket of one
    pair of blocks and their values."""
    blocks = radius + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    keys = [F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(masks[x] | masks[y]))).alias("v")) for k, (x, y) in enumerate(combinations(range(blocks), 2))]
    keyed = distinct.select(F.col("fp").alias("node"), "fp", F.explode(F.array(*keys)).alias("key")).select("node", "fp", "key.k", "key.v")
    return within(keyed, ["k", "v"], ["fp"], radius, tile=tile)


def met(nodes: DataFrame, columns: list[str], radius: int, *, tile: int = TILE) -> DataFrame:
    """(a, b) that connect all of nodes(node, columns, least) which have one of their least shingles in common and are within the radius.

    Texts that share 0.8 of their shingles lack such a one if, in the order of hashes, LEAST shingles that only one of them has come before the first of both: in about 5 of 10**8 pairs.
    Buckets of equal nodes (most, for a pair of near-copies) are gone through once. Work grows with the documents and the pairs within a bucket, not with all pairs."""
    keyed = nodes.select("node", F.explode("least").alias("s"))
    again = materialised(keyed.groupBy("s").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("x")).where("n > 1"))
    distinct = materialised(again.groupBy("n", "x").agg(F.min("s").alias("s")).select("s"))
    rows = materialised(keyed.join(distinct, "s"))
    return within(rows.join(nodes.select("node", *columns), "node"), ["s"], columns, radius, tile=tile)


def within(rows: DataFrame, bucket: list[str], columns: list[str], radius: int, *, tile: int = TILE) -> DataFrame:
    """(a, b) that connect all nodes of a bucket whose fingerprints (columns) differ in `radius` bits or fewer, from rows(bucket, node, columns).

    A bucket is cut by population count (in steps that the radius allows; and, where more than a tile's rows have one, by hash) into tiles; tiles
    whose counts differ beyond the radius are skipped, and each remaining pair of tiles is compared exactly, in a task of bounded rows."""
    step = max(1, radius // 2)
    pop = F.floor(sum((F.bit_count(c) for c in columns[1:]), F.bit_count(columns[0])) / step).cast("int")
    rows = rows.withColumn("pop", pop)
    # one row for a bucket and count: how many tiles it needs; buckets of a single row go
    sizes = rows.groupBy(*bucket, "pop").agg(F.count("*").alias("n"))
    # kept apart from the join, so that the rows of a large bucket can be split
    tall = materialised(sizes.groupBy(*bucket).agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile).cast("int").alias("t")))).alias("tiles")).where("rows > 1"))
    small = F.col("rows") <= tile
    own = F.when(small, F.lit(0)).otherwise(F.pmod(F.xxhash64(*columns), F.element_at("tiles", F.col("pop"))).cast("int"))
    placed = rows.join(tall, bucket).withColumn("own", own)

    def others() -> F.Column:
        """The tile pairs that a row takes part in, each as (smaller tile, larger tile), a tile being (pop, number)."""
        here = F.struct(F.col("pop").alias("p"), F.col("own").alias("t"))
        near = F.filter(F.map_keys("tiles"), lambda p: F.abs(p - F.col("pop")) * step - (step - 1) <= radius)
        every = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(0), F.element_at("tiles", p) - 1), lambda t: F.struct(p.alias("p"), t.cast("int").alias("t")))))
        return F.transform(every, lambda x: F.struct(F.least(here, x).alias("x"), F.greatest(here, x).alias("y"), (here <= x).alias("left")))

    zero = F.struct(F.lit(-1).alias("p"), F.lit(0).alias("t"))
    whole = F.array(F.struct(zero.alias("x"), zero.alias("y"), F.lit(True).alias("left")))
    tasks = placed.select("node", *columns, *bucket, F.explode(F.when(small, whole).otherwise(others())).alias("pair"))
    side = F.when(F.col("pair.x") == F.col("pair.y"), F.lit(2)).when(F.col("pair.left"), F.lit(0)).otherwise(F.lit(1))
    tasks = tasks.select(F.xxhash64(*bucket, "pair.x", "pair.y").alias("task"), "node", side.alias("side"), *columns)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])

    def compare(batches):
        import pyarrow as pa

        def out(task: np.ndarray, node: np.ndarray, side: np.ndarray, *prints: np.ndarray):
            """All tasks' rows are here together, in order of tasks."""
            f = np.stack(prints, axis=1).view(np.uint64)
            cuts = np.concatenate([[0], np.nonzero(np.diff(task))[0] + 1, [len(task)]])
            length = np.diff(cuts)
            two = cuts[:-1][length == 2]  # most buckets: one pair each, all compared at once
            two = two[np.bitwise_count(f[two] ^ f[two + 1]).sum(1) <= radius]
            made_a, made_b = [node[two]], [node[two + 1]]
            for x, m in zip(cuts[:-1][length > 2].tolist(), length[length > 2].tolist()):
                own, s = f[x : x + m], side[x : x + m]
                ones = np.bitwise_count(own).sum(1).astype(int)
                root, found, held = np.arange(m), [], 0
                for p in np.unique(ones // step).tolist():  # strips of one step, against those that are near enough
                    left = np.nonzero((ones // step == p) & (s != 1))[0]
                    right = np.nonzero((np.abs(ones // step - p) * step - (step - 1) <= radius) & (s != 0))[0]
                    for i, j in strips(own, left, right, radius) if len(left) and len(right) else ():
                        found.append((i, j))
                        held += len(i)
                        if held > 1 << 20:
                            root = forest(m, *(np.concatenate(v) for v in zip(*found)))
                            moved = np.nonzero(root != np.arange(m))[0]
                            found, held = [(moved, root[moved])], 0
                if found:
                    root = forest(m, *(np.concatenate(v) for v in zip(*found)))
                    moved = np.nonzero(root != np.arange(m))[0]
                    made_a.append(node[x + moved])
                    made_b.append(node[x + root[moved]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(made_a)), pa.array(np.concatenate(made_b))], names=["a", "b"])

        kept = None
        for b in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            now = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if last:
                yield out(*(x[:last] for x in now))
            kept = [x[last:] for x in now]
        if kept is not None and len(kept[0]):
            yield out(*kept)

    return tasks.repartition(n, "task").sortWithinPartitions("task").mapInArrow(compare, schema)


def strips(f: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int):
    """Pairs of rows of f (one of `left`, one of `right`) within the radius, a few rows of `left` at a time."""
    step = max(1, (1 << 18) // max(1, len(right)))
    columns = [np.ascontiguousarray(f[right, c]) for c in range(f.shape[1])]
    for r in range(0, len(left), step):
        differ = sum(np.bitwise_count(f[left[r : r + step], c][:, None] ^ y[None, :]).astype(np.uint16) for c, y in enumerate(columns))
        i, j = np.nonzero(differ <= radius)
        if len(i):
            yield left[r + i], right[j]


def near(f: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Smallest row reachable from each; of the pairs no more than about a million are held."""
    root, found, held = np.arange(len(f)), [], 0
    for i, j in strips(f, left, right, radius):
        found.append((i, j))
        held += len(i)
        if held > 1 << 20:
            root = forest(len(f), *(np.concatenate(x) for x in zip(*found)))
            moved = np.nonzero(root != np.arange(len(f)))[0]
            found, held = [(moved, root[moved])], 0
    return forest(len(f), *(np.concatenate(x) for x in zip(*found))) if found else root


def tiled_links(nodes: DataFrame, columns: list[str], radius: int, *, tile: int = 1 << 16) -> DataFrame:
    """(a, b) of nodes(node, columns) that connect all whose fingerprints over all columns differ in `radius` bits or fewer.

    For radii too large for buckets. Nodes are put into tiles of about `tile` rows in order of their population counts; tile pairs whose counts
    differ by more than the radius are skipped, every other pair of tiles is a task that compares all its rows. The number of comparisons
    grows with the square of the nodes, and each row is sent to at most nodes / tile tasks."""
    spark = nodes.sparkSession
    pop = sum((F.bit_count(c) for c in columns[1:]), F.bit_count(columns[0])).cast("int")
    counted = sorted((r.pop, r.n) for r in nodes.groupBy(pop.alias("pop")).agg(F.count("*").alias("n")).collect())
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])
    if not counted:
        return spark.createDataFrame([], schema)
    before, low, high, at = {}, {}, {}, 0
    for p, n in counted:
        before[p] = (at, n)
        for t in range(at // tile, (at + n - 1) // tile + 1):
            low[t], high[t] = min(low.get(t, p), p), max(high.get(t, p), p)
        at += n
    tiles = len(low)
    first = [min(i for i in range(tiles) if high[i] >= low[t] - radius) for t in range(tiles)]
    last = [max(i for i in range(tiles) if low[i] <= high[t] + radius) for t in range(tiles)]
    start = F.create_map(*(F.lit(x) for p, (a, _) in before.items() for x in (p, a)))
    size = F.create_map(*(F.lit(x) for p, (_, n) in before.items() for x in (p, n)))
    own = F.floor((F.element_at(start, pop) + F.pmod(F.xxhash64(*columns), F.element_at(size, pop))) / tile).cast("int")
    ends = [F.get(F.array(*map(F.lit, x)), F.col("t")) for x in (first, last)]
    sent = nodes.select("node", *columns, own.alias("t")).select("*", F.explode(F.sequence(*ends)).alias("o"))
    sent = sent.select((F.least("t", "o").cast("long") * tiles + F.greatest("t", "o")).alias("task"), "node", (F.col("t") == F.least("t", "o")).alias("left"), (F.col("t") == F.col("o")).alias("both"), *columns)

    def compare(batches):
        import pyarrow as pa

        from .kneser_ney import runs

        for _, (node, left, both, *prints) in runs(batches):
            f = np.stack(prints, axis=1).view(np.uint64)
            left_rows, right_rows = np.nonzero(left | both)[0], np.nonzero(~left | both)[0]
            root = near(f, left_rows, right_rows, radius)
            moved = np.nonzero(root != np.arange(len(node)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tiles)
    return sent.repartition(n, "task").sortWithinPartitions("task").mapInArrow(compare, schema)


def alike(f: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, radius: int, similarity: float) -> np.ndarray:
    """A root for each row: rows are linked if they are within the radius and share `similarity` (Jaccard) of their shingles. Pairs that are connected already are not compared."""
    root, size = np.arange(len(f)), np.array([len(s) for s in sets])
    for i, j in strips(f, left, right, radius):
        for a in np.unique(i).tolist():
            near = j[i == a]
            near = near[(root[near] != root[a]) & (np.minimum(size[near], size[a]) >= similarity * np.maximum(size[near], size[a]) - 1e-9)]
            if not len(near):
                continue
            flat, own = np.concatenate([sets[x] for x in near.tolist()]), sets[a]
            at = np.searchsorted(own, flat)
            at[at == len(own)] = 0
            both = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(size[near])[:-1]]))
            for r in np.unique(root[near[both >= similarity * (size[near] + size[a] - both) - 1e-9]]).tolist():
                root[root == max(r, root[a])] = min(r, root[a])
    return root


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, columns: list[str], radius: int, shingle: int, similarity: float, doc: str, text: str, *, tile: int = TILE, most: int = SHINGLES) -> DataFrame:
    """(a, b) that connect all of nodes(node, columns, m: doc and text hash of one of its rows) that share `similarity` of their shingles and are within the radius.

    pairs connect all within the radius. The nodes of each of their groups are brought together with their shingles, read again from one text each, and
    compared in tiles of about `tile` rows and `most` shingles at most: a pair of tiles is a task, no pair of rows leaves one, and a row is sent to as many tasks as its group has tiles."""
    found = components(materialised(pairs))
    wanted = nodes.join(found, "node").select("node", "root", *columns, F.coalesce(F.col("m.doc").cast("string"), F.lit("")).alias("_doc"), F.col("m.mark").alias("_mark"))
    own = docs.select(F.coalesce(F.col(doc).cast("string"), F.lit("")).alias("_doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_mark"), F.col(text).alias("_t"))
    texts = own.join(wanted, ["_doc", "_mark"]).dropDuplicates(["node"])

    def start():
        return lambda texts: [[shingles(t, shingle).tobytes() for t in texts]]

    held = materialised(map_texts(texts, "_t", [T.StructField("set", T.BinaryType(), False)], start, ["node", "root", *columns]))
    tiles = held.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum(F.length("set")) / (8 * most)), F.lit(1)).cast("int").alias("tiles"))
    placed = held.join(materialised(tiles), "root").withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    sent = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    sent = sent.select(F.xxhash64("root", F.least("t", "o"), F.greatest("t", "o")).alias("task"), "node", (F.col("t") <= F.col("o")).alias("left"), (F.col("t") == F.col("o")).alias("both"), "set", *columns)

    def compare(batches):
        import pyarrow as pa

        from .kneser_ney import runs

        for _, (node, left, both, sets, *prints) in runs(batches):
            left, both = left.astype(bool), both.astype(bool)
            f = np.stack(prints, axis=1).view(np.uint64)
            root = alike(f, [np.frombuffer(s, np.uint64) for s in sets], np.nonzero(left)[0], np.nonzero(~left | both)[0], radius, similarity)
            moved = np.nonzero(root != np.arange(len(node)))[0]
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])
    return sent.repartition(n, "task").sortWithinPartitions("task").mapInArrow(compare, schema)


def grouped(docs: DataFrame, *, radius: int = 2, shingle: int = 3, parts: int = 1, similarity: float | None = None, doc: str = "doc_id", text: str = "text", more: list[F.Column] = ()) -> DataFrame:
    """doc, the columns of `more`, fingerprint and component_id (smallest doc reachable over links of at most `radius` differing bits) for each row.

    similarity: texts are linked if they share that much (Jaccard) of their distinct shingles; the radius then only says which pairs are compared,
    the fingerprint is of distinct shingles, and a column `same` has a hash of their set.
    Compared are, with a similarity, texts that have one of their least shingles in common (see met()); without, one part of 64 bits and a radius up to 6 within buckets of equal blocks,
    and more parts or a larger radius in tiles of everything.
    Texts are read once; fingerprints, links and rounds of components are kept in the shared folder. Equal fingerprints are one node, so
    copies cost nothing beyond their row. Null docs belong to groups but name none, unless a group has nothing else (then null). Null and
    empty texts share fingerprint 0, which links like any other. Texts of any length are taken whole. Repeated rows stay. No rows: no rows. Other columns aren't looked at, whatever their names."""
    columns = names(parts)
    if similarity is None:
        slim = materialised(fingerprints(docs.select(F.col(doc), F.col(text), *more), shingle=shingle, parts=parts, text=text).drop(text))
        nodes = slim.groupBy(*columns).agg(F.min(doc).alias("first"))
    else:
        read = docs.select(F.col(doc), F.col(text), *more).withColumn("_own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
        slim = materialised(sketches(read, shingle=shingle, parts=parts, text=text, keep=[c for c in read.columns if c != text]))
        own = F.struct(F.col(doc).alias("doc"), F.col("_own").alias("mark"))
        nodes = slim.groupBy(*columns, "same").agg(F.min(doc).alias("first"), F.min(own).alias("m"), F.first("least").alias("least"))
        slim = slim.drop("_own", "least")
    if similarity is not None:
        nodes = materialised(nodes.withColumn("node", F.monotonically_increasing_id()))
        pairs = verified(docs, nodes, met(nodes, columns, radius), columns, radius, shingle, similarity, doc, text)
        columns = [*columns, "same"]
    elif parts == 1 and radius <= 6:
        nodes = nodes.withColumn("node", F.col("fingerprint"))
        pairs = links(nodes.select(F.col("fingerprint").alias("fp")), radius)
    else:
        nodes = materialised(nodes.withColumn("node", F.monotonically_increasing_id()))
        pairs = tiled_links(nodes, columns, radius)
    found = components(materialised(pairs))
    rooted = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # kept apart from the join, whose sides are then plain shuffles that adaptive execution can split at a large group
    named = materialised(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    known = materialised(rooted.join(named, "root").select(*columns, "component_id"))
    return slim.join(known, columns).select(*slim.columns, "component_id")


def one_of_each(docs: DataFrame, *, radius: int = 2, shingle: int = 3, parts: int = 1, similarity: float | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near-copies: of each group one row stays, of the smallest doc (nulls last), then of the smallest text hash. Rows that agree in doc and text count as one.

    Null and empty texts are one group (see grouped()); texts of any length are compared whole; no rows give no rows; columns may have any name."""
    # rows are found again by doc and text hash, null or not; any column may have any name
    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    hashed = lambda c: F.xxhash64(F.coalesce(F.col(c), F.lit("")))
    found = grouped(slim, radius=radius, shingle=shingle, parts=parts, similarity=similarity, doc="doc", text="text", more=[hashed("text").alias("mark")])
    alone = F.col("component_id").isNull()
    first = found.groupBy("component_id", F.when(alone, F.col("fingerprint")).alias("f")).agg(F.min(F.struct(F.col("doc").isNull().alias("no"), "doc", "mark")).alias("m"))
    key, mark = fresh(docs, "doc", "mark")
    keys = first.select(F.coalesce(F.col("m.doc").cast("string"), F.lit("")).alias(key), F.col("m.mark").alias(mark))
    marked = docs.withColumns({key: F.coalesce(F.col(doc).cast("string"), F.lit("")), mark: hashed(text)})
    return marked.join(keys, [key, mark], "left_semi").dropDuplicates([key, mark]).select(*docs.columns)
