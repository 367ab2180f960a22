"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialised


class Ring:
    """Arcs of the hash circle, in clockwise order: arc i ends at ends[i] (its virtual node) and belongs to owner[i]; keys past the last node wrap to the first."""

    def __init__(self, shards: int, nodes: int):
        points = sorted((xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(shards) for v in range(nodes))
        self.ends = np.array([p for p, _ in points], np.int64)
        self.owner = np.array([s for _, s in points], np.int64)
        self.shards = shards

    def arc(self, positions: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ends, positions)
        at[at == len(self.ends)] = 0
        return at

    def flows(self, load: np.ndarray, capacity: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(arc, first rank, end rank, shard): keys of an arc by rank. A shard takes the keys of its own arcs, in clockwise order, until it is full; the keys left over go on clockwise, arc by arc, to the next shard that has room."""
        room, found, over = capacity.astype(object).copy(), [], []
        for a, n in enumerate(load.tolist()):
            took = min(n, room[s := int(self.owner[a])])
            room[s] -= took
            if took:
                found.append((a, 0, took, s))
            if took < n:
                over.append((a, took, n))
        for a, start, end in over:
            at = a
            while start < end:
                at = (at + 1) % len(self.owner)
                if took := min(end - start, room[s := int(self.owner[at])]):
                    found.append((a, start, start + took, s))
                    room[s] -= took
                    start += took
        return found


def capacities(rows: int, shards: int, slack: float) -> np.ndarray:
    """Without slack as equal as whole numbers can be; with slack each shard may hold (1 + slack) of its part."""
    if slack:
        return np.full(shards, -(-int(rows * (1 + slack) * 1000) // (1000 * shards)) + 1, np.int64)
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)


def assign(docs: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text", nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """key, size, text_crc32, shard, slot of each row: the key's place on the ring gives the shard, and no shard exceeds its capacity.

    With slack 0 the shards' row counts differ by one at most; a larger slack moves fewer keys when shards are added. Keys of one arc are
    ranked by their place on the ring; what a full shard can't take is a range of ranks, so that equal keys and hot arcs are split where
    they must be. slot counts the rows of a shard from 0. size: UTF-8 bytes and 1 (null: 1). The text's crc32 is null for null.
    Null keys share one place on the ring; rows that repeat each get a slot. No rows: no shards. Texts may have any length; columns but key and text aren't looked at, whatever their names.

    Only key, size and checksum are kept (in the shared folder), dealt out in ring order; the driver gets a row for each arc and
    one for each partition and arc that meet: partitions + arcs at most."""
    ring, spark = Ring(shards, nodes), docs.sparkSession
    slim = docs.select(docs[key].alias("_key"), (F.coalesce(F.octet_length(docs[text]), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(docs[text]).alias("text_crc32"))
    slim = materialised(slim.withColumns({"_at": F.xxhash64(F.coalesce(F.col("_key").cast("string"), F.lit(""))), "_tie": F.monotonically_increasing_id()}))
    arcs = T.StructType([*slim.schema, T.StructField("_arc", T.IntegerType(), False)])

    def place(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        for b in batches:
            at = ring.arc(b.column(b.schema.get_field_index("_at")).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], schema=to_arrow_schema(arcs))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialised(slim.mapInArrow(place, arcs).repartitionByRange(n, "_arc", "_at", "_tie").sortWithinPartitions("_arc", "_at", "_tie").withColumn("_id", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    met = dealt.groupBy(part.alias("part"), "_arc").agg(F.count("*").alias("n"), F.min(inside).alias("first")).collect()
    load, before = np.zeros(len(ring.owner), np.int64), {}
    for r in sorted(met, key=lambda r: (r["_arc"], r.part)):
        before[r.part, r["_arc"]] = int(load[r["_arc"]]) - r["first"]
        load[r["_arc"]] += r.n
    starts: dict[int, tuple[list, list, list]] = {}
    filled = [0] * shards
    for a, start, end, s in ring.flows(load, capacities(int(load.sum()), shards, slack)):
        for values, v in zip(starts.setdefault(a, ([], [], [])), (start, s, filled[s] - start)):
            values.append(v)
        filled[s] += end - start
    sent = spark.sparkContext.broadcast((before, {a: [np.array(x, np.int64) for x in v] for a, v in starts.items()}))
    out = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def fill(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        before, starts = sent.value
        for b in batches:
            ids, arc = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_id", "_arc"))
            shard, slot = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            cuts = [0, *(np.nonzero((np.diff(arc) != 0) | (np.diff(ids >> 33) != 0))[0] + 1).tolist(), len(ids)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                rank = (ids[x:y] & ((1 << 33) - 1)) + before[int(ids[x]) >> 33, int(arc[x])]
                first, to, shift = starts[int(arc[x])]
                k = np.searchsorted(first, rank, "right") - 1
                shard[x:y], slot[x:y] = to[k], rank + shift[k]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in ("_key", "size", "text_crc32")), pa.array(shard.astype(np.int32)), pa.array(slot)], schema=to_arrow_schema(out))

    return dealt.select("_key", "size", "text_crc32", "_id", "_arc").mapInArrow(fill, out)
