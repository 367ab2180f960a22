"""Benchmark decontamination: windows of benchmark words found in documents."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialised
from .words import ALNUM, fresh, map_texts, numbers, rolling, words

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)]), False)
FIELDS = [T.StructField("n_words", T.LongType(), False), T.StructField("hit_spans", SPANS, False), T.StructField("items", T.ArrayType(T.StringType(), False), False)]


class Windows:
    """Windows of n words of benchmark items, by length: word numbers, and the items of each window."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.found: dict[tuple[int, ...], set[str]] = defaultdict(set)
        self.weight = 0

    def add(self, item: str, ws: list[bytes], n: int, start: int, end: int) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
        for i in range(start, end):
            window = tuple(ids[i : i + n])
            if item not in self.found[window]:
                self.found[window].add(item)
                self.weight += n + 1

    def freeze(self) -> tuple[dict, list]:
        by_length = defaultdict(list)
        for window in self.found:
            by_length[len(window)].append(window)
        tables = []
        for n, found in sorted(by_length.items()):
            ids = np.array(found, np.int64)
            hashes = np.array([rolling(row, n)[0] for row in ids], np.uint64)
            order = np.argsort(hashes, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            tables.append((n, hashes[order], ids[order], bits, [sorted(self.found[found[i]]) for i in order]))
        return self.vocabulary, tables


def blocks(benchmark: DataFrame, n: int, item: str, text: str, most: int) -> Iterator[tuple[dict, list]]:
    """The benchmark's windows in blocks of at most about `most` numbers, each for one broadcast; the driver holds one block at a time."""
    now = Windows()
    for row in benchmark.select(F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("i"), F.coalesce(benchmark[text], F.lit("")).alias("t")).toLocalIterator():
        ws = [w for part in words(row.t.encode(), ALNUM) for w in part]
        size = min(n, len(ws))
        for start in range(0, len(ws) - size + 1 if ws else 0, step := max(1, most // (n + 1))):
            end = min(start + step, len(ws) - size + 1)
            now.add(row.i, ws[start : end + size - 1], size, 0, end - start)
            if now.weight >= most:
                yield now.freeze()
                now = Windows()
    yield now.freeze()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(texts: list[bytes], vocabulary: dict, tables: list) -> tuple[list, list, list]:
    """For each text: words, spans of hit words, items."""
    get = vocabulary.get
    ids, ends = numbers(texts, ALNUM, lambda w: get(w, 0), np.int64, between=0)
    n_words = np.diff(ends) - 1
    spans: dict[int, list] = defaultdict(list)
    items: dict[int, set] = defaultdict(set)
    for n, hashes, windows, bits, names in tables:
        h = rolling(ids, n)
        at = np.nonzero(bits[(h >> np.uint64(44)).astype(np.int64)])[0]
        if not len(at):
            continue
        lo, hi = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        for extra in range(int((hi - lo).max()) if len(at) else 0):  # more than one: different windows of one hash
            some = lo + extra < hi
            p, k = at[some], (lo + extra)[some]
            real = (ids[p[:, None] + np.arange(n)] == windows[k]).all(1)
            p, k = p[real], k[real]
            doc = np.searchsorted(ends, p, "right") - 1
            for d, w in set(zip(doc.tolist(), k.tolist())):
                items[d].update(names[w])
            first = np.concatenate([[True], (p[1:] > p[:-1] + n) | (doc[1:] != doc[:-1])]) if len(p) else np.empty(0, bool)
            last = np.concatenate([first[1:], [True]]) if len(p) else first
            for d, a, b in zip(doc[first].tolist(), p[first].tolist(), p[last].tolist()):
                spans[d].append((a - int(ends[d]), b + n - int(ends[d])))
    rows = range(len(texts))
    return n_words.tolist(), [merged(spans[i]) if i in spans else [] for i in rows], [sorted(items[i]) if i in items else [] for i in rows]


def find(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text", keep: list[str] | None = None, most: int = 4_000_000) -> DataFrame:
    """`keep` (default: all columns) with n_words, hit_spans (from word, to word) and items (sorted), by exact occurrence of item windows.

    A window is n consecutive words of an item, or all words of a shorter item. The windows go to the tasks as a broadcast of at most
    about `most` numbers; a larger benchmark is gone through in blocks of that size, one pass over the documents for each, their results
    kept in the shared folder between passes. A null or empty text has no words; a null item id counts as the empty string; rows that
    repeat are each marked; texts of any length are gone through whole. Empty documents or benchmark: no hits. Columns named like the three new ones are dropped, others may have any name."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in FIELDS}]
    out = None
    for vocabulary, tables in blocks(benchmark, n, item, item_text, most):
        sent = docs.sparkSession.sparkContext.broadcast((vocabulary, tables))

        def start(sent=sent):
            def work(texts: list[bytes]) -> tuple[list, list, list]:
                n_words, spans, items = scan(texts, *sent.value)
                return n_words, [[{"start": a, "end": b} for a, b in s] for s in spans], items

            return work

        if out is None:
            out = map_texts(docs, text, FIELDS, start, list(dict.fromkeys([*kept, text])))
            continue
        before = dict(zip((f.name for f in FIELDS), fresh(out, *(f.name for f in FIELDS))))
        more = map_texts(out.withColumnsRenamed(before), text, FIELDS, start)
        every = {"items": F.array_sort(F.array_union(before["items"], "items")), "hit_spans": united(F.concat(before["hit_spans"], "hit_spans"))}
        out = materialised(more.withColumns(every).drop(*before.values()))
    return out.select(*kept, *(f.name for f in FIELDS))


def united(spans) -> F.Column:
    """Sorted spans, those that touch joined."""

    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(F.size(done) == 0, F.array(s)).when(last["end"] >= s["start"], joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), add)


def n_hit() -> F.Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_spans(text: bytes, spans: list) -> bytes:
    """The text without the words of the spans; what stands between other words stays."""
    if not spans:
        return text
    import re

    at = [m.span() for m in re.finditer(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))))]
    out, done = [], 0
    for s in spans:
        out.append(text[done : at[s["start"]][0]])
        done = at[s["end"] - 1][1]
    return b"".join([*out, text[done:]])


def remove(docs: DataFrame, benchmark: DataFrame, *, mode: str = "documents", text: str = "text", **how) -> DataFrame:
    """The documents' own columns without contaminated documents, or (mode="spans") with the hit words cut out of the texts.

    Documents with null or empty texts stay as they are, repeated rows stay or go together, and of any length; no documents give none, no benchmark takes none. Columns may have any name."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode is documents or spans")
    # the columns go through find() under names that it hasn't
    own = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    found = find(docs.select(*(docs[c].alias(n) for c, n in own.items())), benchmark, text=own[text], **how)
    clean = F.size("hit_spans") == 0
    if mode == "documents":
        return found.where(clean).select(*(F.col(n).alias(c) for c, n in own.items()))
    cut = F.udf(lambda t, s: None if t is None else without_spans(t.encode(), s).decode(), "string", useArrow=True)
    texts = F.when(clean, F.col(own[text])).otherwise(cut(own[text], "hit_spans"))
    return found.select(*((texts if c == text else F.col(n)).alias(c) for c, n in own.items()))
