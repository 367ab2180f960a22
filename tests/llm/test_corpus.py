"""Operators that look across documents: brute force, and odd cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from orograph.llm import kneser_ney, line_dedup, packing, sharding, simhash, url_filter, weak_labels, words
from orograph.llm.components import components

from .helpers import COLUMNS, clashing, documents, low, odd_texts, plain_words, prose, space_words


def reached(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(n)]


# SimHash


def brute_print(text, k=3):
    w = space_words(low(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(spark):
    docs = documents(spark)
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    root = reached(len(rows), lambda a, b: (rows[a][1] ^ rows[b][1]).bit_count() <= 2)
    least = defaultdict(list)
    for (d, _), r in zip(rows, root):
        least[r] += [d] if d is not None else []
    want = Counter((d, f, min(least[r], default=None)) for (d, f), r in zip(rows, root))
    found = simhash.grouped(clashing(docs, "fingerprint")).collect()
    assert Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in found) == want
    assert simhash.grouped(spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("tile", [2048, 16])
@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_of_dense_prints(spark, tile, radius):
    rng = np.random.default_rng(radius)
    found = set()
    for base in rng.integers(0, 2**63, 4).tolist():
        for _ in range(150):
            x = base
            for k in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << k
            found.add(x)
    prints = sorted(found)
    a = np.array(prints, np.uint64)
    root = simhash.forest(len(a), *np.nonzero(np.bitwise_count(a[:, None] ^ a[None, :]) <= radius))
    groups = Counter(root.tolist())
    frame = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    got = components(simhash.links(frame, radius, tile=tile)).collect()
    assert Counter(Counter(r.root for r in got).values()) == Counter(n for n in groups.values() if n > 1)


def test_wide_tiles_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2, (6, 128))
    bits = np.concatenate([base[i] ^ (rng.random((20, 128)) < 0.08) for i in range(6)]).astype(np.uint8)
    f = np.packbits(bits, axis=1, bitorder="little").view("<i8")
    frame = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(f)], "node long, x long, y long")
    for radius in (10, 20, 30):
        root = reached(len(f), lambda a, b, radius=radius: (bits[a] != bits[b]).sum() <= radius)
        want = {i: r for i, r in enumerate(root) if root.count(r) > 1}
        assert {r.node: r.root for r in components(simhash.tiled_links(frame, ["x", "y"], radius, tile=25)).collect()} == want


def test_one_of_each(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs, shingle=5, radius=26, parts=2)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert max(ids.values()) == 1 and ids[6] == 1 and not {7, 8} & set(ids) and None in ids
    assert {10, 11, 16} <= set(ids)


def test_near_copies_of_nothing(spark):
    for how in ({}, {"shingle": 5, "radius": 34, "parts": 2, "similarity": 0.8}):
        assert simhash.one_of_each(spark.createDataFrame([], COLUMNS), **how).count() == 0
        docs = clashing(documents(spark), "_doc", "_mark", "doc", "mark", "m", "least", "node")
        kept = simhash.one_of_each(docs, **how)
        assert kept.columns == docs.columns and kept.where("_doc = 'own' and _mark = 'own' and doc = 'own'").count() == kept.count() > 20


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := space_words(low(t))) else set() for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_near_copies_are_those_of_the_similarity(spark, monkeypatch):
    """Documents that share a template (0.5 to 0.75) stay, near-copies (0.8 and more) go, also where a group has many tiles."""
    rng = random.Random(11)
    body, texts = prose(rng, 300, 99999).split(), [None, "", "two words", "Two  words", "two word"]
    texts += [" ".join(body[:k] + prose(rng, 300 - k, 99999).split()) for k in (200, 220, 240, 255, 262, 270, 280, 290) for _ in range(6)]
    texts += [prose(rng, 200, 99999) for _ in range(6)]
    root = reached(len(texts), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS)
    how = {"shingle": 5, "radius": 34, "parts": 2, "similarity": 0.8}
    assert {r.doc_id: r.component_id for r in simhash.grouped(docs, **how).collect()} == dict(enumerate(root))
    assert {r.doc_id for r in simhash.one_of_each(docs, **how).collect()} == set(root)
    monkeypatch.setitem(simhash.verified.__kwdefaults__, "tile", 10)
    assert {r.doc_id: r.component_id for r in simhash.grouped(docs, **how).collect()} == dict(enumerate(root))
    assert corpus_pipeline.near_copies(spark, docs, "").count() == len(set(root))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


# repeated passages


def test_chosen_are_least_of_all_windows():
    rng = np.random.default_rng(0)
    for n in (1, 5, 30, 200):
        h = rng.integers(1, 50 if n == 200 else 1 << 60, n).astype(np.uint64)
        for w in (1, 2, 4, 25):
            counts = rng.random(n) < 0.8
            at = set(line_dedup.chosen(h, w, counts).tolist()) if n >= w else set()
            some = [s for s in range(max(0, n - w + 1)) if counts[s]]
            for s in some:
                low = {s + i for i in np.nonzero(h[s : s + w] == h[s : s + w].min())[0].tolist()}
                assert low & at
            if len(set(h.tolist())) == n:
                assert at == {s + int(h[s : s + w].argmin()) for s in some}


def brute_spans(texts, min_words=50, min_lines=3):
    """Words of each text (in order) that lie in a window of words, or of lines with words, that came before."""
    seen, gone = set(), []
    for t in texts:
        w, out, at = space_words(low(t)), set(), 0
        lines = []
        for line in low(t).split("\n"):
            if n := len(space_words(line)):
                lines.append((at, at + n, tuple(space_words(line))))
                at += n
        for kind, n, size in (("words", len(w), min_words), ("lines", len(lines), min_lines)):
            for i in range(n - size + 1):
                own = lines[i : i + size]
                g = (kind, *w[i : i + size]) if kind == "words" else (kind, *(x[2] for x in own))
                if g in seen:
                    out |= set(range(i, i + size)) if kind == "words" else set(range(own[0][0], own[-1][1]))
                seen.add(g)
        gone.append(out)
    return gone


def spans_of(docs, **how):
    return {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in line_dedup.marked(docs.select("doc_id", "text"), **how).collect()}


def test_passages(spark):
    rng = random.Random(3)
    once, thrice = prose(rng, 64, 99999), prose(rng, 51, 99999)
    texts = [
        prose(rng, 90, 99999), prose(rng, 40, 99999) + " " + once + " " + prose(rng, 40, 99999), prose(rng, 10, 99999) + "\n" + thrice + "\n" + prose(rng, 10, 99999), "".join(c.upper() if c.isascii() else c for c in once) + "\n" + prose(rng, 30, 99999),
        thrice, None, "", prose(rng, 5, 99999) + " " + thrice + " " + prose(rng, 60, 99999) + " " + thrice, " ".join(once.split()[:49]),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x")], "doc_id long, text string, spans string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in line_dedup.marked(docs).collect()}
    assert spans == {0: [], 1: [], 2: [], 3: [(0, 64)], 4: [(0, 51)], 5: [], 6: [], 7: [(5, 56), (116, 167)], 8: []}
    cut = {r.doc_id: r.text for r in line_dedup.cut(docs.drop("spans")).collect()}
    assert 4 not in cut and cut[1] == texts[1] and cut[5] is None and cut[6] == ""
    assert cut[3] == texts[3].split("\n")[1] and space_words(cut[7]) == space_words(texts[7])[:5] + space_words(texts[7])[56:116]
    assert line_dedup.cut(spark.createDataFrame([], COLUMNS)).count() == 0
    assert {r.doc_id for r in line_dedup.cut(docs, least_words=50, least_share=0.6).collect()} == {0, 1, 2, 5, 6, 7, 8}


def test_all_that_came_before_goes(spark):
    """Equal to brute force on whole documents; nothing else is cut."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = sorted((r.doc_id, r.text) for r in docs.collect())
    want = brute_spans([t for _, t in own])
    assert sum(map(len, want)) > 500
    assert spans_of(docs) == {d: w for (d, _), w in zip(own, want)}


@pytest.mark.parametrize("how", [{}, {"min_words": 9, "min_lines": 1}, {"min_words": 20, "min_lines": 4}])
def test_passages_behind_parts_of_them(spark, how):
    """Every repeat goes, also where an earlier document has a part of the passage that is too short itself, and short lines in runs, in periodic texts and among other lines."""
    rng = random.Random(9)
    texts = []
    for n in (50, 55, 60, 70, 97):
        for _ in range(12):
            passage = prose(rng, n, 99999).split()
            at = (n - 49) // 2
            texts += [" ".join(x) for x in (passage[at : at + 49], prose(rng, 20, 99999).split() + passage + prose(rng, 20, 99999).split(), prose(rng, 7, 99999).split() + passage + prose(rng, 9, 99999).split())]
    menu = ["Home", "About  us", "", "Contact", "Sign in", " ", "More of this"]
    texts += ["x " * 120, "a b c d e f g h i j k l m " * 12, "\n".join(["same line here."] * 40), "\n".join(["One of two", "two of two"] * 20 + ["end"]), "\n \n"]
    texts += ["\n".join([prose(rng, 12, 99999), *menu, prose(rng, 12, 99999)]) for _ in range(6)] + ["\n".join([prose(rng, 3), *menu[:4], prose(rng, 3), *menu[2:]]).upper().replace("SS", "ß") for _ in range(6)]
    texts += ["\n".join(rng.choice(["one", "two", "three four", "five"]) for _ in range(rng.randrange(1, 30))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spans_of(docs, **how) == dict(enumerate(brute_spans(texts, **how)))


def test_long_texts_and_clashing_names(spark, monkeypatch):
    """Texts of several slices, cut into units at once; helper names that the input has."""
    rng = random.Random(2)
    long = "\n".join(prose(rng, 30, 99999) for _ in range(400))
    texts = [long, long[5000:60000], prose(rng, 90, 99999) + long[-900:], None, "", "a"]
    want = brute_spans(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(words, "SLICE", 1000)
    found = line_dedup.marked(clashing(docs, "_k1", "_K2", "k1", "place", "spans", "_spans", "first"))
    assert found.columns == ["doc_id", "text", "_k1", "_K2", "k1", "place", "_spans", "first", "spans"] and found.where("_k1 = 'own' and _spans = 'own'").count() == len(texts)
    assert {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in found.collect()} == dict(enumerate(want))
    kept = line_dedup.cut(clashing(docs, "_cut", "_k1"))
    assert kept.columns == ["doc_id", "text", "_cut", "_k1"] and {r.doc_id for r in kept.collect()} == set(range(6))


# sharding


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_shards(spark, slack):
    docs = documents(spark).unionByName(spark.createDataFrame([(5, f"t{i}", None, None, None) for i in range(120)], COLUMNS))
    found = sharding.assign(docs, 8, slack=slack).collect()
    own = Counter((r.doc_id, len((r.text or "").encode()) + 1, None if r.text is None else zlib.crc32(r.text.encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == own
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) <= (len(found) * (1 + slack)) / 8 + 2 and (slack or max(sizes) - min(sizes) <= 1)
    assert sharding.assign(spark.createDataFrame([], COLUMNS), 8).count() == 0


def test_shards_by_walking_the_ring(spark):
    """Key by key: each to its own arc's shard while that has room; what is left over walks on clockwise, arc by arc, to the first shard with room."""
    nodes = sorted((xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(5) for v in range(64))
    ids = list(range(700)) + [3] * 150 + [None] * 40
    random.Random(0).shuffle(ids)
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    at = [signed(xxhash.xxh64_intdigest("" if i is None else str(i), 42)) for i in ids]
    keys = sorted((next((a for a, (end, _) in enumerate(nodes) if p <= end), 0), p, "" if i is None else str(i)) for i, p in zip(ids, at))
    for slack, room in ((0.0, [len(ids) // 5 + (s < len(ids) % 5) for s in range(5)]), (0.3, sharding.capacities(len(ids), 5, 0.3).tolist())):
        want, over = Counter(), []
        for a, _, key in keys:
            if room[s := nodes[a][1]]:
                room[s] -= 1
                want[key, s] += 1
            else:
                over.append((a, key))
        for a, key in over:
            while not room[s := nodes[a := (a + 1) % len(nodes)][1]]:
                pass
            room[s] -= 1
            want[key, s] += 1
        assert over and Counter(("" if r.doc_id is None else str(r.doc_id), r.shard) for r in sharding.assign(docs, 5, slack=slack).collect()) == want


def test_rows_moved_by_a_ninth_shard(spark):
    """As registered (no slack): the new shard's ninth moves, and few rows between the others, whose capacities all shrink."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    eight, nine = ({r.doc_id: r.shard for r in sharding.assign(docs, n).collect()} for n in (8, 9))
    assert sum(nine[d] == 8 for d in nine) == 20_000 // 9
    assert sum(nine[d] not in (8, eight[d]) for d in nine) < 0.05 * 20_000


def test_slack_moves_fewer_keys(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    moved = {}
    for slack in (0.0, 0.5):
        eight, nine = ({r.doc_id: r.shard for r in sharding.assign(docs, n, slack=slack).collect()} for n in (8, 9))
        moved[slack] = sum(eight[d] != nine[d] for d in eight) / 4000
    assert moved[0.5] < 0.2 and moved[0.5] <= moved[0.0]


# packing


@pytest.fixture(scope="module")
def spec():
    import public_tokenizers

    return packing.tokenizer_spec(public_tokenizers.path("word_bpe_49k.json"))


def test_packing_round_trip(spark, spec):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    docs = documents(spark).repartition(3)
    rows = packing.pack(clashing(docs, "start"), spec).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    want = Counter((r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.collect())
    for (d, ids), times in want.items():
        own = pieces[d, len(ids)]
        # a row that comes twice is cut each time for itself: each id lies in as many pieces
        times_at = Counter((r.start + i, x) for r in own for i, x in enumerate(r.ids))
        assert times_at == Counter({(i, x): times for i, x in enumerate(ids)})
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0, *(r.length for r in s)])[:-1].tolist()
        n = sum(r.length for r in s)
        assert n <= 2048 and {r.padding for r in s} == {0 if n & (n - 1) == 0 else 2048 - n} and {r.sequence_tokens for r in s} == {n}
    padding = sum(s[0].padding for s in sequences.values())
    assert padding < 0.02 * sum(r.length for r in rows)
    assert packing.pack(spark.createDataFrame([], COLUMNS), spec).count() == 0


def test_pieces_lie_at_class_tops():
    for n in [*range(1, 5000), 100_000]:
        found = list(packing.cuts(n, 2048, 128))
        assert sum(found) == n and all(p <= 128 or p == 2048 // (2048 // p) for p in found)


def test_words_encode_as_by_the_tokenizer(spec):
    rng = random.Random(0)
    ids = packing.Ids(spec, most=50)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZßàéîöüÀÉÖçñ.,;!?*$%|-'<>|0123456789\u0301œ×÷"
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        assert ids.encode(word.encode(), b"") == ids.whole(word), word
    assert ids.encode("A<|endoftext|>B <|ENDOFTEXT|>".encode(), b"") == ids.whole("A<|endoftext|>B <|ENDOFTEXT|>")


# Kneser-Ney


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts, order):
        self.order, tokens = order, [[*space_words(low(t)), "\n"] for t in texts]
        self.words = Counter(x for w in tokens for x in w)
        grams = Counter(tuple(p[i : i + order]) for w in tokens for p in [["<"] * (order - 1) + w] for i in range(len(w)))
        self.counts, self.cuts, self.after = {order: grams}, {}, {}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        for n, c in self.counts.items():
            of = Counter(c.values())
            self.cuts[n] = kneser_ney.discounts(*(of[i] for i in (1, 2, 3, 4)))
            self.after[n] = defaultdict(list)
            for g, k in c.items():
                self.after[n][g[:-1]].append(k)

    def p(self, g):
        n = len(g)
        if not n:
            return 1 / (len(self.words) + 1)
        if not (after := self.after[n].get(g[:-1])):
            return self.p(g[1:])
        d, k = self.cuts[n], self.counts[n][g]
        return (k - (d[min(k, 3) - 1] if k else 0)) / sum(after) + sum(d[min(x, 3) - 1] for x in after) / sum(after) * self.p(g[1:])

    def log10(self, text):
        w = [*space_words(low(text)), "\n"]
        p = ["<"] * (self.order - 1) + w
        base = sum(np.log10((self.words[x] + 1) / (sum(self.words.values()) + len(self.words) + 1)) for x in w)
        return len(w), sum(x in self.words for x in w), round(sum(np.log10(self.p(tuple(p[i : i + self.order]))) for i in range(len(w))), 6), round(base, 6)


@pytest.mark.parametrize(("order", "key", "shard"), [(2, 64, 4_000_000), (2, 8, 500), (3, 64, 500), (4, 30, 2000)])
def test_model_against_brute_force(spark, monkeypatch, order, key, shard):
    """Numbers side by side in the keys, and hashed into them; one shard, and many with dealt-out contexts."""
    monkeypatch.setattr(kneser_ney, "KEY", key)
    monkeypatch.setattr(kneser_ney, "GRAMS", shard)
    docs = documents(spark, [prose(random.Random(i), 300, 20) for i in range(6)]).withColumn("out", F.col("doc_id") % 5 == 2)
    learned, everything = docs.where("out is null or not out"), [(r.doc_id, r.text) for r in docs.collect()]
    plain = Plain([r.text for r in learned.collect()], order)
    for h in list(plain.after[order])[:3]:
        assert sum(plain.p((*h, w)) for w in plain.words) + plain.p((*h, "never seen")) == pytest.approx(1)
    model = kneser_ney.train(learned, order=order)
    want = Counter((i, *plain.log10(t)) for i, t in everything)
    got = model.score(clashing(docs, "score", "_text", "part")).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6), round(r.base_score, 6)) for r in got) == want
    model.delete()


@pytest.mark.parametrize("order", [2, 3])
def test_model_of_nothing(spark, order):
    model = kneser_ney.train(spark.createDataFrame([], COLUMNS), order=order)
    r = model.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.base_score, r.score) == (3, 0, 0.0, 0.0)
    assert model.score(spark.createDataFrame([], COLUMNS)).count() == 0
    model.delete()


@pytest.mark.parametrize(("n", "bits"), [(2, 21), (3, 22), (2, 40)])
def test_packed_grams_come_back(n, bits):
    """Counts above 2**32 and word numbers above 2**32 too."""
    rng = np.random.default_rng(0)
    codec = kneser_ney.Grams(n, bits)
    ids = [rng.integers(0, 1 << bits, 1000).astype(np.uint64) for _ in range(n)]
    keys, counts, *ids = kneser_ney.summed(codec.keys(ids), rng.integers(1, 1 << 40, 1000), *ids)
    a, b, *c = codec.unpack(codec.pack(keys, counts, ids))
    assert (a == keys).all() and (b == counts).all() and all((x == y).all() for x, y in zip(codec.ids(a) if codec.whole else c, ids))
    assert (kneser_ney.Grams(n, bits).keys(ids) == keys).all()


def test_counts_beyond_32_bits(spark):
    """A pair that comes 2**33 times: counts go through shuffles, sums and files whole."""
    model = kneser_ney.train(spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id long, text string"))
    v, codec = model.vocabulary, model.codecs[2]
    ids, _, _ = v.tokens_of([b"a b"], 2)
    keys, counts, *own = kneser_ney.summed(codec.keys(ids), np.full(3, 1 << 33, np.int64), *ids)
    blobs = spark.createDataFrame(kneser_ney.dealt(model, 2, keys, counts, own, model.hot(v.counts(own[0]))).to_pylist() * 2, "shard int, blob binary")
    said = kneser_ney.stored(blobs, 2, model).where(f"what = {kneser_ney.CONTEXT}").groupBy("key").agg(F.sum("c").alias("c"), F.sum("n3").alias("n3")).collect()
    assert {(r.key, r.c, r.n3) for r in said} == {(int(i), 1 << 34, 1) for i in own[0]}
    fresh = kneser_ney.Table(model.folder, "grams2", "<u8")
    assert fresh.look_up(model.shard(2, own, keys, model.hot(v.counts(own[0]))), keys, 0)[0].tolist() == [1 << 34] * 3
    model.delete()


# url filter


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme.com/en/", "http://Example.COM/en/x?y#z", "https://www.example.com/en/1", "http://a.example.net/es/", "http://net/fr/q", "http://x.net?u=/es/", "ftp://h#f", "a://b://c/d", "http://xexample.com/en/", "http://com"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    none = spark.createDataFrame([], "url string, bad int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(clashing(pages, "host"), none).collect()}
    assert found == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("example.com", "/en/x", "example.com/en/", "block"), 4: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        5: ("a.example.net", "/es/", "net/es/", "block"), 6: ("net", "/fr/q", "net/fr/", "block"), 7: ("x.net", "", None, "allow"), 8: ("h", "", None, "allow"), 9: ("b:", "//c/d", None, "allow"),
        10: ("xexample.com", "/en/", "com/", "allow"), 11: ("com", "", None, "allow"),
    }


def test_pages_of_odd_kinds(spark):
    """No pages, pages that repeat, a very long url, helper names that the input has."""
    none = spark.createDataFrame([], "url string, bad int")
    assert url_filter.judge(spark.createDataFrame([], "page_id int, url string"), none).count() == 0
    long = "http://a.b.gov.br/" + "x/" * 200_000
    pages = clashing(spark.createDataFrame([(1, long), (1, long), (2, None), (2, None)], "page_id int, url string"), "_parsed", "_u", "n", "bad", "mean", "var", "domain", "parent")
    found = url_filter.judge(pages, spark.createDataFrame([(long, 1)] * 40 + [(long, None)] + [("http://fine.org/", 0)] * 400, "url string, bad int"))
    assert found.columns == [*pages.columns, "host", "path", "rule", "bad_rate", "bound", "verdict"]
    assert Counter((r.page_id, r.host, r.verdict, r._u, r["var"]) for r in found.collect()) == {(1, "a.b.gov.br", "block", "own", "own"): 2, (2, "", "allow", "own", "own"): 2}


def test_suffixes(spark):
    hosts = {"a.b.gov.br": ("b.gov.br", "gov.br"), "x.co.uk": ("x.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "www.a.com": ("a.com", "com"), "x.de": ("x.de", "de"), "": ("", ""), "uk": ("uk", "uk"), "10.0.0.1": ("10.0.0.1", ""), "a.com.info": ("com.info", "info")}
    found = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", *(c.alias(n) for c, n in zip(url_filter.levels(F.col("host"), url_filter.SECOND), ("domain", "suffix")))).collect()
    assert {r.host: (r.domain, r.suffix) for r in found} == hosts


def test_reputation_shrinks_to_the_domain(spark):
    rows = [(f"bad{i}.evil.org", 50, 45) for i in range(5)] + [(f"h{i}.fine.org", 50, 2) for i in range(5)] + [("new.evil.org", 0, 0), ("new.fine.org", 0, 0), ("one.fine.org", 1, 1)]
    found = {r.host: r for r in url_filter.reputations(spark.createDataFrame(rows, "host string, n long, bad long")).collect()}
    assert found["new.evil.org"].mean > 0.7 > 0.3 > found["new.fine.org"].mean
    assert found["new.fine.org"].mean < found["one.fine.org"].mean < 0.5
    assert found["bad1.evil.org"].domain == "evil.org" and found["bad1.evil.org"].suffix == "org"
    pages = spark.createDataFrame([(1, "http://bad1.evil.org/"), (2, "http://h1.fine.org/")], "page_id int, url string")
    seen = spark.createDataFrame([("http://bad1.evil.org/x", 1)] * 45 + [("http://h1.fine.org/x", 0)] * 45, "url string, bad int")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, seen).collect()} == {1: "block", 2: "allow"}


# weak labels


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.3
    accuracy = (0.95, 0.8, 0.7)
    votes = np.stack([np.where(rng.random(20000) < 0.2, 2, np.where(rng.random(20000) < a, truth, ~truth)) for a in accuracy])
    codes = (votes * 3 ** np.arange(3)[:, None]).sum(0)
    posterior, shares, prior = weak_labels.expectation_maximisation(Counter(codes.tolist()), 3, 0.5)
    assert prior == pytest.approx(0.3, abs=0.05)
    for j, a in enumerate(accuracy):
        assert shares[j, 1, 1] / (shares[j, 1, 1] + shares[j, 1, 0]) == pytest.approx(a, abs=0.06)
    assert np.mean((np.array([posterior[c] for c in codes.tolist()]) > 0.5) == truth) > 0.85


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = weak_labels.classify(docs, labels.where("doc_id % 2 = 0"), keep=["doc_id"])
    judged = found.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([(r.quality_score >= 0.5) == (r.quality == 1) for r in judged]) > 0.9
    clean = [r for r in judged if r.quality == 1 and r.toxic == 0]
    assert np.mean([r.kept for r in clean]) > 0.93
    alone = weak_labels.classify(docs, keep=["doc_id"]).join(labels, "doc_id").collect()
    assert np.mean([r.kept for r in alone if r.quality == 1 and r.toxic == 0]) > 0.9


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    """Three texts (one is null) of 100 documents each among 300 others: each is about a sixth of the sample. Equal rows are drawn once, judged documents first."""
    rng, drawn = random.Random(4), []
    hot = [None, prose(rng, 31), prose(rng, 47)]
    texts = [hot[i % 3] for i in range(300)] + [prose(rng, rng.randrange(60, 200)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, "equal rows")] * 100
    fit = weak_labels.fit
    monkeypatch.setattr(weak_labels, "fit", lambda rows, *a: drawn.append(rows) or fit(rows, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert weak_labels.classify(docs, sample=120).count() == 700
    known = {tuple(weak_labels.Features([(t or "").encode()], weak_labels.Buckets(1 << 18)).both()): i for i, t in enumerate([*hot, "equal rows"])}
    found = Counter(known.get(tuple(r), 4) for r in drawn[0])
    assert sum(found.values()) == 120 and found[3] <= 1 and all(6 <= found[k] <= 40 for k in range(3))
    judged = spark.createDataFrame([(i, 1, 0) for i in range(300, 400)], "doc_id long, quality int, toxic int")
    weak_labels.classify(docs, judged, sample=120).count()
    own = {tuple(weak_labels.Features([t.encode()], weak_labels.Buckets(1 << 18)).both()) for t in texts[300:400]}
    assert own <= {tuple(r) for r in drawn[2]}


def test_most_frequent_word_of_a_long_text(monkeypatch):
    text = b"same " * 300 + b"other words " * 20
    want = weak_labels.shapes([text, b"a"], weak_labels.Marked())
    monkeypatch.setattr(words, "SLICE", 100)
    assert want[0, 2] == 300 / 340 and (weak_labels.shapes([text, b"a"], weak_labels.Marked()) == want).all()


def test_shapes_and_votes_against_plain_counts():
    """Shares by plain counting, and each labeller's rule by hand."""
    lexicons = weak_labels.Lexicons(np.array([xxhash.xxh64_intdigest(b"two") % (1 << 18)]), np.array([xxhash.xxh64_intdigest(b"chang", 1) % (1 << 18)]))
    nothing = weak_labels.Lexicons(np.empty(0, int), np.empty(0, int))
    seen = set()
    texts = [x or "" for x in odd_texts()] + ["YOU IDIOT!! STOP!! NOW!!", "a stupid thing", "changes and a moron, moron!", "A. B. " * 30]
    raws = [t.encode() for t in texts]
    every, features = weak_labels.shapes(raws, weak_labels.Marked()), weak_labels.Features(raws, weak_labels.Buckets(1 << 18))
    lists = list(zip(features.lists(features.words), features.lists(features.stems)))
    said, unsaid = weak_labels.votes(every, features, lexicons), weak_labels.votes(every, features, nothing)
    for i, (t, raw) in enumerate(zip(texts, raws)):
        w, lines = space_words(t), [x for x in raw.split(b"\n") if x.strip()]
        three = Counter(zip(w, w[1:], w[2:]))
        n = max(1, len(w))
        want = [
            8 * sum(x in b"#*$%&|<>{}[]\\^~_=+@" for x in raw) / max(1, len(raw)), sum(c for c in three.values() if c > 1) / n, max(Counter(w).values(), default=0) / n, 2 * sum(65 <= x <= 90 for x in raw) / max(1, len(raw)),
            sum(not x.rstrip().endswith(weak_labels.ENDS) for x in lines) / max(1, len(lines)), sum(len(x.encode()) < 3 for x in w) / n, 250 / max(50, 5 * len(w)) if len(w) < 50 else 0, 10 * t.count("!") / n,
        ]
        assert every[i] == pytest.approx([min(1.0, x) for x in want])
        plain = [x.encode() for x in plain_words(t)]
        abuse = sum(x.decode(errors="replace") in weak_labels.ABUSE for x in plain)
        assert features.abuse[i] == abuse and set(lists[i][0]) == {xxhash.xxh64_intdigest(x) % (1 << 18) for x in plain}
        over = lambda x, high, low: 0 if x > high else 1 if x < low else 2
        s = [min(1.0, x) for x in want]
        quality = [over(s[0], 0.35, 0.15), over(s[1], 0.4, 0.15), over(s[2], 0.3, 0.15), over(s[3], 0.7, 0.3), over(s[4], 0.8, 0.4), 0 if s[5] > 0.6 else 2, 0 if s[6] > 0.9 else 2]
        toxic = [1 if abuse else 2, int(b"two" in plain), int(any(x.startswith(b"chang") and len(x) > 5 for x in plain)), 1 if s[7] > 0.5 and s[3] > 0.5 else 2 if s[7] else 0]
        digits = lambda v, k: [v // 3**i % 3 for i in range(k)]
        assert digits(said[0][i], 7) == quality and digits(said[1][i], 4) == toxic
        assert digits(unsaid[1][i], 4)[1:3] == [2, 2] and unsaid[1][i] + lexicons.votes(*lists[i]) == said[1][i]
        seen |= set(enumerate(toxic))
    assert {(0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)} <= seen


def test_em_against_plain_steps():
    """The same posteriors from rows instead of patterns, one after the other."""
    rng = np.random.default_rng(1)
    rows = [tuple(r) for r in rng.integers(0, 3, (400, 4)).tolist()]  # three labellers and a judgement
    codes = Counter(sum(v * 3**i for i, v in enumerate(r)) for r in rows)
    posterior, shares, prior = weak_labels.expectation_maximisation(codes, 3, 0.4, judged=True, rounds=20)
    q = [float(r[3]) if r[3] < 2 else (0.4 + sum(v == 1 for v in r[:3])) / (1 + sum(v < 2 for v in r[:3])) for r in rows]
    for _ in range(20):
        count = [[[8.0 if v == c else 2.0 if v == 2 else 1.0 for v in range(3)] for c in range(2)] for _ in range(3)]
        for r, x in zip(rows, q):
            for i in range(3):
                count[i][1][r[i]] += x
                count[i][0][r[i]] += 1 - x
        share = [[[v / sum(c) for v in c] for c in by] for by in count]
        p = (sum(q) + 1) / (len(rows) + 2)
        new = []
        for r in rows:
            a, b = p, 1 - p
            for i in range(3):
                a, b = a * share[i][1][r[i]], b * share[i][0][r[i]]
            new.append(float(r[3]) if r[3] < 2 else a / (a + b))
        q = new
    assert prior == pytest.approx(p) and shares == pytest.approx(np.array(share))
    assert [posterior[sum(v * 3**i for i, v in enumerate(r))] for r in rows] == pytest.approx(q)


def test_toxic_words_of_other_languages(spark):
    """Words that no list has are learned from judgements, also by their beginnings."""
    rng = random.Random(12)
    stems = [f"zorg{x}" for x in ("a", "e", "i", "o")]
    texts = [" ".join(rng.sample(prose(rng, 80).split(), 80) + ([rng.choice(stems) + rng.choice("bdfgk") + rng.choice("aeiou") for _ in range(3)] if i % 5 == 0 else [])) + "." for i in range(1000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(500)], "doc_id long, quality int, toxic int")
    found = weak_labels.classify(docs, labels).where("doc_id >= 500").collect()
    assert np.mean([r.toxic_score >= 0.5 for r in found if r.doc_id % 5 == 0]) > 0.9
    assert np.mean([r.toxic_score >= 0.5 for r in found if r.doc_id % 5]) < 0.02


def test_classifier_on_odd_rows(spark):
    docs = documents(spark)
    found = weak_labels.classify(clashing(docs, "kept", "_judged", "_mark", "_text", "f"))
    assert found.count() == docs.count() and found.columns == [*docs.columns, "_judged", "_mark", "_text", "f", "quality_score", "toxic_score", "kept"]
    assert weak_labels.classify(spark.createDataFrame([], COLUMNS)).count() == 0
