"""Quality classifier from weak labels: labellers vote, EM estimates their accuracies, posteriors train a hashed linear scorer."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import ALNUM, Hashes, distinct, fresh, map_texts, numbers

#: Words of abuse.
ABUSE = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
ABUSIVE = frozenset(w.encode() for w in ABUSE)
SYMBOLS = bytes(sorted(b"#*$%&|<>{}[]\\^~_=+@"))
CAPITALS = bytes(range(65, 91))
ENDS = (b".", b"!", b"?", b'"', b":", b";", b"\xe2\x80\xa6")
#: A labeller's vote: 1 for the class (good; toxic), 0 against it, 2 for none.
FOR, AGAINST, NONE = 1, 0, 2
N_SHAPES = 8
#: Bytes of a word's beginning that is a feature of its own, so that forms of one stem count together.
STEM = 5


class Marked(Hashes):
    """Word to its XXH64, the lowest bit of which says whether the word has one or two bytes."""

    def __init__(self, most: int = 500_000):
        super().__init__(most)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) & ~1 | (len(word) < 3)
        return h


def runs(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and length of each group of equal hashes (their upper 48 bits) of a row."""
    keys = np.sort((row.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    at = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.empty(0, np.int64)
    return (keys[at] >> np.uint64(48)).astype(np.int64), np.diff(np.append(at, len(keys)))


def shapes(texts: list[bytes], hashes: Marked) -> np.ndarray:
    """For each text shares from 0 to 1: symbols, words in repeated windows of three, most frequent word, capitals, lines without the end of a sentence, words of one or two bytes, shortness, exclamation marks. hashes: a memory of words, which may be any. At most 65,536 texts."""
    h, ends = numbers(texts, None, hashes.__getitem__, np.uint64)
    n, rows = np.diff(ends), len(texts)
    row = np.repeat(np.arange(rows), n)
    short = np.bincount(row, h & np.uint64(1), rows)
    of, length = runs(row, h)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, of, length)
    inside = row[:-2] == row[2:] if len(h) > 2 else np.empty(0, bool)
    three = (((h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + h[2:]) * np.uint64(0x94D049BB133111EB))[inside] if len(h) > 2 else h[:0]
    of, length = runs(row[: len(inside)][inside], three)
    repeats = np.bincount(of, np.where(length > 1, length, 0), rows)
    size = np.array([len(t) for t in texts])
    symbols, capitals = (size - [len(t.translate(None, x)) for t in texts] for x in (SYMBOLS, CAPITALS))
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    loose = np.array([sum(not x.rstrip().endswith(ENDS) for x in ls) / max(1, len(ls)) for ls in lines])
    cries = np.array([t.count(b"!") for t in texts])
    m, k = np.maximum(1, n), np.maximum(1, size)
    return np.minimum(1.0, np.stack([8 * symbols / k, repeats / m, most / m, 2 * capitals / k, loose, short / m, np.where(n < 50, 250 / np.maximum(50, 5 * n), 0.0), 10 * cries / m], axis=1))


class Buckets(dict):
    """Word (lower case) to the numbers of its bucket and of that of its beginning (its own for short words), and whether it is a word of abuse, in one number."""

    def __init__(self, size: int, most: int = 300_000):
        self.size, self.most = size, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        own = xxhash.xxh64_intdigest(word) % self.size
        stem = xxhash.xxh64_intdigest(word[:STEM], 1) % self.size if len(word) > STEM else own
        found = self[word] = own | stem << 24 | (word in ABUSIVE) << 48
        return found


class Features:
    """Of some texts, each row and bucket once (by rows, then buckets): words, their beginnings, both; and how many words of abuse a row has."""

    def __init__(self, texts: list[bytes], buckets: Buckets):
        found, ends = numbers(texts, ALNUM, buckets.__getitem__, np.int64)
        self.rows = len(texts)
        row = np.repeat(np.arange(self.rows), np.diff(ends))
        self.abuse = np.bincount(row, found >> 48, self.rows).astype(np.int64)
        self.words, self.stems = distinct(row << 24 | found & 0xFFFFFF), distinct(row << 24 | found >> 24 & 0xFFFFFF)

    def both(self) -> np.ndarray:
        return distinct(np.concatenate([self.words, self.stems]))

    def lists(self, pairs: np.ndarray) -> list[np.ndarray]:
        """The buckets of each row."""
        return np.split(pairs & 0xFFFFFF, np.searchsorted(pairs >> 24, np.arange(1, self.rows)))

    def hit(self, pairs: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Whether a row has one of these buckets."""
        found = np.zeros(self.rows, bool)
        found[(pairs >> 24)[np.isin(pairs & 0xFFFFFF, buckets, kind="table")]] = True
        return found


class Lexicons:
    """Buckets that go with toxic judgements: of words, from half of the judged documents, and of beginnings, from the other half."""

    def __init__(self, of_words: np.ndarray, of_stems: np.ndarray):
        self.of_words, self.of_stems = of_words, of_stems

    def votes(self, own: np.ndarray, stems: np.ndarray) -> int:
        """What has to be added to the votes of one row for which there were no lexicons."""
        return sum(((FOR if np.isin(x, y).any() else AGAINST) - NONE) * 3**i for i, x, y in ((1, own, self.of_words), (2, stems, self.of_stems)) if len(y))


def telling(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, size: int, least_rows: int, deviations: float) -> np.ndarray:
    """How many standard deviations each bucket's share of the class is from that of all rows; 0 for buckets in fewer than least_rows rows, or within `deviations`."""
    if not len(rows):
        return np.zeros(size)
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n = np.bincount(flat, weight[of], size)
    share = (weight @ target) / weight.sum()
    z = (np.bincount(flat, (weight * target)[of], size) - n * share) / np.sqrt(np.maximum(n, 1e-9) * max(share * (1 - share), 1e-9))
    return np.where((np.bincount(flat, minlength=size) >= least_rows) & (np.abs(z) >= deviations), z, 0.0)


def votes(shape: np.ndarray, found: Features, lexicons: Lexicons) -> tuple[np.ndarray, np.ndarray]:
    """What the labellers of quality and of toxicity say of each row, each a number with a digit (base 3) for every labeller."""
    symbols, repeats, most, capitals, loose, short, brief, cries = shape.T

    def over(x: np.ndarray, high: float, low: float) -> np.ndarray:
        return np.where(x > high, AGAINST, np.where(x < low, FOR, NONE))

    def said(x: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        return np.where(found.hit(x, buckets), FOR, AGAINST) if len(buckets) else np.full(found.rows, NONE)

    quality = (over(symbols, 0.35, 0.15), over(repeats, 0.4, 0.15), over(most, 0.3, 0.15), over(capitals, 0.7, 0.3), over(loose, 0.8, 0.4), np.where(short > 0.6, AGAINST, NONE), np.where(brief > 0.9, AGAINST, NONE))
    # four views: a list of words, what judged documents tell of words, what others of them tell of beginnings, and the tone
    toxic = (
        np.where(found.abuse > 0, FOR, NONE), said(found.words, lexicons.of_words), said(found.stems, lexicons.of_stems),
        np.where((cries > 0.5) & (capitals > 0.5), FOR, np.where(cries == 0, AGAINST, NONE)),
    )
    return tuple(sum(v * 3**i for i, v in enumerate(x)).astype(np.int32) for x in (quality, toxic))


N_LABELLERS = {"quality": 7, "toxic": 4}


def expectation_maximisation(patterns: dict[int, int], n: int, prior: float, judged: bool = False, rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of the class for each pattern of votes, the labellers' vote shares P(vote | class) [labeller, class, vote], and the class's share.

    judged: a further digit is a judgement, which settles the class where there is one. Labellers are taken as independent given the class. It starts from the share of votes for the class, with pseudo-counts by which a labeller is rather right than wrong."""
    codes = np.array(sorted(patterns), np.int64)
    weight = np.array([patterns[c] for c in codes.tolist()], float)
    digits = codes[:, None] // 3 ** np.arange(n + judged) % 3
    cast = (digits[:, :n] != NONE).sum(1)
    given = digits[:, n] if judged else np.full(len(codes), NONE)
    digits = digits[:, :n]
    q = np.where(given == NONE, (prior + (digits == FOR).sum(1)) / (1.0 + cast), given == FOR)
    trust = np.array([[8.0, 1.0, 2.0], [1.0, 8.0, 2.0]])  # [class][against, for, none]
    shares = np.zeros((n, 2, 3))
    for _ in range(rounds):
        by_class = np.stack([(1 - q) * weight, q * weight])
        for v in range(3):
            shares[:, :, v] = ((digits == v)[None] * by_class[:, :, None]).sum(1).T + trust[:, v]
        shares /= shares.sum(2, keepdims=True)
        prior = (by_class[1].sum() + 1) / (weight.sum() + 2)
        log = np.log([1 - prior, prior]) + np.log(shares)[np.arange(n)[None, :], :, digits].sum(1)
        new = np.where(given == NONE, 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500))), given == FOR)
        if np.abs(new - q).max(initial=0.0) < 1e-9:
            break
        q = new
    return dict(zip(codes.tolist(), q.tolist())), shares, prior


def fit(rows: list[np.ndarray], dense: np.ndarray, target: np.ndarray, weight: np.ndarray, size: int, use: np.ndarray, epochs: int = 12, rate: float = 0.3, ridge: float = 2e-4) -> np.ndarray:
    """Logistic regression on soft targets by AdaGrad: weights of buckets (0 for those not in use), of shapes, and the bias."""
    kept = [r[use[r]] for r in rows]
    lengths = np.array([len(r) for r in kept])
    flat = np.concatenate([*kept, np.empty(0, np.int64)]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    w, g2 = np.zeros(size + N_SHAPES + 1), np.full(size + N_SHAPES + 1, 1e-2)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            n = lengths[batch]
            at = np.repeat(starts[batch] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            cols, of = flat[at], np.repeat(np.arange(len(batch)), n)
            z = np.bincount(of, w[cols], len(batch)) + dense[batch] @ w[size:-1] + w[-1]
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[batch]) * weight[batch]
            g = np.zeros_like(w)
            g[:size] = np.bincount(cols, e[of], size)
            g[size:-1], g[-1] = e @ dense[batch], e.sum()
            g = np.where(w != 0, ridge * w, 0.0) + g / len(batch)
            g2 += g * g
            w -= rate * g / np.sqrt(g2)
    return w


def classify(
    docs: DataFrame, known: DataFrame | None = None, *, doc: str = "doc_id", text: str = "text", keep: list[str] | None = None, sample: int = 8000, most_features: int = 4096, size: int = 1 << 18, least_rows: int = 4, deviations: float = 4.0, faith: tuple[float, float] = (0.2, 0.02),
) -> DataFrame:
    """`keep` (default: all columns) and quality_score, toxic_score (0 to 1) and kept (quality_score >= 0.5 and toxic_score < 0.5).

    known(doc, quality, toxic): judgements of some documents; EM takes them as right, and learns the labellers' accuracies from all documents. Several rows of
    a document count as their largest values, other values than 0 and 1 and documents that it lacks as no vote.
    A sample of at most `sample` documents, judged ones first, then by a hash of id and text (equal rows are drawn once), comes to the driver, each as at most most_features bucket
    numbers (those with the least): a bound that doesn't grow with the input. From it come two of the labellers of toxicity, and on it the scorer is fitted, for which an EM posterior weighs
    `faith` (of quality; of toxicity, of which the labellers see less) of a judgement. The votes of all documents are counted by pattern (at most 3**8 x 3**5 rows come to the driver) and give the labellers' accuracies
    and each pattern's posterior by EM. Buckets take part that are in least_rows rows and whose share of the class is `deviations` standard deviations from that of all;
    documents of a rarer class weigh more, up to 4 times. All documents are scored, whole, however long. A null or empty text has no words and the scores of that. Repeated rows count each, and get
    the same scores. No rows: no rows. Columns with the new names give way, others may have any name."""
    if size > 1 << 24:
        raise ValueError("a bucket's number has 24 bits")
    spark = docs.sparkSession
    judge, mark, quality, toxic = fresh(docs, "judged", "mark", "quality", "toxic")
    if known is None:
        by_doc = spark.createDataFrame([], f"{judge} {docs.schema[doc].dataType.simpleString()}, {quality} int, {toxic} int")
    else:
        by_doc = known.groupBy(F.col(doc).alias(judge)).agg(*(F.max(F.when(F.col(n).isin(0, 1), F.col(n))).cast("int").alias(own) for n, own in (("quality", quality), ("toxic", toxic))))

    # the sample: judged documents first
    marked = docs.select(docs[doc].alias(doc), docs[text].alias(text), F.xxhash64(F.lit("sample"), docs[doc], docs[text]).alias(mark))
    ranked = marked.select(doc, mark).join(by_doc, F.col(doc) == F.col(judge), "left").select(mark, F.coalesce(F.col(quality), F.col(toxic)).isNull().alias("late"), quality, toxic)
    first = ranked.groupBy(mark).agg(F.min("late").alias("late"), F.max(quality).alias(quality), F.max(toxic).alias(toxic)).orderBy("late", mark).limit(sample).collect()
    judgement = {r[mark]: (r[quality], r[toxic]) for r in first}
    wanted = F.broadcast(spark.createDataFrame([(m,) for m in judgement], f"{mark} long"))
    fields = [T.StructField("quality_votes", T.IntegerType(), False), T.StructField("toxic_votes", T.IntegerType(), False)]
    drawn = [T.StructField("f", T.BinaryType(), False), T.StructField("g", T.BinaryType(), False), T.StructField("s", T.BinaryType(), False), *fields]

    def draw():
        buckets, hashes = Buckets(size), Marked()

        def work(texts: list[bytes]) -> tuple:
            found, shape = Features(texts, buckets), shapes(texts, hashes)
            own, stems = ([x[:most_features].astype("<i4").tobytes() for x in found.lists(pairs)] for pairs in (found.words, found.stems))
            return own, stems, [x.tobytes() for x in shape], *votes(shape, found, Lexicons(np.empty(0, np.int64), np.empty(0, np.int64)))

        return work

    chosen = marked.join(wanted, mark, "left_semi").dropDuplicates([mark])
    rows = sorted(map_texts(chosen, text, drawn, draw, [mark]).collect(), key=lambda r: r[mark])
    found = [(np.frombuffer(r.f, "<i4").astype(np.int64), np.frombuffer(r.g, "<i4").astype(np.int64)) for r in rows]
    dense = np.array([np.frombuffer(r.s) for r in rows]).reshape(-1, N_SHAPES)
    judged = {"quality": [judgement[r[mark]][0] for r in rows], "toxic": [judgement[r[mark]][1] for r in rows]}

    def lexicon(which: int) -> np.ndarray:
        at = [i for i, x in enumerate(judged["toxic"]) if x is not None and rows[i][mark] % 2 == which]
        target = np.array([judged["toxic"][i] for i in at], float)
        return np.nonzero(telling([found[i][which] for i in at], target, np.ones(len(at)), size, least_rows, max(6.0, deviations)) > 0)[0]

    lexicons = Lexicons(lexicon(0), lexicon(1))
    told = spark.sparkContext.broadcast(lexicons)

    def vote():
        buckets, hashes = Buckets(size), Marked()

        def work(texts: list[bytes]) -> tuple:
            return tuple(pa.array(x) for x in votes(shapes(texts, hashes), Features(texts, buckets), told.value))

        return work

    cast = map_texts(docs, text, fields, vote, [doc])
    digits = {n: F.coalesce(F.col(own), F.lit(NONE)) * 3 ** N_LABELLERS[n] for n, own in (("quality", quality), ("toxic", toxic))}
    counts = cast.join(by_doc, F.col(doc) == F.col(judge), "left").groupBy(*((F.col(f"{n}_votes") + d).cast("int").alias(n) for n, d in digits.items())).agg(F.count("*").alias("n")).collect()
    weights = {}
    for name, prior in (("quality", 0.8), ("toxic", 0.1)):
        tally: Counter = Counter()
        for r in counts:
            tally[r[name]] += r.n
        posterior = expectation_maximisation(dict(tally), N_LABELLERS[name], prior, judged=True)[0]
        if not rows:
            weights[name] = np.zeros(size + N_SHAPES + 1)
            continue
        which, last = ("quality", "toxic").index(name), 3 ** N_LABELLERS[name]
        said = [r.quality_votes for r in rows] if name == "quality" else [r.toxic_votes + lexicons.votes(*x) for r, x in zip(rows, found)]
        target = np.array([posterior[v + (NONE if j is None else j) * last] for v, j in zip(said, judged[name])])
        weight = np.where([j is None for j in judged[name]], faith[which], 1.0)
        rare = min(target.mean(), 1 - target.mean())
        weight = weight * np.where((target >= 0.5) == (target.mean() < 0.5), min(4.0, 0.5 / max(rare, 1e-6)), 1.0)
        both = [np.union1d(x, y) for x, y in found]
        weights[name] = fit(both, dense, target, weight, size, telling(both, target, weight, size, least_rows, deviations) != 0)
    sent = spark.sparkContext.broadcast({k: v.astype(np.float32) for k, v in weights.items()})

    def score():
        buckets, hashes = Buckets(size), Marked()

        def work(texts: list[bytes]) -> tuple:
            pairs, shape = Features(texts, buckets).both(), shapes(texts, hashes)
            out = [np.bincount(pairs >> 24, w[pairs & 0xFFFFFF], len(texts)) + shape @ w[size:-1] + w[-1] for w in (sent.value["quality"], sent.value["toxic"])]
            q, x = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in out)
            return pa.array(q), pa.array(x), pa.array((q >= 0.5) & (x < 0.5))

        return work

    return map_texts(docs, text, [T.StructField("quality_score", T.DoubleType(), False), T.StructField("toxic_score", T.DoubleType(), False), T.StructField("kept", T.BooleanType(), False)], score, keep)
