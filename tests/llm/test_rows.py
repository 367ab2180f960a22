"""Operators whose rows come from one text each: brute force, and odd cases."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orograph.llm import decontaminate, licenses, quality, words
from orograph.llm.quality import repeated_words

from .helpers import COLUMNS, clashing, documents, low, plain_words, prose, space_words


def rows_of(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


# decontamination


def brute_hits(text, items, n=10):
    w, hit, found = plain_words(text), set(), set()
    for item, t in items:
        iw = plain_words(t)
        k = min(n, len(iw))
        windows = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("most", [4_000_000, 60])
def test_decontamination(spark, most):
    import random

    rng = random.Random(1)
    item = prose(rng, 25)
    items = [(3, item), (11, "two words"), (2, item), (5, None), (6, " . "), (7, "Zwölf Äpfel"), (8, prose(rng, 10))]
    docs = documents(spark, [prose(rng, 20) + " " + item.upper() + " " + prose(rng, 9), " ".join(item.split()[3:15]), "x zwölf-Äpfel y", " ".join(item.split()[:9]), item + " " + item])
    found = decontaminate.find(docs, spark.createDataFrame(items, "item_id long, text string"), most=most)
    assert found.columns == [*docs.columns, "n_words", "hit_spans", "items"]
    for r in rows_of(found):
        n, hit, ids = brute_hits(r["text"], items)
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["hit_spans"]), r["items"]) == (n, hit, ids)
    gone = decontaminate.remove(docs, spark.createDataFrame(items, "item_id long, text string"), most=most)
    assert gone.columns == docs.columns and gone.count() == sum(not brute_hits(r["text"], items)[1] for r in rows_of(docs))
    cut = rows_of(decontaminate.remove(docs, spark.createDataFrame(items, "item_id long, text string"), mode="spans"))
    assert len(cut) == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in rows_of(docs)}
    for r in cut:
        n, hit, _ = brute_hits(by_id[r["doc_id"]], items)
        assert len(plain_words(r["text"])) == n - hit and (hit or r["text"] == by_id[r["doc_id"]])


def test_decontamination_of_nothing(spark):
    none, items = spark.createDataFrame([], COLUMNS), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(none, items).count() == 0
    assert {r["items"] == [] for r in rows_of(decontaminate.find(documents(spark), items))} == {True}
    clash = decontaminate.find(clashing(documents(spark), "items", "n_words"), items)
    assert clash.columns.count("items") == 1 and dict(clash.dtypes)["n_words"] == "bigint"


def test_digest_of_items(spark):
    from orograph.llm.queries import QUERIES

    r = QUERIES["op1_decontaminate"](spark, "/root/testdata/sf0.001")
    clean = [x.items_sha256 for x in r.where("not contaminated").collect()]
    assert set(clean) == {hashlib.sha256(b"").hexdigest()}
    assert r.where("contaminated").count() > 0


# quality rules


def brute_base(t):
    t = t or ""
    w = space_words(t)
    tri, cover = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if space_words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)


def test_quality_counts(spark):
    docs = documents(spark, ["a b c a b c", "a b a b a b a b", "q w e r t\nq w e r t\n\n \nq w e r t", "one two three " * 30])
    found = quality.measured(clashing(docs, "kept"))
    for r in rows_of(found):
        want = brute_base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert quality.measured(spark.createDataFrame([], COLUMNS)).count() == 0


def test_word_counts_agree(spark):
    from orograph.llm.native import space_word_count
    from orograph.llm.native import space_words as sw

    for r in documents(spark, [" a\u00a0b c", "\x0b\x0ca\r\n"]).select("text", space_word_count(F.col("text")).alias("n"), F.size(sw(F.col("text"))).alias("m")).collect():
        assert r.n == r.m == len(space_words(r.text))


def test_repeated_words_when_hashes_clash(spark, monkeypatch):
    monkeypatch.setattr(quality, "INDEX_BITS", 60)  # four bits of hash: windows clash all the time
    docs = documents(spark, ["a b c a b c d e f g a b c"]).where("length(text) < 3000")
    from orograph.llm.native import let, space_words as sw

    for r in docs.select("text", let(sw(F.col("text")), repeated_words).alias("n")).collect():
        assert r.n == brute_base(r.text)[4]


def test_lines(spark):
    good = ". ".join(f"Sentence{i} word{i} other{i} and{i} more{i} of{i} this{i}" for i in range(12)) + "."
    nav = " | ".join(f"Link{i}" for i in range(12))
    rows = [(0, good), (1, nav + "\n" + good + "\nTerms of service apply.\nMenu"), (2, "\n".join([nav] * 9) + "\n" + good[:100]), (3, "*** $$$ ### " * 40)]
    found = {r.doc_id: r for r in quality.measured(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0].kept and found[0].clean_text == good
    assert found[1].kept and found[1].clean_text == good
    assert not found[2].kept and not found[3].kept
    kept = quality.cleaned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, good), (1, good)]


def test_native_operators_use_no_python(spark):
    docs = documents(spark)
    for frame in (quality.measured(docs), licenses.scan(docs)):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


# licences


def brute_places(t):
    w, at, labels = plain_words(t), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), sorted(labels)


def brute_matches(t, threshold):
    found, w = [], plain_words(t)
    for label, template in licenses.TEMPLATES:
        own, size, last = set(licenses.tokens(template)), licenses.width(template, threshold), None
        for i in range(len(w)):
            n = len(own & set(w[i : i + size]))
            if w[i] not in own or n < threshold * len(own) - 1e-9:
                continue
            if last is None or i >= last[0] + size:
                found.append(last := [i, n, label, own])
            elif n > last[1]:
                last[:2] = i, n
    return Counter((i, label, round(n / len(own), 9)) for i, n, label, own in found)


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_licences(spark, threshold):
    mit, apache = (next(x for label, x in licenses.TEMPLATES if len(x) > 100 and label == own) for own in ("mit", "apache"))
    more = ["cc by cc by, CC  BY!", "all rights all rights reserved", "\n".join(x for _, x in licenses.TEMPLATES), mit + " " + apache, " ".join(mit.split()[:-2]), "general public\nlicense", "ALL RIGHTS RESERVED\nthe the the"]
    docs = documents(spark, more)
    for r in rows_of(licenses.scan(clashing(docs, "score", "_found", "_f", "inner"), threshold=threshold)):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_places(r["text"])
        want = brute_matches(r["text"], threshold)
        assert Counter((m["start"], m["label"], round(m["containment"], 9)) for m in r["matches"]) == want
        assert r["labels"] == sorted({*r["base_labels"], *(x[1] for x in want)}) and 0 <= r["score"] <= 1
    assert licenses.scan(spark.createDataFrame([], COLUMNS)).count() == 0


def test_wrapped_licences(spark):
    """Long templates broken over lines, plain and as comments; their words far apart are none."""
    import random
    import textwrap

    rng, rows, want = random.Random(2), [], {}
    for label, template in licenses.TEMPLATES:
        for width, prefix in ((24, ""), (72, " * "), (40, "# ")):
            text = prose(rng, 30) + "\n" + textwrap.fill(template, width, initial_indent=prefix, subsequent_indent=prefix) + "\n" + prose(rng, 30)
            want[len(rows)] = label
            rows.append((len(rows), text))
    long = [x for _, x in licenses.TEMPLATES if 100 < len(x)]
    apart = {len(rows) + i: "\n".join(w + " " + prose(rng, 8) for w in x.split()) for i, x in enumerate(long)}
    rows += list(apart.items())
    found = {r["doc_id"]: r for r in rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert all(label in found[i]["labels"] and found[i]["score"] >= 0.9 for i, label in want.items())
    assert all(found[i]["matches"][0]["start"] >= 30 for i in want) and not any(found[i]["labels"] for i in apart)


# words


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(words, "SLICE", 40)
    text = " ".join(f"wörd{i}" for i in range(300)) + "x" * 200 + "\nend"
    assert [w for part in words.words(text.encode(), words.LOWER) for w in part] == text.encode().split()


def test_runs_of_rows_are_bounded():
    assert list(words.slices([5, 5, 100, 1, 1], 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(words.slices([], 10)) == [] and list(words.slices([0] * 70_000)) == [(0, 65_536), (65_536, 70_000)]
