"""The model laid on the table that it is learned from: brute force, shards that split contexts, the registered order."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.llm import kneser_ney_corpus as corpus
from orograph.llm import queries

from .helpers import COLUMNS, clashing, documents, prose
from .test_corpus import Plain


def rounded(rows):
    return Counter((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6), round(r.base_score, 6)) for r in rows)


@pytest.mark.parametrize(("order", "shard", "gathered"), [(2, 50, 500), (3, 300, 2000), (5, 1_000_000, 2_000_000), (5, 20, 700)])
def test_corpus_against_brute_force(spark, monkeypatch, order, shard, gathered):
    """One shard an executor's memory would hold, and many, of which hot words' contexts are split; copies, odd texts, names that clash."""
    monkeypatch.setattr(corpus, "SHARD", shard)
    monkeypatch.setattr(corpus, "GATHERED", gathered)
    docs = documents(spark, ["the of " * 60 * (i % 3) + prose(random.Random(i % 4), 300, 20) for i in range(6)]).withColumn("learned", F.coalesce(F.col("doc_id") % 5 != 2, F.lit(True)))
    everything = [(r.doc_id, r.learned, r.text) for r in docs.collect()]
    plain = Plain([t for _, learned, t in everything if learned], order)
    found, tokens = corpus.score_corpus(clashing(docs, "score", "_text", "_learned", "batch"), "learned", order=order)
    assert rounded(found.collect()) == Counter((i, *plain.log10(t)) for i, _, t in everything)
    assert tokens == sum(plain.words.values())


def test_hot_contexts_are_split(spark, monkeypatch):
    """No shard is left with all of a frequent word's n-grams."""
    monkeypatch.setattr(corpus, "SHARD", 150)
    words = corpus.vocabulary(spark.createDataFrame([(i, "the of " * 40 + prose(random.Random(i), 300, 20)) for i in range(6)], "doc_id long, text string"), "text", folder := corpus.Folder(spark, "test"))
    plan = corpus.Plan(words, 5, corpus.SHARD).number(spark)
    assert len(plan.hot) >= 2 and plan.deepest > 2
    rng = np.random.default_rng(0)
    columns = [rng.integers(2, 100, 5000).astype(np.uint32) for _ in range(3)] + [np.full(5000, plan.hot[0], np.uint32), rng.integers(2, 100, 5000).astype(np.uint32)]
    assert len(np.unique(plan.shard(columns))) == plan.shards
    folder.delete()


@pytest.mark.parametrize("order", [2, 5])
def test_corpus_of_nothing(spark, order):
    found, tokens = corpus.score_corpus(spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, learned boolean"), "learned", order=order)
    r = found.first()
    assert (tokens, r.n_tokens, r.n_known, r.base_score, r.score) == (0, 3, 0, 0.0, 0.0)
    assert corpus.score_corpus(spark.createDataFrame([], COLUMNS).withColumn("learned", F.lit(True)), "learned", order=order)[0].count() == 0


def test_registered_order(spark, tmp_path):
    """The query's score is that of five words: order 2 tells nothing of what stands before the word before."""
    texts = [prose(random.Random(i % 9), 200, 20) for i in range(30)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    learned = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    plain, pairs = Plain(learned, 5), Plain(learned, 2)
    found = queries.QUERIES["op9_kneser_ney"](spark, str(tmp_path)).collect()
    assert rounded(found) == Counter((i, *plain.log10(t)) for i, t in enumerate(texts))
    assert rounded(found) != Counter((i, *pairs.log10(t)) for i, t in enumerate(texts))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.train_tokens == sum(plain.words.values()) for r in found)
