"""Documents made ready for training, stage by stage, each with one operator of the text subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orograph.llm import decontaminate, line_dedup, packing, quality, simhash
from orograph.llm.shared import Folder


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents; those that stay keep their lines as they are written but for lines that fail a rule."""
    return recounted(quality.cleaned(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts runs of three lines and passages of 50 words that came before. Documents go that keep fewer words than the quality rules ask for and less than a fifth of their own: what is left of near-copies is scraps."""
    return recounted(line_dedup.cut(docs, least_words=50, least_share=0.2))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: those that share 0.8 (Jaccard) of their five-word shingles, directly or through others.

    Pairs whose 128 bits differ in 34 or fewer are compared shingle by shingle: texts that share 0.8 differ in 19.4 on average with a deviation of 4.1
    (binomial estimate), so about 1 in 10,000 such pairs is not compared; unrelated texts differ in 64."""
    return simhash.one_of_each(docs, shingle=5, radius=34, parts=2, similarity=0.8)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, packing.tokenizer_spec(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", quality_rules), ("line dedup", repeated_passages), ("SimHash near-dedup", near_copies), ("benchmark decontamination", benchmark_leaks), ("packing", packed)]

#: SQL has no SimHash and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is written to the shared folder and read again, so that a lost executor costs one stage's work at most; it goes when the next one is there (the last one with the driver)."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        folder = Folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(folder.uri)
        docs = spark.read.parquet(folder.uri)
        if before:
            before.delete()
        before = folder
    return docs
