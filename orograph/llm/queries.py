"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, statement: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if statement:
            SQL[name] = statement
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack, tokenizer_spec

    return pack(table(spark, sf_dir, "documents"), tokenizer_spec(public_tokenizers.path("word_bpe_49k.json")), with_ids=False)


@query("op1_decontaminate", sql.DECONTAMINATE)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find, n_hit

    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"),
        F.array_join(F.transform("hit_spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("hit_spans"),
    )


@query("op8_quality_rules", sql.quality_rules())
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import measured

    found = measured(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words")


@query("op10_licenses", sql.license_scan())
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query("op6_url_filter", sql.url_judgement())
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge, outcomes_of

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = judge(pages, outcomes_of(pages, table(spark, sf_dir, "labels")), keep=["page_id"])
    return found.withColumns({x: F.round(x, 9) for x in ("bad_rate", "bound")})


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign

    found = assign(table(spark, sf_dir, "documents"), 8)
    return found.select("doc_id", "size", F.coalesce("text_crc32", F.lit(0).cast("long")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import grouped

    found = grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_kneser_ney")
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kneser_ney_corpus import score_corpus

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out).withColumn("learned", ~held_out)
    scored, tokens = score_corpus(docs, "learned", order=5, keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import marked
    from .native import space_word_count

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = marked(docs, carry=[F.col("doc_id"), space_word_count(F.col("text")).alias("n_words")])
    n_cut = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_cut.alias("n_cut"), F.size("spans").cast("long").alias("n_runs"), "spans")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .weak_labels import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
