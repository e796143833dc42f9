"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import chat, ctw, decontam, licenses, mixing, negatives, packing, quality, resampling, sharding, simhash, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its own name."""
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.extendible_shards(_read(spark, sf_dir, "documents"), rows=False)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, with the verdict of the base rules and of the current policy."""
    ledger = quality.quality_ledger(_read(spark, sf_dir, "documents"))
    counts = [m for m in quality.MEASURES if m not in ("n_lines", "n_capitals")]
    return ledger.select(
        "doc_id",
        *counts,
        quality.any_failed("few_words", "repeated_words").alias("base_failed"),
        quality.passes().alias("kept"),
        "n_lines",
        "n_capitals",
        "failures",
    )


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark occurs in every document."""
    found = decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(_read(spark, sf_dir, "documents"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as WARC archives and read back."""
    path = work_dir(spark, "warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), path)
    page = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("bigint")
    return warc.records(warc.read_warc(spark, path)).select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query
def op8_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The documents' token ids written to flat files and read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = work_dir(spark, "tokens")
    tokens.write_tokens(_read(spark, sf_dir, "documents"), path, tokenizer)
    return tokens.read_index(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and covered licence texts of every document."""
    return licenses.scan_licenses(_read(spark, sf_dir, "documents")).drop("spans")


@query
def op3_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its repaired role and its fragment of the rendered conversation."""
    return chat.repair_conversations(_read(spark, sf_dir, "conversations"))


@query
def op7_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document under the word counts and under the context trees of the training documents."""
    return ctw.language_scores(_read(spark, sf_dir, "documents"))


@query
def op11_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The pieces of every document and the sequences they are packed into."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer)


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document for the words of the benchmark."""
    return resampling.importance_resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every 50th vector, where every 7th is of the next label."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
