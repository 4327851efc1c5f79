"""One query per operator of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpipe.llm import (
    decontaminate,
    line_dedup,
    merkle,
    packing,
    phrases,
    pii,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from textpipe.llm.common import table
from textpipe.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


# Host, path and verdict of the fixed rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


# The key of the query; a user keeps their own.
PII_KEY = b"key of the test tables"


def vocabulary() -> str:
    """The file of the public byte-level vocabulary."""
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(toxicity.trained_on()))
    scored = docs.select("doc_id", (~toxicity.trained_on()).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, benchmark).drop("text_key")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return found.withColumn("purity", F.round("purity", 6))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_rules.judged(docs, labels, toxicity.trained_on())
    return found.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decide(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("pos").alias("line"),
        F.col("first.doc_id").alias("first_doc"),
        F.col("first.pos").alias("first_line"),
        "n_links",
        "kept",
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicate(docs)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    return warc.deduplicate(table(spark, sf_dir, "pages"), path).select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    shown = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(table(spark, sf_dir, "documents"), shown={"n_chars": shown})


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), words)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_decontamination,
        op3_url_filter,
        op4_quality_rules,
        op5_line_dedup,
        op6_substring_dedup,
        op7_warc,
        op8_packing,
        op9_pii,
        op10_simhash,
        op11_merkle,
        op12_token_counts,
        op13_phrases,
    )
}
