"""The corpus pipeline: stages that each take the documents the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpipe.llm import decontaminate, line_dedup, packing, simhash, toxicity
from textpipe.llm.common import materialize, table
from textpipe.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A classifier, edit distances, fingerprints and tokenizers have no SQL.
ORACLE_SQL = None
# Documents with this score and more are rejected.
TOXIC = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(toxicity.trained_on()))
    return docs.filter(model.score() < TOXIC)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; all documents stay."""
    cleaned = line_dedup.clean(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.coalesce(length, "n_chars"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the documents in sequences."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
