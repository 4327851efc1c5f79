"""Helpers of the tests in this folder."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark: SparkSession) -> DataFrame:
    """Nulls, empty and long texts, repeated rows, repeated ids, and clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta"),
        (1, "alpha beta gamma delta epsilon zeta"),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, long),
        (6, long + " end"),
        (None, "a row without an id that is not repeated"),
        (None, None),
        (7, "alpha beta gamma delta epsilon zeta"),
        (1, "another text of an id that repeats"),
        (8, "été 😀 中文 12.50 3/4 "),
        (9, "x"),
    ]
    extra = [(i, t, "en", None, 3, 0.5, "k", "f", 1) for i, t in rows]
    return spark.createDataFrame(
        extra,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score double,"
        " key string, line string, root int",
    )
