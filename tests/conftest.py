from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textpipe.sources.scratch import delete_scratch  # noqa: E402


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("textpipe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", Path(tempfile.mkdtemp(prefix="textpipe-tests-")).as_uri())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = build_session()
    yield session
    delete_scratch(session)
