"""Scratch space for tables that only one query needs."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder of the session.

    A cluster names that folder in ``spark.checkpoint.dir``. Only a local session may go
    without: its single machine can read its own temporary folder, named with its scheme so that
    another default file system makes no difference.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        shared = Path(tempfile.gettempdir(), "textpipe-scratch").as_uri()
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this process, wherever they are.

    Results of queries may still read them, so it is the caller who knows when.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
