"""Scans and sinks of the labelled corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpipe.functions.text import null_if_na

# Doubled quotes inside quoted cells, and cells kept as they are.
CSV_QUOTING = {"header": True, "quote": '"', "escape": '"'}
CSV_AS_WRITTEN = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# Types of columns that CSV cells are cast to; other columns are strings. Ids may be texts.
COLUMN_TYPES: Mapping[str, str] = MappingProxyType({"label": "int"})


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options
) -> DataFrame:
    """``spark.read`` with the error a missing file deserves."""
    reader = spark.read.format(fmt).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"File not found: {path}") from error
        raise


def strict_cast(cell: Column, data_type: str) -> Column:
    """Cast that fails on a bad value, whatever ``spark.sql.ansi.enabled`` says."""
    if data_type == "string":
        return cell
    value = cell.try_cast(data_type)
    message = F.concat(F.lit(f"Not a valid {data_type}: "), cell.cast("string"))
    return F.when(cell.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


def scan_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    types: Mapping[str, str] = COLUMN_TYPES,
) -> DataFrame:
    """Scan CSV by header name; the empty string and the NA tokens become null.

    All cells are read as strings first and then cast to ``types``, so a bad number fails the
    query and never turns into a null. Every file must have the header of the first.

    Cells may hold line breaks, and so a file is read whole, by one task. ``multi_line=False``
    says that no cell does: files are then divided between tasks. Nothing else decides on it, so
    the same files are read alike by every cluster.
    """
    cells = read_table(
        spark, path, "csv", **CSV_QUOTING, **CSV_AS_WRITTEN,
        multiLine=multi_line, mode="FAILFAST", enforceSchema=False,
    )
    return cells.select(
        *(
            strict_cast(null_if_na(F.col(f"`{name}`")), types.get(name, "string")).alias(name)
            for name in cells.columns
        )
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV that ``scan_csv`` reads back unchanged."""
    df.write.mode("overwrite").options(**CSV_QUOTING, **CSV_AS_WRITTEN, quoteAll=True).csv(path)


def scan_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Scan JSON lines with all their columns.

    Without a ``schema`` the files are read once more to find keys and types. Whole numbers are
    ``bigint`` then.
    """
    return read_table(spark, path, "json", schema, mode="FAILFAST")


def scan_corpus(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Scan a corpus kept as CSV, JSON or any typed format.

    ``schema`` is that of JSON, ``multi_line`` is about cells of CSV. Labels are cast to ``int``
    where the files do not say it.
    """
    if fmt == "csv":
        return scan_csv(spark, path, multi_line)
    if fmt == "json":
        found = scan_json(spark, path, schema)
        if schema or "label" not in found.columns:
            return found
        return found.withColumn("label", strict_cast(F.col("label"), COLUMN_TYPES["label"]))
    return read_table(spark, path, fmt)


def land_corpus(corpus: DataFrame, path: str, fmt: str = "parquet", key: str = "doc_id") -> None:
    """Write the raw table, replacing an older one.

    A corpus without the ``key`` gets one here. The key is made once and stored, so all
    later stages see the same keys, also when tasks are repeated.
    """
    if key not in corpus.columns:
        corpus = corpus.withColumn(key, F.monotonically_increasing_id())
    if fmt == "csv":
        write_csv(corpus, path)
    else:
        corpus.write.mode("overwrite").format(fmt).save(path)


def write_split(assigned: DataFrame, path: str) -> None:
    """Write train and test as the two partitions of one table."""
    assigned.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Scan one side of the split; the other side's files are not opened."""
    return read_table(spark, path).filter(F.col("split") == split).drop("split")
