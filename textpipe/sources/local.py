"""Small driver-side tables and their broadcast."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# What may be sent to every executor without asking Catalyst.
BROADCAST_BYTES = 16 << 20


def broadcast_if_small(table: DataFrame, n_bytes: int) -> DataFrame:
    """Hint a broadcast of a table of known size.

    A larger table gets no hint: Catalyst then joins by its size, and adaptive execution splits
    skewed partitions.
    """
    return F.broadcast(table) if n_bytes <= BROADCAST_BYTES else table


def measured_bytes(table: DataFrame) -> int:
    """The size of a table of short rows: lengths of its strings, eight bytes for other cells."""
    size = F.lit(0).cast("bigint")
    for name, kind in table.dtypes:
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    return table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n


def arrow_table(rows: Sequence[tuple], schema: StructType) -> pa.Table:
    """A few rows as an Arrow table, whose ``nbytes`` says how large they are."""
    columns = list(zip(*rows)) or [() for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]
    return pa.Table.from_arrays(arrays, schema=arrow_schema)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A few rows as a local relation.

    Handing over an Arrow table puts the rows into the plan itself. A list of rows would become
    an RDD with a partition per core of the cluster, and a job to broadcast it.
    """
    return spark.createDataFrame(arrow_table(rows, schema), schema)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A few rows as a local relation, with a broadcast hint if their bytes allow it."""
    held = arrow_table(rows, schema)
    return broadcast_if_small(spark.createDataFrame(held, schema), held.nbytes)
