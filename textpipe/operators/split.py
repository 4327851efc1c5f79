"""Exact, seeded, stratified split into train and test.

Rows are ordered inside their class by ``md5('<seed>:<key>')`` and the first ``n_train`` of
each class go to train. Ranking all rows would put each class into one task, so only the
*cut*, the last key of a class that still goes to train, is looked up: rows are counted by
hash prefix, the one prefix that holds the cut is followed to longer prefixes until few rows
share it, and the keys under it are ranked with the number of rows of each. Given the cuts (one
row per class), the side of any row follows from the row alone, without a shuffle.

Rows of one key stay together. A run of them, however long, is one row of that last ranking, and
only a run that the cut would divide is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textpipe.sources.local import small_table

PREFIX_DIGITS = 3
HASH_DIGITS = 32
# Rows of one class under a prefix below which it is not followed further. The outcome is the same
# for any limit: it only sets how many keys a single task ranks.
RANK_LIMIT = 100_000


class RepeatedKeys(ValueError):
    """Rows with the same key would have to go to different sides."""

    def __init__(self, key: str):
        super().__init__(f"Column {key} repeats its values; the split needs one key per row")


def split_hash(key: Column | str, seed: int = 42) -> Column:
    """The seeded place of a row inside its class."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(key.cast("string"), F.raise_error(F.lit("A null key has no place in the split")))
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def allocate(counts: DataFrame, label: str = "label", test_size: float = 0.2) -> DataFrame:
    """Train and test rows per class by largest remainders.

    ``counts`` is a table of classes, so its windows over all rows see one row per class.
    The test side has ``ceil(test_size * n)`` rows. Equal remainders go to smaller labels.
    """
    everything = Window.partitionBy()
    n_total = F.sum("n_rows").over(everything)
    # The product of two row counts outgrows bigint from a few billion rows on.
    product = F.col("n_rows").cast("decimal(19,0)") * F.col("n_train_total").cast("decimal(19,0)")
    shares = (
        counts.select(
            label,
            "n_rows",
            n_total.alias("n_total"),
            (n_total - F.ceil(F.lit(float(test_size)) * n_total)).alias("n_train_total"),
        )
        .withColumn("product", product)
        .select(
            label,
            "n_rows",
            "n_train_total",
            F.expr("product div n_total").alias("whole"),
            F.expr("product % n_total").alias("remainder"),
        )
    )
    missing = F.col("n_train_total") - F.sum("whole").over(everything)
    by_remainder = F.row_number().over(Window.orderBy(F.desc("remainder"), label))
    n_train = F.col("whole") + F.when(by_remainder <= missing, 1).otherwise(0)
    return shares.select(label, "n_rows", n_train.cast("bigint").alias("n_train")).select(
        "*", (F.col("n_rows") - F.col("n_train")).alias("n_test")
    )


@dataclass(frozen=True)
class ClassCut:
    """How far a class's train rows reach: up to and including ``(cut_hash, cut_key)``."""

    label: object
    n_rows: int
    n_train: int
    cut_hash: str | None = None
    cut_key: object | None = None


@dataclass(frozen=True)
class _Boundary:
    """The hash prefix that holds the cut: rows in it, and its rank among them."""

    prefix: str
    rank: int
    n_rows: int


def find_cuts(
    df: DataFrame,
    key: str = "doc_id",
    label: str = "label",
    test_size: float = 0.2,
    seed: int = 42,
    rank_limit: int = RANK_LIMIT,
) -> list[ClassCut]:
    """Look up the cut of every class. Reads the key and the label, never the text."""
    hashed = df.select(
        F.col(label).alias("label"), F.col(key).alias("key"), split_hash(key, seed).alias("hash")
    )
    sizes = _count_prefixes(hashed, PREFIX_DIGITS)
    classes = allocate(sizes.groupBy("label").agg(F.sum("n_rows").alias("n_rows")), "label", test_size)
    running = F.sum("n_rows").over(
        Window.partitionBy("label").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    )
    reach = sizes.select(
        F.col("label").alias("reach_label"),
        "prefix",
        F.col("n_rows").alias("n_prefix"),
        (running - F.col("n_rows")).alias("before"),
    )
    holds_cut = (F.col("n_train") > F.col("before")) & (
        F.col("n_train") <= F.col("before") + F.col("n_prefix")
    )
    rows = (
        classes.join(
            reach, F.col("label").eqNullSafe(F.col("reach_label")) & holds_cut, "left"
        )
        .withColumn("rank", F.col("n_train") - F.col("before"))
        .collect()
    )
    _check_classes(rows)

    open_cuts = {row.label: _Boundary(row.prefix, row.rank, row.n_prefix) for row in rows if row.prefix}
    digits = PREFIX_DIGITS
    while digits < HASH_DIGITS and any(b.n_rows > rank_limit for b in open_cuts.values()):
        digits = min(digits + PREFIX_DIGITS, HASH_DIGITS)
        open_cuts = _follow(hashed, open_cuts, digits)
    last = _last_train_rows(hashed, open_cuts)
    if last.keys() != open_cuts.keys():
        raise RepeatedKeys(key)
    return [
        ClassCut(row.label, row.n_rows, row.n_train, *last.get(row.label, (None, None)))
        for row in rows
    ]


def _count_prefixes(hashed: DataFrame, digits: int) -> DataFrame:
    prefix = F.substring("hash", 1, digits).alias("prefix")
    return hashed.groupBy("label", prefix).agg(F.count(F.lit(1)).alias("n_rows"))


def _check_classes(rows: list) -> None:
    if any(row.label is None for row in rows):
        raise ValueError("Null labels cannot be stratified")
    small = sorted(row.label for row in rows if row.n_rows < 2)
    if small:
        raise ValueError(f"Classes with fewer than 2 rows cannot be stratified: {small}")
    n_train = sum(row.n_train for row in rows)
    n_test = sum(row.n_rows for row in rows) - n_train
    for side, size in (("train", n_train), ("test", n_test)):
        if size < len(rows):
            raise ValueError(f"The {side} side has {size} rows for {len(rows)} classes")


def _inside(hashed: DataFrame, cuts: dict[object, _Boundary]) -> DataFrame:
    """Only the rows whose hash starts with the open prefix of their class."""
    schema = T.StructType(
        [
            hashed.schema["label"],
            T.StructField("open_prefix", T.StringType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    rows = [(label, cut.prefix, cut.rank) for label, cut in cuts.items()]
    prefixes = small_table(hashed.sparkSession, rows, schema)
    return hashed.join(prefixes, "label").filter(
        F.startswith(F.col("hash"), F.col("open_prefix"))
    )


def _follow(
    hashed: DataFrame, cuts: dict[object, _Boundary], digits: int
) -> dict[object, _Boundary]:
    """Replace each open prefix by the longer one that holds the cut."""
    sizes = (
        _inside(hashed, cuts)
        .groupBy("label", "rank", F.substring("hash", 1, digits).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    running = F.sum("n_rows").over(
        Window.partitionBy("label").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = (
        sizes.withColumn("upto", running)
        .filter(F.col("rank").between(F.col("upto") - F.col("n_rows") + 1, F.col("upto")))
        .collect()
    )
    return {r.label: _Boundary(r.prefix, r.rank - (r.upto - r.n_rows), r.n_rows) for r in rows}


def _last_train_rows(
    hashed: DataFrame, cuts: dict[object, _Boundary]
) -> dict[object, tuple[str, object]]:
    """Rank the keys under the open prefixes and pick the one that ends each class's train side.

    Rows of one key are counted before they are ranked. A key whose rows lie on both sides of the
    cut ends at no rank that is asked for, so its class is missing from the result.
    """
    keys = (
        _inside(hashed, cuts)
        .groupBy("label", "rank", "hash", "key")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    upto = F.sum("n_rows").over(
        Window.partitionBy("label")
        .orderBy("hash", "key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = keys.withColumn("upto", upto).filter("upto = rank").collect()
    return {row.label: (row.hash, row.key) for row in rows}


def assign_split(
    df: DataFrame,
    cuts: list[ClassCut],
    key: str = "doc_id",
    label: str = "label",
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` (``train`` or ``test``) to every row by comparing it with its class cut."""
    schema = T.StructType(
        [
            T.StructField("cut_label", df.schema[label].dataType),
            T.StructField("cut_hash", T.StringType()),
            T.StructField("cut_key", df.schema[key].dataType),
        ]
    )
    rows = [(c.label, c.cut_hash, c.cut_key) for c in cuts if c.cut_hash is not None]
    table = small_table(df.sparkSession, rows, schema)
    place, cut = F.struct(split_hash(key, seed), F.col(key)), F.struct("cut_hash", "cut_key")
    # A class without a cut has no train rows.
    side = F.when(F.col("cut_hash").isNotNull() & (place <= cut), "train").otherwise("test")
    return (
        df.join(table, df[label] == table["cut_label"], "left")
        .withColumn("split", side)
        .drop(*schema.names)
    )


def stratified_split(
    df: DataFrame,
    key: str = "doc_id",
    label: str = "label",
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Look up the cuts and add ``split`` to every row."""
    return assign_split(df, find_cuts(df, key, label, test_size, seed), key, label, seed)
