"""A Merkle manifest: a tree of hashes for each group of rows, a tree of their roots, and witnesses.

A leaf is the hash of a row. The leaves of a group stand in order; while several nodes remain, every
two in a row become the hash of both, and a last one alone becomes its own hash. The roots of the
groups likewise give one root. The witness of a leaf is the sibling on each level (none where the
node was alone); with it anyone can work out the root from the leaf.

Leaves are numbered by a range shuffle of ids and hashes (no texts), whose partitions are counted, so
that no group has to pass through one task. Numbers that agree but for their last bits are a block: an
aligned subtree, which is built by appending. An open subtree holds the partial witnesses of its
leaves; when its sibling is complete, the two become one, and each side's witnesses grow by the root
of the other. The roots of the blocks are appended in blocks of their own, level by level, and what
they see as witnesses is what their leaves still lack. Digests are stored as bytes and hashed as hex
text.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpipe.llm.common import broadcast_if, materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A block has two to this power of leaves.
BLOCK_BITS = 8


def leaf_of(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field as its UTF-8 length, a colon and its text, or ``-`` for null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _joined(*nodes: bytes) -> bytes:
    return sha256("".join(n.hex() for n in nodes).encode()).digest()


class Subtree:
    """A node with the partial witnesses of the leaves below it."""

    __slots__ = ("level", "root", "witnesses")

    def __init__(self, leaf: bytes) -> None:
        self.level, self.root, self.witnesses = 0, leaf, [[]]

    def paired(self, right: Subtree) -> Subtree:
        """Both as one: the witnesses of each side get the root of the other."""
        for witness in self.witnesses:
            witness.append(right.root)
        for witness in right.witnesses:
            witness.append(self.root)
        self.root = _joined(self.root, right.root)
        self.witnesses += right.witnesses
        self.level += 1
        return self

    def alone(self) -> Subtree:
        """One level up without a sibling."""
        for witness in self.witnesses:
            witness.append(None)
        self.root = _joined(self.root)
        self.level += 1
        return self


class Appended:
    """Aligned append: the open subtrees have falling levels, as the bits of their leaf count."""

    def __init__(self) -> None:
        self.open: list[Subtree] = []

    def append(self, leaf: bytes) -> None:
        tree = Subtree(leaf)
        while self.open and self.open[-1].level == tree.level:
            tree = self.open.pop().paired(tree)
        self.open.append(tree)

    def closed(self, levels: int) -> Subtree:
        """The tree of all leaves, raised to ``levels``."""
        tree = self.open.pop()
        while self.open or tree.level < levels:
            if self.open and self.open[-1].level == tree.level:
                tree = self.open.pop().paired(tree)
            else:
                tree = tree.alone()
        return tree


def folded(leaf: bytes, at: int, witness: Sequence[bytes | None]) -> bytes:
    """The root that a leaf at a place and its witness give."""
    for sibling in witness:
        if sibling is None:
            leaf = _joined(leaf)
        else:
            leaf = _joined(sibling, leaf) if at & 1 else _joined(leaf, sibling)
        at >>= 1
    return leaf


def numbered(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Written ``rows`` with ``at``, their number (from 0) within ``tree`` in the order of ``by``.

    Also ``n``, the rows of the tree. Rows are dealt by ranges of tree and order, a stored number
    last, so that equal rows need not meet in one task either.
    """
    spark = rows.sparkSession
    order = ["tree", *by, "row"]
    kept = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number of a row in its partition is in the low bits of its id there.
    dealt = kept.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(
        *rows.columns,
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    placed = materialize(dealt, "ordered")
    # A tree has a row here for each partition that holds some of it.
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    one = Window.partitionBy("tree")
    before = one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(
        parts.select(
            F.col("tree").alias("of_tree"),
            F.col("part").alias("of_part"),
            (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("held").over(one).alias("n"),
        ),
        "parts",
    )
    same = (F.col("tree") == F.col("of_tree")) & (F.col("part") == F.col("of_part"))
    return placed.join(broadcast_if(parts, 128), same).select(
        *rows.columns, (F.col("place") + F.col("shift")).alias("at"), "n"
    )


def _levels(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``."""
    return F.when(n <= 1, 0).otherwise(F.length(F.conv((n - 1).cast("string"), 10, 2))).cast("int")


def _built(key: tuple, group: pa.Table) -> pa.Table:
    ordered = group.sort_by("at")
    appended = Appended()
    for digest in ordered.column("leaf"):
        appended.append(digest.as_py())
    tree = appended.closed(ordered.column("steps")[0].as_py())
    tops = pa.array([tree.root] * len(ordered), pa.binary())
    witnesses = pa.array(tree.witnesses, pa.list_(pa.binary()))
    return ordered.drop_columns(["leaf", "steps"]).append_column("top", tops).append_column("witness", witnesses)


def witnessed(nodes: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``tree, at, root, witness`` for each of ``tree, at, levels, digest``, the leaves of each tree.

    A block of two to the power of ``bits`` leaves is one group of one task; its root is a leaf of
    the tree above. Other columns of ``nodes`` are kept.
    """
    grouped = nodes.withColumns(
        {"block": F.shiftright("at", bits), "steps": F.least(F.lit(bits), F.col("levels"))}
    )
    kept = [f"`{name}` {kind}" for name, kind in grouped.dtypes if name not in ("leaf", "steps")]
    schema = ", ".join([*kept, "top binary", "witness array<binary>"])
    built = materialize(
        grouped.withColumn("leaf", F.col("digest")).groupBy("tree", "block").applyInArrow(_built, schema), "witnesses"
    )
    columns = [c for c in nodes.columns if c != "levels"]
    done = built.filter(F.col("levels") <= bits).select(*columns, F.col("top").alias("root"), "witness")
    higher = built.filter(F.col("levels") > bits)
    tops = higher.filter(F.col("at") == F.shiftleft("block", bits)).select(
        "tree", F.col("block").alias("at"), (F.col("levels") - bits).alias("levels"), F.col("top").alias("digest")
    )
    if tops.isEmpty():
        return done
    above = materialize(witnessed(tops, bits), "above").select(
        F.col("tree").alias("of_tree"), F.col("at").alias("of_block"), "root", F.col("witness").alias("rest")
    )
    same = (F.col("tree") == F.col("of_tree")) & (F.col("block") == F.col("of_block"))
    # 64 levels of 32 bytes and what rows have besides bound a row.
    joined = higher.join(broadcast_if(above, 2500), same)
    return done.unionByName(joined.select(*columns, "root", F.concat("witness", "rest").alias("witness")))


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proof, found = [], []
        for row in batch.select(["at", "witness", "tree_at", "tree_witness", "shown"]).to_pylist():
            siblings = [s for s in row["witness"] + row["tree_witness"] if s is not None]
            proof.append(_joined(*siblings).hex())
            subroot = folded(row["shown"], row["at"], row["witness"])
            found.append(folded(subroot, row["tree_at"], row["tree_witness"]).hex())
        kept = batch.drop_columns(["at", "witness", "tree_at", "tree_witness", "shown"])
        yield kept.append_column("proof_sha256", pa.array(proof)).append_column("folded_root", pa.array(found))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    shown: Mapping[str, Column] | None = None,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row of ``docs``.

    A row is a leaf of the tree of its ``group`` (null is a group of its own, the first), in the
    order of ``order`` (null first; rows that agree in it by their leaf, so equal rows change
    places without a trace). ``proof_sha256`` is the hash of its siblings up to the root. ``shown``
    has other values of fields, as a holder of the row might show them: ``folded_root`` comes from
    these, the place and the witness, and ``verified`` says whether it is the root. Other columns
    are not read; empty texts and texts of any length are hashed whole; an empty table gives no
    rows.
    """
    shown = dict(shown or {})
    leaf = leaf_of([F.col(f) for f in fields])
    other = leaf_of([shown.get(f, F.col(f)) for f in fields])
    # The null group sorts before all others, as an empty name before one that begins with a mark.
    name = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(
        name.alias("tree"), F.col(order).alias("place_of"), leaf.alias("digest"), other.alias("shown")
    )
    leaves = materialize(
        numbered(rows, ["place_of", "digest"]).withColumn("levels", _levels(F.col("n"))), "numbered"
    )
    trees = witnessed(leaves.drop("n"), bits)
    subroots = trees.filter("at = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    upper = numbered(subroots, ["name"])
    upper = materialize(upper.withColumn("levels", _levels(F.col("n"))).drop("n"), "trees")
    whole = witnessed(upper, bits).select(
        "name",
        F.col("at").alias("tree_at"),
        F.col("digest").alias("subroot"),
        F.col("root").alias("whole"),
        F.col("witness").alias("tree_witness"),
    )
    whole = materialize(whole, "roots")
    every = trees.drop("root").join(broadcast_if(whole, 4096), F.col("tree") == F.col("name")).select(
        F.col("place_of").alias(order),
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex("whole")).alias("root"),
        "at",
        "witness",
        "tree_at",
        "tree_witness",
        "shown",
    )
    kind = dict(every.dtypes)[order]
    proved = every.mapInArrow(
        _proofs,
        f"`{order}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string",
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
