"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

A fingerprint is cut into blocks of bits. For each block the distances to a set of reference
fingerprints (the pivots) form a row of coordinates. By the triangle inequality no coordinate can
differ by more than the distance itself. Four differing bits leave two of six blocks untouched (three
of seven, and so on), so linked fingerprints share the whole coordinate rows of so many blocks at
least: these rows are what is joined. The more fingerprints there are, the more blocks have to
agree, so that the pairs which meet by chance do not grow faster than the fingerprints. A pair that met goes on if over all blocks its coordinates differ by at most four at
every pivot, and the survivors are verified bit by bit. Nothing is lost on the way, for any data.

Equal fingerprints are one node from the start. Where many fingerprints meet, they are cut into
tiles; tiles are compared two by two, and a tile pair returns a spanning forest of its links, not
the links, so that a group of copies never turns into all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from textpipe.llm.common import documents_of, free_names, give_back, materialize, text_key
from textpipe.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 24
TILE = 256
# Pairs of a fingerprint that may meet without being near, on average.
MET_BY_CHANCE = 2.0
_SHINGLES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """The 64 bits as a signed number; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    begin = np.concatenate(([0], ends[: n - 1])).tolist()
    end = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, n, _SHINGLES_AT_ONCE):
        part = slice(k, k + _SHINGLES_AT_ONCE)
        hashes = [xxh64_intdigest(norm[i:j], SEED) for i, j in zip(begin[part], end[part])]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_key`` and ``fp`` of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())],
                names=["doc_id", "text_key", "fp"],
            )
        give_back()

    rows = documents_of(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, text_key bigint, fp bigint")


def blocks(max_bits: int, untouched: int = 2) -> list[int]:
    """Masks of so many blocks that ``untouched`` ones are left by ``max_bits`` bits."""
    cuts = np.linspace(0, 64, max_bits + untouched + 1).round().astype(int)
    return [(1 << int(b)) - (1 << int(a)) for a, b in zip(cuts, cuts[1:])]


def untouched_blocks(n: int, max_bits: int) -> int:
    """How many blocks have to agree for ``MET_BY_CHANCE`` pairs at most for each of ``n`` fingerprints."""
    agree = 2
    while agree < 12:
        keys, bits = comb(max_bits + agree, agree), 64 * agree // (max_bits + agree)
        if keys * n <= MET_BY_CHANCE * 2.0**bits:
            break
        agree += 1
    return agree


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of 0, 1, 2, ..."""
    return [xxh64_intdigest(b"%d" % k, SEED) for k in range(n)]


def coordinate_keys(
    fps: np.ndarray, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, untouched: int = 2
) -> np.ndarray:
    """For each fingerprint a row with one number for each choice of ``untouched`` blocks.

    It is equal wherever the coordinates of these blocks are: the distances within a block to
    every pivot, summed up with odd multipliers.
    """
    reference = np.array(pivots(n_pivots), dtype=np.uint64)
    weights = np.array([xxh64_intdigest(b"weight %d" % k, SEED) | 1 for k in range(n_pivots)], np.uint64)
    rows = []
    for mask in map(np.uint64, blocks(max_bits, untouched)):
        distances = np.bitwise_count((fps & mask)[:, None] ^ (reference & mask)[None, :])
        rows.append((distances.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64))
    keys = []
    for k, chosen in enumerate(combinations(rows, untouched)):
        key = np.full(len(fps), xxh64_intdigest(b"choice %d" % k, SEED), dtype=np.uint64)
        for row in chosen:
            key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def _keyed(max_bits: int, n_pivots: int, untouched: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fps = np.array(batch.column("fp").to_numpy(zero_copy_only=False), dtype=np.int64)
            keys = coordinate_keys(fps.view(np.uint64), max_bits, n_pivots, untouched)
            yield pa.record_batch(
                {"fp": pa.array(np.repeat(fps, keys.shape[1])), "key": pa.array(keys.ravel())}
            )

    return batches


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the first one that the links ``i``, ``j`` connect it with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _pairs(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places within runs that end at ``ends``."""
    place = np.arange(ends[-1])
    later = np.repeat(ends, np.diff(ends, prepend=0)) - place - 1
    i = np.repeat(place, later)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)


class PivotTable:
    """Distances of fingerprints to every pivot, and what the pairs that they leave."""

    def __init__(self, max_bits: int, n_pivots: int) -> None:
        self.max_bits = max_bits
        self.pivots = np.array(pivots(n_pivots), dtype=np.uint64)

    def distances(self, fps: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fps[:, None] ^ self.pivots[None, :]).astype(np.int8)

    def linked(self, fps: np.ndarray, i: np.ndarray, j: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Which of the pairs ``i``, ``j`` are links: coordinates first, then the bits."""
        alive = np.arange(len(i))
        for k in range(0, near.shape[1], 4):
            columns = near[:, k : k + 4]
            gap = np.abs(columns[i[alive]] - columns[j[alive]]).max(axis=1)
            alive = alive[gap <= self.max_bits]
        return alive[np.bitwise_count(fps[i[alive]] ^ fps[j[alive]]) <= self.max_bits]


def _links(max_bits: int, n_pivots: int):
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PivotTable(max_bits, n_pivots)

        def forest(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
            bits = fps.view(np.uint64)
            met = table.linked(bits, i, j, table.distances(bits))
            root = _roots(len(fps), i[met], j[met])
            child = np.flatnonzero(root != np.arange(len(fps)))
            ends = [pa.array(fps[root[child]]), pa.array(fps[child])]
            return pa.RecordBatch.from_arrays(ends, names=["x", "y"])

        for batch in rows:
            fps, others = batch.column("fps"), batch.column("others")
            alone = fps.filter(others.is_null())
            if len(alone):
                sizes = np.diff(alone.offsets.to_numpy())
                work = np.cumsum(sizes.astype(np.int64) ** 2) // _PAIRS_AT_ONCE
                values = alone.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(sizes)
                for k in np.unique(work):
                    part = ends[work == k]
                    start = part[0] - sizes[work == k][0]
                    yield forest(values[start : part[-1]], *_pairs(part - start))
            for a, b in zip(fps.filter(others.is_valid()), others.drop_null()):
                left, right = (np.array(x.as_py(), dtype=np.int64) for x in (a, b))
                i = np.repeat(np.arange(len(left)), len(right))
                j = np.tile(np.arange(len(right)), len(left)) + len(left)
                yield forest(np.concatenate((left, right)), i, j)

    return batches


def links(nodes: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS) -> DataFrame:
    """Pairs ``x``, ``y`` that connect all fingerprints ``fp`` at most ``max_bits`` bits apart."""
    untouched = untouched_blocks(nodes.count(), max_bits)
    met = materialize(
        nodes.select("fp").mapInArrow(_keyed(max_bits, n_pivots, untouched), "fp bigint, key bigint"),
        "keys",
    )
    size = met.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    tiled = materialize(
        met.join(size, "key")
        .select("key", "fp", tiles.alias("tiles"))
        .groupBy("key", "tiles", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps")),
        "tiles",
    )
    within = tiled.select("fps", F.lit(None).cast("array<bigint>").alias("others"))
    many = tiled.filter("tiles > 1")
    ahead = many.select("key", "fps", "tile", "tiles").filter("tile + 1 < tiles")
    across = (
        ahead.select("key", "fps", F.explode(F.expr("sequence(tile + 1, tiles - 1)")).alias("tile"))
        .join(many.select("key", "tile", F.col("fps").alias("others")), ["key", "tile"])
        .select("fps", "others")
    )
    # A pair meets under several keys, and a forest repeats what another key has found.
    return within.union(across).mapInArrow(_links(max_bits, n_pivots), "x bigint, y bigint").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS
) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp`` and ``component_id`` of every row of ``docs``.

    Words are runs without ASCII white space, with A-Z lower-cased. A text with fewer words than a
    shingle has one shingle of all its words; one without words, or a null text, has fingerprint
    zero and is linked like any other. ``component_id`` is the smallest ``doc_id`` that can be
    reached, the row's own included; null ids count only where a component has no other.
    Repeated rows are rows of the result. An empty table gives an empty one. Other columns
    are not read.
    """
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(nodes, max_bits, n_pivots))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = materialize(
        rooted.join(named, "root").select("fp", "root", "component_id"), "components"
    )
    return fps.join(components, "fp")


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS
) -> DataFrame:
    """The rows of ``docs`` with one document of each component, the one with the smallest id.

    All columns are kept. Equal ids are told apart by their texts; of rows that agree in both,
    one stays. A null id comes after all others.
    """
    found = near_duplicates(docs, shingle, max_bits, n_pivots)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    id_name, text_name = free_names(docs, "id_key", "text_key")
    keep = first.select(
        F.xxhash64("first.last", "first.doc_id").alias(id_name), F.col("first.text_key").alias(text_name)
    )
    keyed = docs.withColumns(
        {id_name: F.xxhash64(F.col("doc_id").isNull(), "doc_id"), text_name: text_key()}
    )
    keys = [id_name, text_name]
    # The join has dealt rows by these keys, so that taking one row of each needs no new shuffle.
    return keyed.join(keep, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
