"""Best-fit packing by a grouping genetic algorithm on islands.

The pieces are dealt into districts of some two thousand, by a hash of a stored row number, so no
document or length can crowd one. A solution of a district says which bin holds each piece. Every
district is bred on several islands, each a row of its own with its own population:

* crossover takes whole well-filled bins of one parent into the other, drops the bins that hold one
  of their pieces again, and puts the displaced pieces back by best fit, longest first;
* mutation empties some of the worst bins and refits their pieces;
* between epochs the best solution of each island moves on to the next island of the district.

The best solution of all islands counts. The pieces of bins that are not well filled are dealt anew
to fewer districts, so the rest that each district leaves does not add up with their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpipe.llm.common import materialize
from textpipe.llm.tokens import pieces

LIMIT = 2048


@dataclass(frozen=True)
class Breeding:
    """Size of the districts and effort spent on each."""

    district: int = 2048
    islands: int = 3
    epochs: int = 2
    population: int = 16
    offspring: int = 100
    well_filled: float = 0.99
    levels: int = 3


def best_fit(sizes: np.ndarray, limit: int, order: np.ndarray, bins: np.ndarray, free: list[int]) -> None:
    """Put the pieces of ``order`` into the fullest bin that takes them, or into a new one.

    ``bins`` has the bin of each piece and ``free`` the room of each bin; both are changed.
    """
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0
    for b, room in enumerate(free):
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    for piece, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = limit, len(free)
            free.append(limit)
        bins[piece] = b
        room -= size
        free[b] = room
        if room:
            by_room[room].append(b)
            rooms |= 1 << room


class District:
    """Solutions of one district: arrays with the bin of each piece, bins numbered from 0."""

    def __init__(self, sizes: np.ndarray, limit: int, how: Breeding, seed: list[int]) -> None:
        self.sizes, self.limit, self.how = sizes, limit, how
        self.rng = np.random.default_rng(seed)
        self.least = -(-int(sizes.sum()) // limit)

    def fills(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, self.sizes).astype(np.int64)

    def fitness(self, bins: np.ndarray) -> float:
        """Few bins first; among as few, those that are full besides nearly empty ones."""
        fills = self.fills(bins) / self.limit
        return float((fills**2).sum() / len(fills) - len(fills))

    def _refit(self, bins: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Number the bins of the other pieces anew and put the loose ones back by best fit."""
        bins = bins.copy()
        fixed = np.flatnonzero(~loose)
        free: list[int] = []
        if len(fixed):
            _, bins[fixed] = np.unique(bins[fixed], return_inverse=True)
            free = (self.limit - np.bincount(bins[fixed], self.sizes[fixed]).astype(np.int64)).tolist()
        order = np.flatnonzero(loose)
        best_fit(self.sizes, self.limit, order[np.argsort(-self.sizes[order], kind="stable")], bins, free)
        return bins

    def first(self) -> list[np.ndarray]:
        """Best fit by falling size, and by sizes that are shaken a little."""
        found = []
        for k in range(self.how.population):
            shaken = self.sizes * (1 + 0.1 * k * self.rng.random(len(self.sizes)))
            bins, free = np.zeros(len(self.sizes), dtype=np.int64), []
            best_fit(self.sizes, self.limit, np.argsort(-shaken, kind="stable"), bins, free)
            found.append(bins)
            if len(free) <= self.least:
                break
        return found

    def cross(self, host: np.ndarray, donor: np.ndarray) -> np.ndarray:
        fills = self.fills(donor)
        full = fills >= self.how.well_filled * self.limit
        taken = full & (self.rng.random(len(fills)) < self.rng.uniform(0.2, 0.6))
        given = taken[donor]
        broken = np.zeros(host.max() + 1, dtype=bool)
        broken[host[given]] = True
        displaced = broken[host] & ~given
        child = np.where(given, donor + len(broken), host)
        return self._refit(child, displaced)

    def mutate(self, bins: np.ndarray) -> np.ndarray:
        fills = self.fills(bins)
        worst = np.argsort(fills, kind="stable")[: max(2, len(fills) // 50)]
        emptied = np.zeros(len(fills), dtype=bool)
        emptied[worst] = True
        emptied[self.rng.integers(len(fills), size=max(1, len(fills) // 20))] = True
        return self._refit(bins, emptied[bins])

    def evolve(self, population: list[np.ndarray]) -> list[np.ndarray]:
        """One epoch; the best solution is the first of the result."""
        held = {self.fitness(x): x for x in population}
        for _ in range(self.how.offspring):
            ranked = sorted(held, reverse=True)[: self.how.population]
            held = {f: held[f] for f in ranked}
            if held[ranked[0]].max() + 1 <= self.least:
                break
            # The better a parent, the likelier; squared uniform numbers are mostly small.
            a, b = (held[ranked[int(len(ranked) * x * x)]] for x in self.rng.random(2))
            child = a if a is b else self.cross(a, b)
            if a is b or self.rng.random() < 0.3:
                child = self.mutate(child)
            # Solutions of one fitness are taken for the same, which keeps the others alive.
            held.setdefault(self.fitness(child), child)
        return [held[f] for f in sorted(held, reverse=True)[: self.how.population]]


def _bred(limit: int, how: Breeding, epoch: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for row in frame.itertuples(index=False):
                place = District(
                    np.asarray(row.sizes, dtype=np.int64), limit, how, [row.district, row.island, epoch]
                )
                held = [np.asarray(x, dtype=np.int64) for x in row.population]
                population = place.evolve(held or place.first())
                out.append(
                    (
                        row.district,
                        row.island,
                        place.fitness(population[0]),
                        [x.astype(np.int32) for x in population],
                    )
                )
            yield pd.DataFrame(out, columns=["district", "island", "fitness", "population"])

    return rows


def _placed(limit: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                sizes, bins = np.asarray(row.sizes, dtype=np.int64), np.asarray(row.bins, dtype=np.int64)
                fills = np.bincount(bins, sizes).astype(np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                offsets = np.empty(len(sizes), dtype=np.int64)
                offsets[order] = before - (np.cumsum(fills) - fills)[bins[order]]
                yield pd.DataFrame(
                    {
                        "row": np.asarray(row.rows, dtype=np.int64),
                        "length": sizes,
                        "district": row.district,
                        "bin": bins,
                        "offset": offsets,
                        "fill": fills[bins],
                    }
                )

    return rows


_STATE = "district bigint, island int, fitness double, population array<array<int>>"
_PLACE = "row bigint, length bigint, district bigint, bin bigint, offset bigint, fill bigint"


def breed(items: DataFrame, n_districts: int, limit: int, how: Breeding) -> DataFrame:
    """``row, length, district, bin, offset, fill`` for each ``row, length``."""
    dealt = items.withColumn("district", F.pmod(F.xxhash64("row", F.lit(n_districts)), F.lit(n_districts)))
    longest_first = F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("l"), "row")))
    held = dealt.groupBy("district").agg(longest_first.alias("held"))
    districts = materialize(
        held.select(
            "district",
            F.transform("held", lambda x: -x["l"]).alias("sizes"),
            F.col("held.row").alias("rows"),
        ),
        "districts",
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(how.islands - 1))).alias("island")
    nothing = F.array().cast("array<array<int>>").alias("population")
    islands = districts.select("district", each, "sizes", nothing)
    # Breeding is work, not bytes: a stated number of tasks is not merged by adaptive execution.
    tasks = min(n_districts * how.islands, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = tasks, "district", "island"
    state = islands.repartition(*spread).mapInPandas(_bred(limit, how, 0), _STATE)
    for epoch in range(1, how.epochs):
        state = materialize(state, "population")
        elite = state.select(
            "district",
            ((F.col("island") + 1) % how.islands).alias("island"),
            F.slice("population", 1, 1).alias("elite"),
        )
        moved = state.join(elite, ["district", "island"]).join(districts, "district")
        both = F.concat("population", "elite").alias("population")
        grown = moved.select("district", "island", "sizes", both).repartition(*spread)
        state = grown.mapInPandas(_bred(limit, how, epoch), _STATE)
    state = materialize(state.select("*", F.element_at("population", 1).alias("bins")), "population")
    best = state.groupBy("district").agg(F.max_by("bins", "fitness").alias("bins"))
    return best.join(districts, "district").mapInPandas(_placed(limit), _PLACE)


def pack(
    docs: DataFrame,
    vocabulary: str,
    limit: int = LIMIT,
    how: Breeding = Breeding(),
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    The pieces are those of ``tokens.pieces``. No sequence holds more than ``limit`` ids, and its
    pieces follow each other without a gap from offset 0. Pieces of the full length are sequences
    of their own. A null text is an empty one; repeated rows are packed each; an empty table gives
    no rows; other columns are not read. With ``with_ids`` the ids come along.
    """
    cut = pieces(docs, vocabulary, limit, with_ids)
    cut = materialize(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = cut.filter(F.col("length") >= limit).select(
        "row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    left, done = cut.filter(F.col("length") < limit).select("row", "length"), []
    for level in range(how.levels):
        n = left.count()
        if not n:
            break
        n_districts = -(-n // how.district)
        placed = materialize(breed(left, n_districts, limit, how), "placed")
        last = n_districts == 1 or level == how.levels - 1
        good = F.lit(True) if last else F.col("fill") >= how.well_filled * limit
        done.append(placed.filter(good).select("row", F.lit(level).alias("level"), "district", "bin", "offset"))
        if last:
            break
        left = placed.filter(~good).select("row", "length")
    for part in done:
        number = F.shiftleft(F.col("level").cast("bigint"), 60) + F.shiftleft("district", 20) + F.col("bin")
        full = full.union(part.select("row", number.alias("sequence_id"), "offset"))
    return cut.join(full, "row").drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``doc_ids`` and ``ids`` of each sequence, from a packing with ids."""
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.col("held.doc_id").alias("doc_ids"), F.flatten("held.ids").alias("ids")
    )
