"""Substring deduplication by sliding spans of sentences.

A text is cut into sentences; a long one is cut again before the word of the least hash of every
few words in a row. So no piece is long, and a passage is cut alike wherever it stands: from the
least of its first few words to the least of its last. Every run of ``span`` sentences has a 128-bit hash of its
lower-case words; where they have few words, a run has more. A run that occurs in several documents is kept in the one with the smallest id;
within a document its first place counts. Sentences that any other occurrence covers are removed.

Map tasks give each different run of a document once. Runs are summed up by hash before they are
dealt (smallest and largest id), so a passage that a third of all documents share is one row for
each task; the repeated ones are written, and joining them back splits the partitions of hot ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from textpipe.llm.common import (
    chunks,
    documents_of,
    finished,
    free_names,
    materialize,
    spaces,
    symbol_numbers,
    text_key,
)

_ENDS = [ord(c) for c in ".!?"]
_CHARACTERS_AT_ONCE = 1 << 20
_APART = 4


@dataclass(frozen=True)
class Spans:
    """Runs of ``span`` sentences, and of as many more as it takes for ``least`` words; a sentence of
    more than ``longest`` words is cut before the word of the least hash of every ``within`` words in
    a row."""

    span: int = 3
    least: int = 10
    longest: int = 12
    within: int = 10


@dataclass
class Sentences:
    """The sentences of some texts: number of the text, place there, words, and two hashes."""

    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    words: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]


def _powers(seed: int, n: int) -> np.ndarray:
    factor = np.random.default_rng(seed).integers(1 << 64, dtype=np.uint64) | np.uint64(1)
    out = np.full(max(n, 1), factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _places(starts: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` items its number within the run that begins at one of ``starts``."""
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))


def _summed(values: np.ndarray, starts: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each run of values that depends on their order."""
    powers = _powers(seed, int(place.max(initial=0)) + 1)
    return finished(np.add.reduceat(values * powers[place], starts))


def _picked(hashes: np.ndarray, left: np.ndarray, within: int) -> np.ndarray:
    """Words that have the least hash of any ``within`` words of their sentence in a row.

    ``left`` counts the words from each one to the end of its sentence. The last of equal ones is
    picked. A word is hashed with the next, so that few different words still differ.
    """
    after = np.append(hashes[1:], np.uint64(0))
    after[left == 1] = 0
    pairs = finished(hashes + after * np.uint64(0x9E3779B97F4A7C15))
    start = np.flatnonzero(left >= within)
    least, where = pairs[start], start.copy()
    for k in range(1, within):
        other = pairs[start + k]
        lower = other <= least
        least = np.where(lower, other, least)
        where = np.where(lower, start + k, where)
    where = np.unique(where)
    # Words that repeat with a period of a few would be cut into pieces too short for a run of them:
    # of equal ones close together, only those at least ``_APART`` words on are picked.
    gap = np.diff(where, prepend=-_APART)
    again = (gap < _APART) & (np.diff(pairs[where], prepend=np.uint64(0)) == 0)
    number = _places(np.flatnonzero(~again), len(where))
    return where[number % -(-_APART // gap) == 0]


def sentences(texts: list[str], how: Spans = Spans()) -> Sentences:
    """Cut texts after ``.``, ``!`` or ``?`` before white space, and at line breaks.

    The sentences of a text with a word are the whole text together; others have none.
    """
    raw = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    text_begins = np.concatenate(([0], text_ends[:-1] + 1))
    inside = ~spaces()[raw]
    inside[text_ends] = False
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return Sentences(none, none, none, none, (none.astype(np.uint64),) * 2)
    new = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    starts, last = at[new], at[np.append(new[1:], len(at)) - 1]
    owner = np.searchsorted(text_begins, starts, side="right") - 1
    place = _places(new, len(at))
    halves = [_summed(symbol_numbers(k)[raw[at]], new, place, k) for k in (1, 2)]
    # Whether the sentence ends with a word, by its last character or a line break that follows.
    breaks = np.concatenate(([0], np.cumsum(raw == 10)))
    following = np.append(starts[1:], len(raw))
    final = np.append(owner[1:] != owner[:-1], True)
    closes = final | np.isin(raw[last], _ENDS) | (breaks[following] > breaks[last])
    opens = np.append(True, closes[:-1])
    whole = np.flatnonzero(opens)
    size = np.diff(np.append(whole, len(starts)))
    left = np.repeat(whole + size, size) - np.arange(len(starts))
    left[np.repeat(size <= how.longest, size)] = 0
    opens[_picked(halves[0], left, how.within)] = True
    first = np.flatnonzero(opens)
    number = _places(first, len(starts))
    hashes = [_summed(h, first, number, k + 3) for k, h in enumerate(halves)]
    mine = owner[first]
    begin = np.where(np.append(True, mine[1:] != mine[:-1]), text_begins[mine], starts[first])
    end = np.append(begin[1:], 0)
    ends_text = np.append(mine[1:] != mine[:-1], True)
    end[ends_text] = text_ends[mine[ends_text]]
    words = np.diff(np.append(first, len(starts)))
    return Sentences(mine, begin - text_begins[mine], end - text_begins[mine], words, tuple(hashes))


def _extents(s: Sentences, n_texts: int, how: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sentence its place in its text, the sentences of the run that it begins, and whether
    there is one."""
    every = np.arange(len(s.owner))
    bounds = np.searchsorted(s.owner, np.arange(n_texts + 1))
    place, last = every - bounds[s.owner], bounds[s.owner + 1]
    words = np.concatenate(([0], np.cumsum(s.words)))
    end = np.maximum(every + how.span, np.searchsorted(words, words[:-1] + how.least))
    # A text with fewer sentences than a run is one run.
    there = (end <= last) | (place == 0)
    end = np.minimum(end, last)
    return place, end - every, there & (words[end] - words[:-1] >= how.least)


def runs(texts: list[str], how: Spans = Spans()) -> tuple[np.ndarray, ...]:
    """Text, number of the first sentence, two hashes, and whether the text had the run before.

    A text with fewer sentences than a run has one run of all of them.
    """
    s = sentences(texts, how)
    place, size, there = _extents(s, len(texts), how)
    hashes = [np.zeros(len(place), dtype=np.uint64) for _ in s.hashes]
    most = max(how.span, how.least)
    for k in range(int(size.max(initial=0))):
        more = np.flatnonzero(size > k)
        for half, (total, one) in enumerate(zip(hashes, s.hashes)):
            total[more] += one[more + k] * _powers(half + 5, most)[k]
    use = np.flatnonzero(there)
    owner, at, (a, b) = s.owner[use], place[use], (finished(h[use]).view(np.int64) for h in hashes)
    order = np.lexsort((at, b, a, owner))
    same = np.ones(len(order), dtype=bool)
    same[:1] = False
    for column in (owner, a, b):
        same[1:] &= column[order][1:] == column[order][:-1]
    again = np.empty(len(order), dtype=bool)
    again[order] = same
    return owner, at, a, b, again


def _runs(docs: DataFrame, how: Spans) -> DataFrame:
    """``doc_id, text_key, at, a, b, again`` of the runs of all documents."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for first, part in chunks(batch.column("text"), _CHARACTERS_AT_ONCE):
                owner, at, a, b, again = runs(part, how)
                index = pa.array(owner + first)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(index),
                        "text_key": batch.column("text_key").take(index),
                        "at": pa.array(at, pa.int32()),
                        "a": pa.array(a),
                        "b": pa.array(b),
                        "again": pa.array(again),
                    }
                )

    rows = documents_of(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        batches, f"doc_id {kind}, text_key bigint, at int, a bigint, b bigint, again boolean"
    )


def covered(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """``doc_id, text_key, at`` of the runs that are not the first of their kind."""
    # Without an id last. Numbers are summed up faster than structs are.
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        last = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("id")
    else:
        last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id").alias("id")
    runs = _runs(docs, how).select("doc_id", "text_key", last, "at", "a", "b", "again")
    held = runs.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = materialize(held.filter("first < last").select("a", "b", "first"), "shared")
    copies = runs.filter("not again").join(shared, ["a", "b"]).filter("id > first")
    columns = ["doc_id", "text_key", "at"]
    return runs.filter("again").select(columns).union(copies.select(columns))


def _cut(texts: list[str | None], places: list, how: Spans) -> Iterator[tuple]:
    """Texts without the sentences of the runs that begin at the places, and what was removed."""
    whole = [t or "" for t in texts]
    for first, part in chunks(whole, _CHARACTERS_AT_ONCE):
        s = sentences(part, how)
        size = _extents(s, len(part), how)[1]
        bounds = np.searchsorted(s.owner, np.arange(len(part) + 1)).tolist()
        for k, (a, b) in enumerate(zip(bounds, bounds[1:]), first):
            at = places[k]
            if at is None or not len(at):
                yield texts[k], b - a, 0, []
                continue
            gone = np.zeros(b - a, dtype=bool)
            for i in at:
                gone[i : i + size[a + i]] = True
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
            stretches = [[int(s.begin[a + x]), int(s.end[a + y - 1])] for x, y in edges]
            kept, done = [], 0
            for begin, end in stretches:
                kept.append(whole[k][done:begin])
                done = end
            yield "".join([*kept, whole[k][done:]]), b - a, int(gone.sum()), stretches


def deduplicate(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """``docs`` with the new ``text`` and three more columns (named with ``_`` where taken).

    ``n_sentences``, ``n_removed`` and ``removed``, the stretches that were cut out as pairs of
    character places in the old text. Rows of one id count as one document, so that none of them is
    a copy of another, and rows without an id come last and together. A null text stays null and
    has no sentences. An empty table gives no rows.
    """
    names = free_names(docs, "n_sentences", "n_removed", "removed", "id_key", "text_key", "at", "cut")
    n_name, removed_name, stretches_name, id_name, text_name, at_name, cut_name = names
    by_row = (
        covered(docs, how)
        .groupBy(F.xxhash64(F.col("doc_id").isNull(), "doc_id").alias(id_name), F.col("text_key").alias(text_name))
        .agg(F.collect_set("at").alias(at_name))
    )
    keyed = docs.withColumns(
        {id_name: F.xxhash64(F.col("doc_id").isNull(), "doc_id"), text_name: text_key()}
    )
    joined = keyed.join(by_row, [id_name, text_name], "left")

    @F.pandas_udf("text string, n int, gone int, stretches array<array<int>>")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        rows = _cut(texts.tolist(), places.tolist(), how)
        return pd.DataFrame(rows, columns=["text", "n", "gone", "stretches"])

    made = F.col(cut_name)
    return joined.withColumn(cut_name, cut("text", at_name)).select(
        *[made["text"].alias("text") if c == "text" else F.col(c) for c in docs.columns],
        made["n"].alias(n_name),
        made["gone"].alias(removed_name),
        made["stretches"].alias(stretches_name),
    )
