"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, and exact edit verification.

The CGK embedding reads a text in a random walk: at step j it writes the character under the
cursor, and a random bit of (j, character) says whether the cursor moves on. Two texts at a small
edit distance meet again after each edit, so their embeddings are at a small Hamming distance. A
hash of the characters written at a few sampled steps is an LSH for that distance.

A walk reads a window from its start, so windows of all item sizes that begin at one place share
it: the embedding of a shorter one begins like that of a longer one. Steps are sampled from the
part that they share. Every word of an item begins a window of the index, and every word of a
document one of the search. So an item that a document contains is met at several places, and an
edit can only spoil the windows that begin shortly before it. Each walk and sample is one
repetition; ``repetitions`` and ``samples`` set the recall. A window of the search is given up as
soon as no window of the index begins with what it has written.

Windows that many items have, such as the beginning that the questions of a benchmark share, say little:
an item is looked up by its rarer windows, if it has enough of them, so that a document with such a
beginning does not meet all of these items. Of many items that a document meets all the same, those
go on of whose short substrings the document has as many as the allowed edits leave.

Items with few windows would often lose all of them to edits. They are cut into one segment more
than the edits they are allowed, so that one at least is in the document as it is: none is lost.

A hit places the item at a stretch of the document, and the least edit distance between the item
and any substring there is computed exactly.

Documents are read once for each block of the benchmark; a block, its index and its texts are
bounded by ``BLOCK_CHARACTERS`` and sent to every task. Only hits leave the map tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textpipe.llm.common import chunks, code_points, documents_of, give_back

BLOCK_CHARACTERS = 2_000_000
_CHARACTERS_AT_ONCE = 1 << 20
_WINDOWS_AT_ONCE = 1 << 16
_FILTER_BITS = 22
# From so many items on a window is common; an item needs so many rarer ones to do without it.
_COMMON, _ENOUGH = 16, 24
# From so many items on they are sifted all at once.
_MANY = 16
# After how many samples a window of the search may be given up, and bits of these filters.
_SIEVES = (4, 6, 8)
_SIEVE_BITS = 18
_GRAM = 5
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Search:
    """``rate``: edits allowed for each character of an item; the others set recall and work.

    Items of fewer than ``short`` characters or ``windows`` windows are met by exact segments.
    """

    rate: float = 0.1
    repetitions: int = 4
    samples: int = 12
    steps: int = 40
    short: int = 100
    windows: int = 8
    seed: int = 42


def myers(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of the text, and where that ends.

    Bit-parallel: one step for each character of the text, on words as long as the pattern.
    """
    m = len(pattern)
    at: dict[int, int] = {}
    for k, c in enumerate(pattern.tolist()):
        at[c] = at.get(c, 0) | 1 << k
    every, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = every, 0, m
    best, where = m, 0
    for k, c in enumerate(text.tolist()):
        eq = at.get(c, 0)
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & every
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & every, (mh << 1) & every
        xv = eq | mv
        pv = (mh | ~(xv | ph)) & every
        mv = ph & xv
        if score < best:
            best, where = score, k + 1
    return best, where


def word_starts(codes: np.ndarray) -> np.ndarray:
    """Where words begin."""
    inside = (codes != 0) & (codes != 32)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    return np.flatnonzero(starts)


def _grams(codes: np.ndarray) -> np.ndarray:
    """A number of 16 bits for every ``_GRAM`` characters in a row; equal ones have the same."""
    symbols = _symbols(codes).astype(np.uint32)
    n = max(len(symbols) - _GRAM + 1, 0)
    out = np.zeros(n, dtype=np.uint32)
    for k in range(_GRAM):
        out = (out ^ symbols[k : k + n]) * np.uint32(0x85EBCA6B)
        out ^= out >> np.uint32(15)
    return out >> np.uint32(16)


# Repetition, number of samples, hashes: whether each window goes on.
Sieve = Callable[[int, int, np.ndarray], np.ndarray]


class Walks:
    """The random walks and the steps sampled from them."""

    def __init__(self, how: Search) -> None:
        self.how = how
        rng = np.random.default_rng(how.seed)
        self.moves = rng.integers(0, 2, (how.repetitions, how.steps, 256), dtype=np.int64)
        self.sampled = [
            np.sort(rng.choice(how.steps, how.samples, replace=False)) for _ in range(how.repetitions)
        ]

    def keys(
        self, symbols: np.ndarray, starts: np.ndarray, repetition: int, sieve: Sieve
    ) -> tuple[np.ndarray, np.ndarray]:
        """One hash for the window at each start, and the numbers of the starts that are left.

        ``sieve`` is given the hashes after some of the samples, and says which windows go on.
        """
        sampled = set(self.sampled[repetition].tolist())
        last = max(sampled)
        out, kept = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
        for k in range(0, len(starts), _WINDOWS_AT_ONCE):
            cursor = starts[k : k + _WINDOWS_AT_ONCE].astype(np.int64)
            number = np.arange(k, k + len(cursor))
            key = np.full(len(cursor), repetition + 1, dtype=np.uint64)
            taken = 0
            for step in range(last + 1):
                written = symbols[cursor]
                if step in sampled:
                    key = (key ^ written) * _GOLD
                    key ^= key >> np.uint64(29)
                    taken += 1
                    if taken in _SIEVES:
                        left = np.flatnonzero(sieve(repetition, taken, key))
                        if len(left) < len(key):
                            cursor, number, key, written = cursor[left], number[left], key[left], written[left]
                cursor += self.moves[repetition, step][written]
            out.append(key)
            kept.append(number)
        return np.concatenate(out), np.concatenate(kept)


def _symbols(codes: np.ndarray) -> np.ndarray:
    """Characters folded to a byte; plain ASCII letters stay apart."""
    return ((codes * np.uint32(0x85EBCA6B)) >> np.uint32(24)).astype(np.uint8) ^ (codes & np.uint32(0x7F)).astype(np.uint8)


class Index:
    """The windows of a block of items, sorted by key."""

    def __init__(self, items: list[tuple[int, str]], how: Search) -> None:
        self.how, self.walks = how, Walks(how)
        codes, begin, lengths = code_points([t for _, t in items], how.steps)
        self.ids = [i for i, _ in items]
        self.texts = [codes[b : b + n] for b, n in zip(begin, lengths)]
        self.limits = [int(how.rate * n) for n in lengths]
        self.grams = [_grams(t) for t in self.texts]
        # An edit spoils so many of them at most.
        self.needed = [len(g) - _GRAM * n for g, n in zip(self.grams, self.limits)]
        symbols = _symbols(codes)
        at = word_starts(codes)
        owner = np.searchsorted(begin, at, side="right") - 1
        # A window must not run out of its item.
        inside = at + how.steps <= (begin + lengths)[owner]
        at, owner = at[inside], owner[inside]
        windows = np.bincount(owner, minlength=len(items))
        few = (lengths < how.short) | (windows < how.windows)
        self.tiny = self._words([k for k, n in enumerate(lengths) if n and few[k] and not self.limits[k]])
        self.segments = self._segments([k for k in np.flatnonzero(few).tolist() if self.limits[k]])
        at, owner = at[~few[owner]], owner[~few[owner]]
        self.begun: dict[tuple[int, int], np.ndarray] = {}
        keys = np.concatenate([self.walks.keys(symbols, at, r, self._begin)[0] for r in range(how.repetitions)])
        entry = np.tile(np.arange(len(at)), how.repetitions)
        told = self._told(keys, owner[entry], len(items))
        keys, entry = keys[told], entry[told]
        order = np.argsort(keys, kind="stable")
        self.keys, entry = keys[order], entry[order]
        self.item, self.offset = owner[entry], (at - begin[owner])[entry]
        self.all_grams = np.concatenate([*self.grams, np.zeros(0, dtype=np.uint32)])
        sizes = np.array([len(g) for g in self.grams], dtype=np.int64)
        self.gram_sizes, self.gram_begin = sizes, np.cumsum(sizes) - sizes
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def _told(self, keys: np.ndarray, item: np.ndarray, n_items: int) -> np.ndarray:
        """The windows by which items are looked up: rare ones, or all of an item with few of these."""
        order = np.lexsort((item, keys))
        k, i = keys[order], item[order]
        new_key = np.concatenate((np.ones(min(len(k), 1), dtype=bool), k[1:] != k[:-1]))
        new_item = new_key.copy()
        new_item[1:] |= i[1:] != i[:-1]
        group = np.cumsum(new_key) - 1
        shared = np.bincount(group, new_item, minlength=1)[group]
        rare = np.empty(len(keys), dtype=bool)
        rare[order] = shared < _COMMON
        enough = np.bincount(item[rare], minlength=n_items) >= _ENOUGH * self.how.repetitions
        return rare | ~enough[item]

    def _likely(self, codes: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Those of the items that the text has enough short substrings of."""
        there = np.zeros(1 << 16, dtype=bool)
        there[_grams(codes)] = True
        sizes = self.gram_sizes[items]
        ends = np.cumsum(sizes)
        at = np.repeat(self.gram_begin[items] - (ends - sizes), sizes) + np.arange(ends[-1])
        found = np.concatenate(([0], np.cumsum(there[self.all_grams[at]])))
        needed = np.array([self.needed[k] for k in items])
        return items[found[ends] - found[ends - sizes] >= needed]

    def _begin(self, repetition: int, taken: int, keys: np.ndarray) -> np.ndarray:
        """Note how windows of the index begin; all of them go on."""
        begun = self.begun.setdefault((repetition, taken), np.zeros(1 << _SIEVE_BITS, dtype=bool))
        begun[keys >> np.uint64(64 - _SIEVE_BITS)] = True
        return np.ones(len(keys), dtype=bool)

    def _begins(self, repetition: int, taken: int, keys: np.ndarray) -> np.ndarray:
        """Whether a window of the index may begin like this."""
        return self.begun[repetition, taken][keys >> np.uint64(64 - _SIEVE_BITS)]

    def _words(self, items: list[int]) -> ahocorasick.Automaton | None:
        """Items that are allowed no edit are searched as whole words."""
        if not items:
            return None
        found = ahocorasick.Automaton()
        for k in items:
            word = _text(self.texts[k])
            found.add_word(f" {word} ", [*found.get(f" {word} ", []), k])
        found.make_automaton()
        return found

    def _segments(self, items: list[int]) -> ahocorasick.Automaton | None:
        """Segments of items, one more than their edits: (item, place in it, length)."""
        if not items:
            return None
        found = ahocorasick.Automaton()
        for k in items:
            text, n = _text(self.texts[k]), self.limits[k] + 1
            cuts = [len(text) * i // n for i in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                found.add_word(text[a:b], [*found.get(text[a:b], []), (k, a, b - a)])
        found.make_automaton()
        return found

    def met(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, where it would begin in the text) of the segments that the text holds."""
        for end, held in self.segments.iter(text) if self.segments else ():
            for item, offset, size in held:
                yield item, end + 1 - size - offset

    def hits(self, symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, where the item would begin), each item and place once."""
        seen: dict[tuple[int, int], int] = {}
        for r in range(self.how.repetitions if len(self.keys) else 0):
            keys, number = self.walks.keys(symbols, starts, r, self._begins)
            maybe = np.flatnonzero(self.filter[keys >> np.uint64(64 - _FILTER_BITS)])
            keys, maybe = keys[maybe], number[maybe]
            left = np.searchsorted(self.keys, keys, side="left")
            n = np.searchsorted(self.keys, keys, side="right") - left
            entry = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = np.repeat(starts[maybe], n)
            where = window - self.offset[entry]
            seen.update(zip(zip(self.item[entry].tolist(), where.tolist()), window.tolist()))
        for (item, where), window in seen.items():
            yield window, item, where

    def verified(
        self, codes: np.ndarray, first: int, last: int, guesses: dict[int, list[int]]
    ) -> Iterator[tuple[int, int, int]]:
        """(item, distance, place of its end) of the items that the text really contains."""
        if len(guesses) >= _MANY:
            likely = self._likely(codes[first:last], np.array(sorted(guesses)))
            guesses = {k: guesses[k] for k in likely.tolist()}
        for item, places in guesses.items():
            text, limit = self.texts[item], self.limits[item]
            places = sorted(places)
            same = (p for p in places if p >= first and np.array_equal(codes[p : p + len(text)], text))
            exact = next(same, None)
            if exact is not None:
                yield item, 0, exact + len(text) - first
                continue
            best, done = (limit + 1, 0), -1
            for place in places:
                low, high = max(first, place - limit), min(last, place + len(text) + 2 * limit)
                if high > done:  # else the stretch before has covered this one
                    done = min(last, high + limit)
                    there = np.zeros(1 << 16, dtype=bool)
                    there[_grams(codes[low:done])] = True
                    if np.count_nonzero(there[self.grams[item]]) < self.needed[item]:
                        continue
                    distance, end = myers(text, codes[low:done])
                    best = min(best, (distance, low + end - first))
            if best[0] <= limit:
                yield item, *best


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _search(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, distance, place of the end) for some texts."""
    codes, begin, lengths = code_points(texts, index.how.steps + 1)
    guesses: dict[int, dict[int, list[int]]] = {}
    for window, item, where in index.hits(_symbols(codes), word_starts(codes)):
        owner = int(np.searchsorted(begin, window, side="right")) - 1
        guesses.setdefault(owner, {}).setdefault(item, []).append(where)
    for owner in range(len(texts)) if index.segments else ():
        first = int(begin[owner])
        for item, where in index.met(_text(codes[first : first + lengths[owner]])):
            guesses.setdefault(owner, {}).setdefault(item, []).append(first + where)
    for owner, places in guesses.items():
        first = int(begin[owner])
        for item, distance, end in index.verified(codes, first, first + int(lengths[owner]), places):
            yield owner, item, distance, end
    for owner in range(len(texts)) if index.tiny else ():
        text = _text(codes[begin[owner] : begin[owner] + lengths[owner]])
        ends: dict[int, int] = {}
        for end, items in index.tiny.iter(f" {text} "):
            for item in items:
                ends.setdefault(item, end - 1)
        for item, end in ends.items():
            yield owner, item, 0, end


def search(index: Index, texts: Iterable) -> Iterator[tuple[int, int, int, int]]:
    """(text, item_id, distance, place of the end), some texts at a time."""
    for first, part in chunks(texts, _CHARACTERS_AT_ONCE):
        for owner, item, distance, end in _search(index, part):
            yield first + owner, index.ids[item], distance, end


_built: dict[str, Index] = {}


def _index(name: str, items: Broadcast, how: Search) -> Index:
    """The index of a block, built once for each worker."""
    if name not in _built:
        _built.clear()
        _built[name] = Index(items.value, how)
    return _built[name]


def _blocks(benchmark: DataFrame, how: Search) -> Iterator[Callable[[], Index]]:
    """The items, some million characters at a time, as something a task makes an index of."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_CHARACTERS)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()
        held = benchmark.sparkSession.sparkContext.broadcast(sorted({(r.item_id, r.text) for r in part}))
        yield partial(_index, uuid.uuid4().hex, held, how)


def matches(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """``doc_id, text_key, item_id, distance, end_char`` for each item that a document contains.

    Compared are lower-cased words of letters and digits with one space between two. An item is
    contained if a substring of the document is at most ``rate`` edits for each of its characters
    away; ``distance`` is the least of those found and ``end_char`` counts to the end of that
    substring. Items of so few characters that no edit is allowed are searched as whole words. Null texts
    contain nothing, items with a null id or text or without words are skipped, items with one
    id and different texts may give a row each, and repeated rows of ``docs`` give repeated rows.
    """
    rows = documents_of(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key bigint, item_id {item_kind}, distance int, end_char bigint"
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def found(block: Callable[[], Index]):
        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block()
            for batch in rows:
                hits = list(search(index, batch.column("text")))
                owner, item, distance, end = (list(c) for c in zip(*hits)) if hits else ([],) * 4
                at = pa.array(owner, pa.int64())
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(at),
                        "text_key": batch.column("text_key").take(at),
                        "item_id": pa.array(item, item_type),
                        "distance": pa.array(distance, pa.int32()),
                        "end_char": pa.array(end, pa.int64()),
                    }
                )
            give_back()

        return batches

    parts = [rows.mapInArrow(found(block), schema) for block in _blocks(benchmark, how)]
    empty = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts) if parts else empty


def clean(docs: DataFrame, benchmark: DataFrame, how: Search = Search()) -> DataFrame:
    """The rows of ``docs``, with all columns, that contain no item. No row is shuffled."""
    for block in _blocks(benchmark, how):
        docs = docs.filter(~_contains(block)(F.coalesce("text", F.lit(""))))
    return docs


def _contains(block: Callable[[], Index]):
    @F.arrow_udf("boolean")
    def contains(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = block()
        for texts in batches:
            held = np.zeros(len(texts), dtype=bool)
            held[[hit[0] for hit in search(index, texts)]] = True
            yield pa.array(held)
        give_back()

    return contains
