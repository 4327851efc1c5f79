"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count exactly.

A phrase is frequent if it occurs often enough, and then its beginning and its end, one word shorter,
are too. A sample is mined with a lowered limit; what is frequent there is the proposal. A full pass
counts every phrase whose beginning and end have been proposed: these are the proposal and its
negative border, as far as it occurs at all. Where a phrase of the border turns out frequent, it joins
the proposal, and another full pass counts what the border has become, and nothing twice. When no
pass finds one, every frequent phrase has been counted. Where such failures are rare, the pass after
them takes all that they can be part of for proposed: it counts a little more, and no pass is needed
after it.

Counting works with 64-bit hashes. A task hashes words and phrases of some texts at once (numpy), adds
equal ones up and hands them on as a few sorted arrays, one for each bucket of hashes, so the shuffle
moves blocks and a hot phrase is one number of a block. Buckets follow the size of the corpus. Hashes that meet
can only add to a count, so the last pass, which spells the frequent phrases and counts them as
strings, settles what remains of them.

What tasks need to know of the proposal is a Bloom filter. It is no larger than 32 MB whatever the
corpus; where it says too much, more is counted, and the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpipe.llm.bloom import Filter, filter_of
from textpipe.llm.common import broadcast_if, finished, give_back, materialize

UNKNOWN = "und"
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
_PIECE_END = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]")
# Bytes that are hashed at once, and hashes that are added up at once.
_BYTES_AT_ONCE = 1 << 20
_KEYS_AT_ONCE = 1 << 21
_PHRASES_AT_ONCE = 1 << 18
_BUCKET_KEYS = 1 << 21
# Failures are rare if they stand at one of so many words at most.
_RARE = 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the ``top`` ones of each
    language. ``sample`` is the share of rows that propose, with ``lowered`` of their share of
    ``least`` as the limit; neither changes the result."""

    least: int = 100
    longest: int = 5
    top: int = 2000
    sample: float = 0.1
    lowered: float = 0.5


@cache
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class (0 word, 1 blank, 2 end of piece) and number of each byte; powers of a base, and inverses."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(WORD_ENDS)], kind[list(PIECE_ENDS)] = 1, 2
    number = np.random.default_rng(11).integers(1 << 64, size=256, dtype=np.uint64)
    number[ord("A") : ord("Z") + 1] = number[ord("a") : ord("z") + 1]
    base = 0xD6E8FEB86659FD93
    powers = [np.full(size + 1, x, dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    for p in powers:
        p[0] = 1
        np.cumprod(p, out=p)
    return kind, number, *powers


def _stretches(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end with a piece; a piece is never divided."""
    start = 0
    while len(text) - start > _BYTES_AT_ONCE:
        end = _PIECE_END.search(text, start + _BYTES_AT_ONCE // 2)
        if end is None:
            break
        yield text[start : end.end()]
        start = end.end()
    yield text[start:] if start else text


class Words:
    """The words of some texts: where they stand, their hashes, their pieces and languages."""

    def __init__(self, texts: list[bytes], languages: np.ndarray, seeds: np.ndarray) -> None:
        self.data = b"\n".join(texts) + b"\n"
        size = 1 << max(20, len(self.data).bit_length())
        kind, number, power, inverse = _tables(size)
        raw = np.frombuffer(self.data, dtype=np.uint8)
        kinds = kind[raw]
        edges = np.diff((kinds == 0).view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(number[raw] * power[: len(raw)], out=sums[1:])
        self.hashes = finished((sums[self.ends] - sums[self.starts]) * inverse[self.starts])
        self.pieces = np.cumsum(kinds == 2, dtype=np.int32)[self.starts]
        begins = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        owner = np.searchsorted(begins, self.starts, side="right") - 1
        self.languages = languages[owner]
        self.first = finished(self.hashes ^ seeds[self.languages])

    def __len__(self) -> int:
        return len(self.starts)

    def longer(self, shorter: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the phrases of ``n`` words at some places, from those of their beginnings."""
        return finished(shorter[at] * _MULTIPLIER + self.hashes[at + n - 1])

    def candidates(self, member: np.ndarray, n: int) -> np.ndarray:
        """Where a phrase of ``n`` words begins whose beginning and end are members."""
        if len(self) < n:
            return np.zeros(0, dtype=np.int64)
        inside = self.pieces[: len(self) - n + 1] == self.pieces[n - 1 :]
        return np.flatnonzero(inside & member[: len(inside)] & member[1 : len(inside) + 1])

    def spelled(self, at: int, n: int) -> str:
        """A phrase as text: its words with A-Z lower-cased, one blank between two."""
        words = (self.data[self.starts[k] : self.ends[k]] for k in range(at, at + n))
        return b" ".join(words).lower().decode("utf-8", "replace")


def _batches_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of a bounded number of bytes at a time, whatever the batches and texts."""
    names: list[str] = []
    place: dict[str, int] = {}
    seeds: list[int] = []
    held, owner, size = [], [], 0

    def words() -> tuple[Words, list[str]]:
        return Words(held, np.array(owner, dtype=np.int64), np.array(seeds, dtype=np.uint64)), names

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary())):
            name = lang.as_py()
            if name not in place:
                place[name] = len(names)
                names.append(name)
                seeds.append(int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "big"))
            for part in _stretches(text.as_py()):
                if held and size + len(part) > _BYTES_AT_ONCE:
                    yield words()
                    held, owner, size = [], [], 0
                held.append(part)
                owner.append(place[name])
                size += len(part)
    if held:
        yield words()


def _member(filters: Sequence[Filter]) -> Callable[[np.ndarray], np.ndarray]:
    """Whether any of the filters has a hash."""

    def found(keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=bool)
        for one in filters:
            out |= one(keys)
        return out

    return found


@dataclass(frozen=True)
class Proposal:
    """What a pass counts: phrases whose beginning and end are members.

    A phrase of up to ``known`` words is a member if a filter of ``now`` has it, a longer one if it
    is counted. Phrases that were counted with ``before`` as the filters are not counted again;
    with ``wide`` all that is counted for the first time is a member too.
    """

    known: int
    now: tuple[Filter, ...] = ()
    before: tuple[Filter, ...] = ()
    wide: bool = False


def phrase_hashes(words: Words, lengths: range, by: Proposal) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of the lengths: places and hashes of the phrases that are counted."""
    n_words = len(words)
    keys = words.first
    now, before = _member(by.now), _member(by.before)
    member = now(keys) if by.known else np.ones(n_words, dtype=bool)
    earlier = before(keys)
    if 1 in lengths and not by.before:
        yield 1, np.arange(n_words), keys
    for n in range(2, lengths.stop):
        at = words.candidates(member, n)
        found = words.longer(keys, at, n)
        old = words.candidates(earlier, n) if by.before else np.zeros(0, dtype=np.int64)
        new = np.isin(at, old, assume_unique=True, invert=True) if len(old) else np.ones(len(at), dtype=bool)
        if n in lengths:
            yield n, at[new], found[new]
        keys = np.zeros(n_words, dtype=np.uint64)
        keys[at] = found
        member, earlier = np.zeros(n_words, dtype=bool), np.zeros(n_words, dtype=bool)
        member[at] = now(found) if n <= by.known else True
        earlier[old] = before(keys[old]) if n <= by.known else True
        if by.wide:
            member[at[new]] = True


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _counted(texts: DataFrame, least: int, buckets: int, lengths: range, by: Proposal) -> DataFrame:
    """``key, n, member`` of the phrases that occur ``least`` times, of those that are counted now."""
    held = texts.sparkSession.sparkContext.broadcast(by)
    bits = buckets.bit_length() - 1

    def packed(keys: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(keys), return_counts=True)
        bucket = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), dtype=np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        bounds = np.append(edges, len(found))
        cuts = list(zip(bounds, bounds[1:]))
        counts = counts.astype("<u4")
        return pa.record_batch(
            {
                "bucket": pa.array(bucket[edges]),
                "keys": pa.array([found[a:b].tobytes() for a, b in cuts], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in cuts], pa.binary()),
            }
        )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for words, _ in _batches_of_words(batches):
            for _, _, keys in phrase_hashes(words, lengths, held.value):
                waiting.append(keys)
                size += len(keys)
            if size >= _KEYS_AT_ONCE:
                yield packed(waiting)
                waiting, size = [], 0
        if size:
            yield packed(waiting)
        give_back()

    def added(_: tuple, rows: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in rows.column("keys")])
        counts = np.concatenate([np.frombuffer(x.as_py(), dtype="<u4") for x in rows.column("counts")])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        often = total >= least
        found = keys[first][often]
        member = _member(held.value.now)(found)
        return pa.table({"key": found.view(np.int64), "n": total[often], "member": member})

    rows = texts.mapInArrow(tasks, "bucket bigint, keys binary, counts binary")
    return rows.groupBy("bucket").applyInArrow(added, "key bigint, n bigint, member boolean")


class Spelled:
    """Counts of phrases that a task has met, with their spelling; bounded by ``_PHRASES_AT_ONCE``."""

    def __init__(self) -> None:
        self.place: dict[tuple[int, int], int] = {}
        self.key: list[int] = []
        self.lang: list[str] = []
        self.phrase: list[str] = []
        self.words: list[int] = []
        self.f: list[int] = []

    def add(self, words: Words, names: list[str], n: int, at: np.ndarray, keys: np.ndarray) -> None:
        # The weighted sum of word hashes tells phrases apart that meet in one hash.
        check = np.zeros(len(at), dtype=np.uint64)
        for k in range(n):
            check += words.hashes[at + k] * np.uint64(2 * k + 1)
        order = np.lexsort((check, keys))
        keys, check = keys[order], check[order]
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (check[1:] != check[:-1]))))
        counts = np.diff(np.append(first, len(keys))).tolist()
        places = at[order[first]].tolist()
        for key, mark, place, count in zip(keys[first].tolist(), check[first].tolist(), places, counts):
            k = self.place.setdefault((key, mark), len(self.f))
            if k < len(self.f):
                self.f[k] += count
            else:
                self.key.append(key)
                self.lang.append(names[words.languages[place]])
                self.phrase.append(words.spelled(place, n))
                self.words.append(n)
                self.f.append(count)

    def packed(self, bits: int) -> pa.RecordBatch:
        """The counts as one row for each bucket of hashes."""
        bucket = (np.array(self.key, dtype=np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        ends = pa.array(np.append(edges, len(order)), pa.int32())
        columns = {"bucket": pa.array(bucket[order][edges])}
        for name, kind in (("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())):
            values = pa.array(getattr(self, name), kind).take(pa.array(order))
            columns[name] = pa.ListArray.from_arrays(ends, values)
        return pa.record_batch(columns)


def _spelled(texts: DataFrame, found: Filter, longest: int, buckets: int) -> DataFrame:
    """``lang, phrase, words, f``: phrases whose hashes the filter has, counted as strings."""
    held = texts.sparkSession.sparkContext.broadcast(Proposal(longest, (found,)))
    bits = buckets.bit_length() - 1

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = _member(held.value.now)
        counts = Spelled()
        for words, names in _batches_of_words(batches):
            for n, at, keys in phrase_hashes(words, range(1, longest + 1), held.value):
                hit = member(keys)
                if hit.any():
                    counts.add(words, names, n, at[hit], keys[hit])
            if len(counts.f) >= _PHRASES_AT_ONCE:
                yield counts.packed(bits)
                counts = Spelled()
        if counts.f:
            yield counts.packed(bits)
        give_back()

    def added(_: tuple, rows: pa.Table) -> pa.Table:
        each = pa.table({c: rows.column(c).combine_chunks().flatten() for c in ("lang", "phrase", "words", "f")})
        total = each.group_by(["lang", "phrase", "words"]).aggregate([("f", "sum")])
        return total.rename_columns(["lang", "phrase", "words", "f"])

    lists = "lang array<string>, phrase array<string>, words array<int>, f array<bigint>"
    rows = texts.mapInArrow(tasks, f"bucket bigint, {lists}")
    return rows.groupBy("bucket").applyInArrow(added, "lang string, phrase string, words int, f bigint")


def _words_of(text: str) -> Column:
    """The number of words of a text, in the JVM."""
    ends = "".join(f"\\x{b:02x}" for b in PIECE_ENDS + WORD_ENDS)
    return F.regexp_count(text, F.lit(f"[^{ends}]+"))


def mined(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``lang, phrase, words, f`` of all phrases of 1 to ``longest`` words that are frequent.

    The row of a language without a phrase has the number of all its words.
    """
    texts = _texts(docs)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    # A word takes some six bytes; most counted hashes are of pairs of words.
    n_words = size // 6
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(tasks.bit_length() + 1, (n_words // _BUCKET_KEYS).bit_length())
    rate = F.lit(int(how.sample * (1 << 20)))
    drawn = F.pmod(F.xxhash64("lang", "text", F.monotonically_increasing_id()), F.lit(1 << 20)) < rate
    sample = materialize(texts.filter(drawn), "sample")
    limit = max(2, int(how.least * how.sample * how.lowered))
    most = min(2, how.longest)
    short = materialize(_counted(sample, limit, buckets, range(1, most + 1), Proposal(0)), "proposed")
    proposed = (filter_of(short),)
    if how.longest > 3:
        long = materialize(_counted(sample, limit, buckets, range(3, how.longest), Proposal(2, proposed)), "proposed")
        proposed = (filter_of(short.unionByName(long)),)
    lengths, known = range(1, how.longest + 1), how.longest - 1
    found, by = None, Proposal(known, proposed)
    while True:
        # A frequent phrase of the longest kind borders on nothing more: it may go around once for
        # nothing.
        new = materialize(_counted(texts, how.least, buckets, lengths, by), "frequent")
        found = new if found is None else found.unionByName(new)
        failed = new.filter("not member")
        places = 0 if by.wide else failed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
        if not places:
            break
        by = Proposal(known, (*by.now, filter_of(failed)), by.now, wide=places * _RARE <= n_words)
    counted = _spelled(texts, filter_of(found), how.longest, buckets).filter(F.col("f") >= how.least)
    every = texts.groupBy("lang").agg(F.sum(_words_of("text")).cast("bigint").alias("f")).filter("f > 0")
    nothing = F.lit(None).cast("string").alias("phrase")
    return materialize(counted.unionByName(every.select("lang", nothing, F.lit(0).alias("words"), "f")), "phrases")


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score, k`` of the phrases of two words and more.

    A phrase is cut after its first ``k`` words such that ``floor(1000 * a * n / (l * r))`` is
    smallest. Products are decimal numbers of 38 digits, counts may have 16.
    """
    phrases = counts.filter("phrase is not null")
    # One row for each language: joined by shuffle, all phrases of a language would meet in one task.
    every = broadcast_if(materialize(counts.filter("phrase is null").select("lang", F.col("f").alias("n")), "languages"), 64)
    part = F.split("phrase", " ")
    k = F.col("k")
    cuts = phrases.filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.withColumns(
        {"head": F.array_join(F.slice(part, F.lit(1), k), " "), "tail": F.array_join(F.slice(part, k + 1, F.col("words") - k), " ")}
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    joined = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(every, "lang")
    whole = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "n", "l", "r")}
    above = F.lit(1000).cast("decimal(4,0)") * whole["a"] * whole["n"]
    joined = joined.withColumns({"above": above, "below": whole["l"] * whole["r"]})
    # What is over when the rest is taken off divides without one.
    exact = joined.withColumn("score", F.expr("above div below"))
    return exact.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score", "cut.k")


def maximal(phrases: DataFrame) -> DataFrame:
    """``phrases`` without those inside a longer one that occurs as often.

    A phrase that lies in a longer one lies in one that is longer by a word and as frequent as that
    at least, so it is enough to look at these.
    """
    part = F.split("phrase", " ")
    inner = phrases.filter("words > 2").select(
        "lang",
        F.explode(F.array(*[F.array_join(F.slice(part, F.lit(b), F.col("words") - 1), " ") for b in (1, 2)])).alias("phrase"),
        F.col("a").alias("longer"),
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return phrases.join(most, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * a").drop("longer")


def collocations(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language.

    A-Z are lower-cased; ``.,;:!?`` and the line ends (``\\n`` to ``\\r``) end a piece, blanks and
    tabs a word, and a phrase lies within a piece. A null ``lang`` is ``und``, a null text empty;
    repeated rows count each; ties in score go by count and then by the bytes of the phrase. An
    empty table gives no rows; other columns are not read.
    """
    best = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    held = materialize(maximal(materialize(scored(mined(docs, how)), "scored")), "collocations")
    # First within parts of a language, so that no task has all of its phrases.
    parts = held.count() // 50_000 + 1
    dealt = held.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = Window.partitionBy("lang", "part").orderBy(*best)
    few = dealt.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= how.top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    ranked = few.withColumn("rank", rank).filter(F.col("rank") <= how.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
