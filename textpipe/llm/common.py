"""What several operators need: written tables, row keys, names that are free, normalized text."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpipe.sources.scratch import scratch_path

# The ASCII white space that separates words, as a Java and as an RE2 character class.
WHITE_SPACE = r"[ \t-\r]"
DOCUMENT = "doc_id", "text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column of ``df`` has (whatever the case)."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def text_key(text: str = "text") -> Column:
    """A number for a text. Together with the id it tells rows apart whose ids repeat."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def documents_of(df: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the number of the text, without other columns."""
    return df.select("doc_id", text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case (of one character), and whether a word may hold it."""
    n = sys.maxunicode + 1
    # One character at a time: a list of all would stay in the memory of every worker.
    lower = (chr(i).lower() for i in range(n))
    return (
        np.fromiter((ord(x) if len(x) == 1 else i for i, x in enumerate(lower)), np.uint32, n),
        np.fromiter((chr(i).isalnum() for i in range(n)), bool, n),
    )


@cache
def spaces() -> np.ndarray:
    """For each code point whether it is white space."""
    return np.fromiter((chr(i).isspace() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@cache
def symbol_numbers(seed: int) -> np.ndarray:
    """A random number for each code point, the same for both cases of a letter."""
    lower, _ = _letters()
    return np.random.default_rng(seed).integers(1 << 64, size=sys.maxunicode + 1, dtype=np.uint64)[lower]


def finished(x: np.ndarray) -> np.ndarray:
    """Mix the bits of sums of products, whose low bits depend on little."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def chunks(texts: Iterable, characters: int) -> Iterator[tuple[int, list[str]]]:
    """Some texts at a time, so that memory does not follow the size of a batch.

    ``texts`` may be an Arrow column, of which no more become Python strings than are needed.
    """
    start, size, part = 0, 0, []
    for text in texts:
        text = text if isinstance(text, str) else text.as_py()
        if size and size + len(text) > characters:
            yield start, part
            start, size, part = start + len(part), 0, []
        part.append(text)
        size += len(text)
    if part:
        yield start, part


def give_back() -> None:
    """Return the memory that a worker has freed to the machine, at the end of a task.

    Workers live on, and what they hold adds up to what the executor holds.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def code_points(texts: Sequence[str], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words of the texts, one space between two, as one array of code points.

    Letters and digits make words, anything else separates them. Every text is followed by
    ``gap`` zeros. Returns the code points, where each text begins, and how long it is.
    """
    lower, alnum = _letters()
    joined = ("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass")
    raw = np.frombuffer(joined, dtype=np.uint32)
    word = alnum[raw]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[ends] = True
    kept = np.where(word, lower[raw], 32)[keep].astype(np.uint32)
    # A text may end in one space before its end mark; both become part of the gap.
    marks = np.cumsum(keep)[ends] - 1
    kept[marks] = 0
    starts = np.concatenate(([0], marks[:-1] + 1))
    lengths = marks - starts
    trailing = (lengths > 0) & (kept[marks - 1] == 32)
    kept[marks[trailing] - 1] = 0
    lengths = lengths - trailing
    sizes = lengths + gap
    out = np.zeros(int(sizes.sum()), dtype=np.uint32)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    shift = np.repeat(begin - starts, lengths)
    at = np.flatnonzero(kept)
    out[at + shift] = kept[at]
    return out, begin, lengths


BROADCAST_BYTES = 32 << 20


def broadcast_if(written: DataFrame, row_bytes: int) -> DataFrame:
    """A written table of numbers with a broadcast hint, if its rows are few enough for one.

    Its size is known from the number of rows. A longer table is joined by shuffle.
    """
    return F.broadcast(written) if written.count() * row_bytes <= BROADCAST_BYTES else written
