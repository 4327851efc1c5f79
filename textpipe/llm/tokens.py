"""Token ids of whole texts, cut into pieces that fit a sequence.

The ids are those of the ``tokenizers`` file; they are computed from its vocabulary by
``tiktoken``, which gives the same ids in a fifth of the time. Only texts that hold one of the
file's added tokens, such as ``<|endoftext|>``, are handed to ``tokenizers`` itself. A worker holds
the ids of one text at a time.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textpipe.llm.common import give_back

# How byte-level BPE divides a text before it merges (fixed value of the vocabulary), with repeats
# that never give back a character, where none has to: the parts are the same, found faster.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END = 0


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a ``tokenizers`` JSON or a ``tiktoken`` file, without special tokens."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"] for t in content.get("added_tokens", [])}
        octet = byte_characters()
        ranks = {
            bytes(octet[c] for c in token): i
            for token, i in content["model"]["vocab"].items()
            if token not in special
        }
    else:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@cache
def added_tokens(path: str) -> list[str]:
    """The added tokens of a ``tokenizers`` JSON file; they are one id wherever a text holds them."""
    if not path.endswith(".json"):
        return []
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of one text at a time.

    ``added``: whether the added tokens of the file are one id each, as ``tokenizers`` has them with
    or without ``add_special_tokens``; else they are text like any other.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        self.path = path
        self.added = added_tokens(path) if added else []
        self.encode = encoding(path).encode_ordinary

    def __call__(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            ids = tokenizer(self.path).encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        return np.array(ids, dtype="<u4")


def pieces(docs: DataFrame, vocabulary: str, limit: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of the pieces of each document.

    A document is the ids of its whole text (null: empty), added tokens included, and the id 0.
    Longer ones than ``limit`` are cut into pieces of that length; what is left over is the first
    piece. ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers. ``vocabulary`` is
    a file on every machine.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, added=True)
        for batch in batches:
            owner, place, start, length, crc, held = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.append(encoder(text.as_py()), np.uint32(END)).astype("<u4")
                head = (len(ids) - 1) % limit + 1
                cuts = [0, *range(head, len(ids) + 1, limit)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(row)
                    place.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        held.append(ids[a:b].astype(np.int32))
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64())),
                "piece": pa.array(place, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(held, pa.list_(pa.int32()))
            yield pa.record_batch(columns)
        give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)
