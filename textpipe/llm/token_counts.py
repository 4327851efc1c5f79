"""Token counts by the whole-token shortcut: most pre-tokens are one token, and known to be.

A BPE tokenizer cuts a text into pre-tokens and merges within each. Before the job, every string of
the vocabulary is encoded alone; those that come back as their one token are proved whole, since the
merges of a pre-token depend on nothing but itself. In the tasks a pre-token that is one of them
counts as one without any merging, and only the rest is merged, by the model of the file.

Where the file drops white space (its pre-tokenizer keeps what a pattern finds, and no part of that
pattern takes white space), a text is first cut at ASCII white space: normalization and pattern work
within such a stretch alone, so the count of a text is the sum over its stretches. A stretch that is a
proved string counts as one at once, and a bounded memory holds the counts of others seen lately.
Stretches of characters for which it is proved too that the file does no more than lower-case them are
cut into pre-tokens here; others by the file's own normalizer and pre-tokenizer.

One pass in the map tasks, without a shuffle. The table of proved strings is as large as the
vocabulary, whatever the size of the corpus.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpipe.llm.tokens import added_tokens, byte_characters, tokenizer

LIMIT = 2048
# Counts of stretches that a worker remembers, and the longest stretch that it does.
REMEMBERED = 200_000
REMEMBERED_BYTES = 64
_SPACE = " \t\n\x0b\x0c\r"


# Where characters are tried: those of Latin scripts, and common marks.
_TRIED = [*range(0x21, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x20A0, 0x20C0)]


@cache
def _pattern(path: str) -> str | None:
    """The pattern of a pre-tokenizer that starts with keeping only what the pattern finds."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file).get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    keeps = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    return first.get("pattern", {}).get("Regex") if keeps else None


@cache
def drops_space(path: str) -> bool:
    """Whether stretches between ASCII white space can be encoded one by one.

    True where only what a pattern finds is kept, and the pattern looks at nothing around that and
    leaves white space alone.
    """
    pattern = _pattern(path)
    if not pattern:
        return False
    # A class takes white space only through one of these, or a blank of its own.
    plain = pattern.replace(r"[^\s", "")
    takes = any(x in plain for x in ("(?", "[^", ".", r"\W", r"\D", r"\S", r"\P", r"\s", *_SPACE))
    return not takes and not tokenizer(path).pre_tokenizer.pre_tokenize_str(_SPACE)


def _byte_level(text: str) -> str:
    """The characters that stand for the bytes of a text."""
    return text if text.isascii() else text.encode().decode("latin-1").translate(_byte_table())


@cache
def _byte_table() -> dict[int, str]:
    return {b: c for c, b in byte_characters().items()}


@cache
def _octets() -> dict[str, int]:
    return byte_characters()


@cache
def plain_characters(path: str) -> frozenset[str]:
    """Characters that the normalizer only lower-cases and that the pattern is known to class alike.

    Each is handed to the file's own normalizer and pre-tokenizer, alone and twice in a row. All are
    letters, digits and marks that no neighbour of this set can be composed with.
    """
    whole, pattern = tokenizer(path), _pattern(path)
    if not drops_space(path) or not whole.normalizer:
        return frozenset()
    find = regex.compile(pattern).findall

    def agrees(text: str) -> bool:
        lower = text.lower()
        parts = [p for p, _ in whole.pre_tokenizer.pre_tokenize_str(lower)]
        return whole.normalizer.normalize_str(text) == lower and parts == [_byte_level(p) for p in find(lower)]

    tried = (chr(c) for c in _TRIED)
    return frozenset(c for c in tried if len(c.lower()) == 1 and agrees(c) and agrees(c + c))


@cache
def proved(path: str) -> dict[str, bytes]:
    """Pre-tokens (as the model sees them) that are one token, with their spelling.

    Each string of the vocabulary is handed to the model of the file alone. The spelling is empty
    where the string alone, through the whole tokenizer, is something else: other normalization, or
    several pre-tokens.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model.get("type") != "BPE" or model.get("dropout"):
        raise ValueError(f"Not a BPE vocabulary without dropout: {path}")
    suffix = model.get("end_of_word_suffix") or ""
    whole, octet = tokenizer(path), _octets()
    merge = whole.model.tokenize
    held: dict[str, bytes] = {}
    for token in model["vocab"]:
        pre_token = token.removesuffix(suffix)
        if pre_token and token.endswith(suffix) and [t.value for t in merge(pre_token)] == [token]:
            held[pre_token] = bytes(octet[c] for c in pre_token) if all(c in octet for c in pre_token) else b""
    spellings = {t: raw.decode("utf-8", "ignore") for t, raw in held.items()}
    for (token, raw), found in zip(
        held.items(), whole.encode_batch(list(spellings.values()), add_special_tokens=False)
    ):
        if spellings[token].encode() != raw or found.ids != [model["vocab"][token + suffix]]:
            held[token] = b""
    return held


class _Merges(dict):
    """Tokens of a pre-token: one for the proved ones, from the start, and the merged count of others."""

    def __init__(self, proofs: dict[str, bytes], merge) -> None:
        super().__init__(dict.fromkeys(proofs, 1))
        self.most, self.merge = len(proofs) + REMEMBERED, merge

    def __missing__(self, pre_token: str) -> int:
        n = len(self.merge(pre_token))
        if len(pre_token) <= REMEMBERED_BYTES and len(self) < self.most:
            self[pre_token] = n
        return n


class Counter(dict):
    """Tokens of a stretch of a text; the proved strings are there from the start."""

    def __init__(self, path: str, proofs: dict[str, bytes]) -> None:
        whole, pattern = tokenizer(path), _pattern(path)
        self.pre_tokens = whole.pre_tokenizer.pre_tokenize_str
        self.normalize = whole.normalizer.normalize_str if whole.normalizer else str
        self.plain = plain_characters(path).issuperset
        self.find = regex.compile(pattern).findall if pattern else None
        self.tokens = _Merges(proofs, whole.model.tokenize).__getitem__
        self.proofs = proofs
        self._start()

    def _start(self) -> None:
        self.clear()
        self.update((raw, 1) for raw in self.proofs.values() if raw)

    def __missing__(self, stretch: bytes) -> int:
        text = stretch.decode("utf-8", "replace")
        if text and self.plain(text):
            n = sum(self.tokens(_byte_level(p)) for p in self.find(text.lower()))
        else:
            n = sum(self.tokens(p) for p, _ in self.pre_tokens(self.normalize(text)))
        if len(stretch) <= REMEMBERED_BYTES:
            if len(self) >= len(self.proofs) + REMEMBERED:
                self._start()
            self[stretch] = n
        return n


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each whole text, as ``tokenizers`` counts them.

    ``vocabulary`` is a JSON file of a BPE tokenizer on every machine; nothing is added, cut or
    padded. Texts that hold an added token, such as ``<|endoftext|>``, go through ``tokenizers``
    itself, which has one token for it. A null text is an empty one and has none. Each row has a
    row, repeated ones and those without an id too; an empty table gives none; other columns are
    not read.
    """
    proofs, by_stretch = proved(vocabulary), drops_space(vocabulary)
    special = [t.encode() for t in added_tokens(vocabulary)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = tokenizer(vocabulary)
        known = Counter(vocabulary, proofs)
        count = known.__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column("text").cast(pa.binary()):
                text = value.as_py()
                if any(token in text for token in special):
                    n = len(whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
                else:
                    n = sum(map(count, text.split() if by_stretch else (text,)))
                n_bytes.append(len(text))
                n_tokens.append(n)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(n_bytes, pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                }
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(counted, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
