"""Packing: ids against the tokenizers library, places in sequences, the algorithm, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import SF
from tokenizers import Tokenizer

from textpipe.llm import packing
from textpipe.llm.packing import Breeding, District, best_fit, pack, sequences
from textpipe.llm.queries import QUERIES
from textpipe.llm.tokens import Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer() -> Tokenizer:
    found = Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


def test_ids_of_odd_texts(tokenizer):
    rng = random.Random(1)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "a\n\nb c", "<|endoftext|> x", "it's we'll", "é😀 ñ ",
             "tab\t tab", "\u00a0 x\u2003 y", "12 345 6,7", "x" * 300, "... --- !!!", "\x1c a", "a\u0085 b", "  lead", "trail  "]
    texts += ["".join(rng.choice(" \n\tab'.1é\u00a0") for _ in range(rng.randrange(40))) for _ in range(400)]
    encode = Encoder(VOCABULARY)
    got = [encode(text).tolist() for text in texts]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens(spark):
    """The ids are those of the tokenizer as loaded, where texts hold the literal of an added token."""
    loaded = Tokenizer.from_file(VOCABULARY)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "a  <|endoftext|>\n b", "<|endoftext|", "plain text"]
    texts += [f"word {k} " * 900 + "<|endoftext|> and more" for k in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = {}
    for d, text in enumerate(texts):
        ids = np.array([*loaded.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[d, k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    rows = pack(df, VOCABULARY).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert Encoder(VOCABULARY, added=True)(texts[0]).tolist() == [64, 220, 50256, 275]


def check_sequences(rows: list) -> int:
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end and length > 0
            end += length
        assert end <= 2048
    return len(by_sequence)


def test_query(spark, tokenizer):
    rows = QUERIES["op8_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    encoded = tokenizer.encode_batch([d.text or "" for d in docs], add_special_tokens=False)
    expected = {}
    for d, e in zip(docs, encoded):
        ids = np.array([*e.ids, 0], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[d.doc_id, k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_sequences(rows) <= least + 2


def test_several_districts(spark):
    """What districts leave is dealt anew, so that their number does not add up."""
    rng = random.Random(4)
    docs = [(k, " ".join("abc" for _ in range(int(rng.paretovariate(0.9) * 60) % 3000))) for k in range(1500)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = pack(df, VOCABULARY, how=Breeding(district=128)).collect()
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_sequences(rows) <= least * 1.01 + 2


def test_breeding_beats_best_fit():
    """Sizes that fit in threes, and for which best fit by falling size is not best."""
    before = after = 0
    for seed in range(4):
        rng = np.random.default_rng(seed)
        pairs = np.sort(rng.integers(300, 1000, (80, 2)), axis=1)
        triples = [(a, b, 2048 - a - b) for a, b in pairs.tolist() if 2048 - a - b > 250]
        sizes = np.array(triples).ravel()
        place = District(sizes, 2048, Breeding(offspring=400), [1])
        population = place.first()
        bred = place.evolve(population)[0]
        assert place.fills(bred).max() <= 2048 and bred.max() + 1 == len(place.fills(bred))
        assert place.fitness(bred) > max(map(place.fitness, population))
        before += min(len(place.fills(x)) for x in population)
        after += len(place.fills(bred))
        child = place.cross(population[1], population[2])
        assert place.fills(child).max() <= 2048 and place.fills(child).min() > 0
        assert place.fills(place.mutate(population[0])).max() <= 2048
    assert after < before


def least_bins(sizes: list[int], limit: int) -> int:
    """The fewest bins, by trying all places of each size."""
    best = len(sizes)

    def place(k: int, fills: list[int]) -> None:
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(sizes):
            best = len(fills)
            return
        for b in range(len(fills)):
            if fills[b] + sizes[k] <= limit:
                place(k + 1, [*fills[:b], fills[b] + sizes[k], *fills[b + 1 :]])
        place(k + 1, [*fills, sizes[k]])

    place(0, [])
    return best


def test_fewest_bins_of_small_districts():
    for seed in range(25):
        rng = np.random.default_rng(seed)
        sizes = np.sort(rng.integers(15, 70, 9))[::-1].copy()
        place = District(sizes, 100, Breeding(), [seed])
        bred = place.evolve(place.first())[0]
        assert bred.max() + 1 == least_bins(sizes.tolist(), 100), seed


def test_best_fit():
    sizes = np.array([5, 3, 4, 2, 6])
    bins, free = np.zeros(5, dtype=np.int64), []
    best_fit(sizes, 10, np.array([4, 0, 2, 1, 3]), bins, free)
    assert bins.tolist() == [1, 1, 0, 1, 1] or [sizes[bins == b].sum() for b in set(bins.tolist())] == [10, 10]


def test_odd_rows(spark, odd, tokenizer):
    packed = pack(odd, VOCABULARY, with_ids=True)
    rows = packed.collect()
    check_sequences(rows)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert sum(r.length == 1 for r in rows) >= 3  # empty texts are one id
    held = sequences(packed).collect()
    assert all(len(s.ids) <= 2048 for s in held)
    # Every document ends with the id 0, which none of these texts has inside.
    assert sum(s.ids.count(0) for s in held) == odd.count()
    ids = [e.ids for e in tokenizer.encode_batch([r.text or "" for r in odd.collect()], add_special_tokens=False)]
    assert sum(len(x) + 1 for x in ids) == sum(r.length for r in rows)
    assert pack(odd.limit(0), VOCABULARY).count() == 0
