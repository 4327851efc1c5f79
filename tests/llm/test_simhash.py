"""SimHash near-duplicates against brute force over all pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from conftest_llm import brute_components
from xxhash import xxh64_intdigest

from textpipe.llm import simhash
from textpipe.llm.components import connected_components
from textpipe.llm.queries import QUERIES


def plain_fingerprint(text: str, shingle: int = 4) -> int:
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_against_brute_force(spark):
    from conftest_llm import SF

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fp = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids, bits = list(fp), np.array(list(fp.values()), dtype=np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    expected = brute_components(ids, near)
    got = {r.doc_id: r for r in QUERIES["op10_simhash"](spark, SF).collect()}
    assert len(got) == len(rows)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fp
    assert all(len(r.fingerprint) == 16 for r in got.values())
    assert {i: r.component_id for i, r in got.items()} == expected


def test_crowded_buckets(spark):
    """Thousands of fingerprints around one centre and chains of them, over several tiles."""
    rng = np.random.default_rng(7)
    centre = int(rng.integers(1 << 62))
    flips = [0]
    flips += [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(40) for j in range(i)]
    crowd = [centre ^ f for f in flips]
    chain = [0]
    for i in range(15):
        chain.append(chain[-1] | 0xF << (4 * i))
    alone = [int(x) for x in rng.integers(1 << 63, size=500, dtype=np.uint64)]
    bits = np.array(sorted({*crowd, *chain, *alone}), dtype=np.uint64)
    nodes = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "fp bigint")
    found = connected_components(simhash.links(nodes)).collect()
    root = {int(b): int(b) for b in bits.view(np.int64)} | {r.node: r.root for r in found}
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    expected = brute_components([int(b) for b in bits.view(np.int64)], near)
    assert root == expected


def test_pairs_share_a_key():
    rng = np.random.default_rng(3)
    masks = simhash.blocks(4)
    assert sum(masks) == 2**64 - 1 and len(masks) == 6
    one = rng.integers(1 << 63, size=500, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for _ in one]
    assert all(sum(not f & m for m in masks) >= 2 for f in flips)
    left = simhash.coordinate_keys(one)
    right = simhash.coordinate_keys(one ^ np.array(flips, dtype=np.uint64))
    assert (left == right).any(axis=1).all()
    assert len(np.unique(left)) > 0.99 * left.size


def test_odd_rows(spark, odd):
    got = simhash.near_duplicates(odd)
    rows = got.collect()
    assert len(rows) == odd.count()
    of = {(r.doc_id, r.text_key): r for r in rows}
    assert len(of) == 12
    blank = {r.component_id for r in rows if r.fp == 0}
    assert blank == {2}
    assert {r.component_id for r in rows if r.doc_id == 7} == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert [i for i, _ in ids] == [-1, 1, 1, 2, 5, 8, 9]
    none = odd.limit(0)
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def test_more_blocks_for_more_fingerprints():
    """What meets by chance does not grow with the number of fingerprints."""
    for max_bits in (1, 3, 4, 8):
        agree = [simhash.untouched_blocks(10**k, max_bits) for k in range(2, 13)]
        assert agree == sorted(agree) and agree[0] == 2 and agree[-1] <= 12
        keys = [len(list(combinations(range(max_bits + a), a))) * 10**k / 2 ** (64 * a // (max_bits + a)) for k, a in zip(range(2, 13), agree)]
        assert max(keys) <= simhash.MET_BY_CHANCE or agree[-1] == 12
    rng = np.random.default_rng(5)
    fps = rng.integers(1 << 64, size=3000, dtype=np.uint64)
    met = {}
    for agree in (2, 3, 4):
        keys = simhash.coordinate_keys(fps, 4, 24, agree)
        met[agree] = sum(len(fps) - len(np.unique(k)) for k in keys.T)
    assert met[4] <= met[3] < 10 < met[2]


@pytest.mark.parametrize("agree", [2, 3, 5])
def test_links_whatever_the_blocks(spark, monkeypatch, agree):
    monkeypatch.setattr(simhash, "untouched_blocks", lambda n, max_bits: agree)
    rng = np.random.default_rng(agree)
    base = rng.integers(1 << 64, size=40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(64, size=40, dtype=np.uint64)) for _ in range(5)]]))
    for _ in range(2):
        fps = np.unique(np.concatenate([fps, fps[::3] ^ (np.uint64(1) << rng.integers(64, size=len(fps[::3]), dtype=np.uint64))]))
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in simhash.connected_components(simhash.links(nodes)).collect()}
    signed = fps.view(np.int64).tolist()
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    expected = brute_components(signed, near)
    assert {x: roots.get(x, x) for x in signed} == expected
