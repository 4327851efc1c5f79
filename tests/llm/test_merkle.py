"""The Merkle manifest against plain Python, its appended trees, odd rows."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from conftest_llm import SMALL
from pyspark.sql import functions as F

from textpipe.llm import merkle
from textpipe.llm.merkle import Appended, folded, manifest
from textpipe.llm.queries import QUERIES


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[int, str] | None]]]:
    """The root, and for each leaf its sibling on every level with its side."""
    owners = [[k] for k in range(len(nodes))]
    paths: list[list] = [[] for _ in nodes]
    while len(nodes) > 1:
        up, above = [], []
        for k in range(0, len(nodes), 2):
            run = nodes[k : k + 2]
            for side in range(len(run)):
                sibling = (1 - side, run[1 - side]) if len(run) == 2 else None
                for i in owners[k + side]:
                    paths[i].append(sibling)
            up.append(h(*run))
            above.append([i for o in owners[k : k + 2] for i in o])
        nodes, owners = up, above
    return nodes[0], paths


def brute(rows: list[tuple]) -> list[tuple]:
    """``rows``: doc_id, source, lang, n_chars, text. What the query gives for each."""
    by_lang: dict = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    held = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        held[lang] = tree([leaf(r) for r in by_lang[lang]])
    root, upper = tree([held[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, upper):
        subroot, paths = held[lang]
        for row, path in zip(by_lang[lang], paths):
            siblings = [s for s in path + above if s]
            shown = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                shown[3] += 1
            node = leaf(shown)
            for s in path + above:
                node = h(node) if s is None else h(s[1], node) if s[0] == 0 else h(node, s[1])
            out.append((row[0], leaf(row), subroot, root, h(*[s[1] for s in siblings]), node, node == root))
    return sorted(out, key=repr)


def got_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def shown():
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    return {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def test_query(spark):
    rows = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op11_merkle"](spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got_of(got) == brute(rows)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_blocks_and_many_groups(spark, bits):
    rng = random.Random(bits)
    langs = [None, "", "é", "zz", "a", *[f"l{k}" for k in range(14)]]
    rows = [
        (k, rng.choice([None, "s"]), rng.choice(langs + ["hot"] * 30), rng.choice([None, 5]), rng.choice(["", None, "text é"]))
        for k in rng.sample(range(10_000), 300)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert got_of(manifest(docs, shown=shown(), bits=bits)) == brute(rows)


@pytest.mark.parametrize("n", range(1, 35))
def test_append(n):
    leaves = [sha256(str(k).encode()).digest() for k in range(n)]
    appended = Appended()
    for x in leaves:
        appended.append(x)
    levels = (n - 1).bit_length()
    built = appended.closed(levels)
    root, paths = tree([x.hex() for x in leaves])
    assert built.root.hex() == root
    assert [[s and s[1] for s in p] for p in paths] == [[s and s.hex() for s in w] for w in built.witnesses]
    assert all(folded(x, k, w) == built.root for k, (x, w) in enumerate(zip(leaves, built.witnesses)))
    # At another place it is not the root, unless the leaf has no sibling there.
    paired = [(k, x, w) for k, (x, w) in enumerate(zip(leaves, built.witnesses)) if w and w[0]]
    assert all(folded(x, k ^ 1, w) != built.root for k, x, w in paired)


def test_levels(spark):
    got = spark.range(1, 70).select("id", merkle._levels(F.col("id")).alias("levels")).collect()
    assert all(r.levels == (r.id - 1).bit_length() for r in got)


def test_odd_rows(spark, odd):
    rows = [tuple(r[c] for c in COLUMNS) for r in odd.collect()]
    assert got_of(manifest(odd, shown=shown(), bits=2)) == brute(rows)
    assert manifest(odd.limit(0)).count() == 0
    one = odd.filter("doc_id = 5")
    assert got_of(manifest(one, shown=shown())) == brute([tuple(r[c] for c in COLUMNS) for r in one.collect()])


def test_one_group_of_equal_rows(spark):
    """Rows that agree in all fields, as many as the others."""
    docs = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), F.lit("x").alias("lang")
    )
    got = manifest(docs, fields=("doc_id", "text"))
    assert got.count() == 1000 and got.filter("not verified").count() == 0
    assert got.select("root").distinct().count() == 1
