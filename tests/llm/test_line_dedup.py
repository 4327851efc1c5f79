"""Line deduplication: the edit join against brute force, the banded distance, odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from textpipe.llm import line_dedup
from textpipe.llm.line_dedup import Rule


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(text: str, n: int, rng: random.Random) -> str:
    letters = list(text)
    for _ in range(n):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("abcé😀")
        elif kind == 1 and len(letters) > 1:
            del letters[at]
        else:
            letters.insert(at, rng.choice("abcé😀"))
    return "".join(letters)


@pytest.mark.parametrize("band", [1, 2, 3])
def test_banded_distance(spark, band):
    rng = random.Random(band)
    rows = []
    while len(rows) < 300:
        a = "".join(rng.choice("abé😀") for _ in range(rng.randrange(1, 30)))
        b = edited(a, rng.randrange(0, band + 3), rng)
        if abs(len(a) - len(b)) <= band and a and b:
            short, long = sorted((a, b), key=len)
            rows.append((short, long))
    df = spark.createDataFrame(rows, "a string, b string")
    letters = [F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)) for c in ("a", "b")]
    got = df.select("a", "b", line_dedup.banded_distance(*letters, band).alias("d")).collect()
    for r in got:
        expected = distance(r.a, r.b)
        assert r.d == expected if expected <= band else r.d > band, (r, expected)


def brute(lines: dict[tuple, str], rule: Rule) -> dict[tuple, tuple]:
    """First place, number of near lines and verdict of each line, all pairs compared."""
    classes: dict[str, tuple] = {}
    for place in sorted(lines):
        classes.setdefault(lines[place], place)
    out = {}
    for place, line in lines.items():
        near = [
            p for o, p in classes.items()
            if o != line and abs(len(o) - len(line)) <= rule.max_edits
            and distance(o, line) <= min(rule.max_edits, min(len(o), len(line)) // rule.per_edit)
        ]
        kept = classes[line] == place and all(p > place for p in near)
        out[place] = (classes[line], len(near), kept)
    return out


@pytest.mark.parametrize("rule, crowd", [(Rule(1, 8), 512), (Rule(2, 8), 512), (Rule(2, 8), 9), (Rule(3, 5), 20), (Rule(), 3)])
def test_edit_join(spark, rule, crowd, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 7)
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    rng = random.Random(rule.max_edits)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(2, 40))) for _ in range(14)]
    lines = [edited(rng.choice(base), rng.randrange(0, 4), rng) for _ in range(300)]
    docs, held = [], {}
    for d in range(40):
        text = [lines[(d * 7 + k) % len(lines)] for k in range(7)]
        docs.append((d, "\n".join(text)))
        held |= {(d, k): x for k, x in enumerate("\n".join(text).split("\n")) if x.strip()}
    got = line_dedup.decide(spark.createDataFrame(docs, "doc_id bigint, text string"), rule).collect()
    found = {(r.doc_id, r.pos): ((r.first.doc_id, r.first.pos), r.n_links, r.kept) for r in got}
    assert found == brute(held, rule)
    assert sum(n for _, n, _ in found.values()) > 50


def test_clean(spark, odd):
    rows = [
        (3, "the first line of the page\nshort\nshirt\nand another line of text here"),
        (1, "the first line of the page\nsome other line that stays\nshort"),
        (2, "the first line of te page\r\nand another line of text here.\n\nshort"),
        (None, "some other line that stays\nonly without an id it comes"),
        (4, None),
        (5, ""),
    ]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, pos int, a int")
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert got[1] == rows[1][1]
    # Short lines go where they are equal.
    assert got[2] == "and another line of text here.\n"
    assert got[3] == "shirt"
    assert got[None] == "only without an id it comes"
    assert got[4] is None and got[5] == ""
    kept = line_dedup.clean(odd)
    assert kept.count() == odd.count() and kept.columns == odd.columns
    assert {r.text for r in kept.filter("doc_id = 1").collect()} == {
        r.text for r in odd.filter("doc_id = 1").collect()
    }
    assert [r.text for r in kept.filter("doc_id = 7").collect()] == [""]
    assert line_dedup.clean(odd.limit(0)).count() == line_dedup.decide(odd.limit(0)).count() == 0


def test_repeated_short_lines(spark):
    docs = spark.createDataFrame([(k, "Read more\n \n- 1 -\nown %d" % k) for k in range(3)], "doc_id int, text string")
    got = {r.doc_id: r.text for r in line_dedup.clean(docs).collect()}
    assert got == {0: "Read more\n \n- 1 -\nown 0", 1: " \nown 1", 2: " \nown 2"}


def test_many_lines_of_one_template(spark):
    """All lines share their segments but for one word; each is near to the next one alone."""
    rng = random.Random(1)
    words = {"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(2500)}
    lines = [f"The article with the title {w} has been moved to the archive" for w in sorted(words)]
    near = [x.replace(" has", "s has") for x in lines[:100]]
    docs = [(k, x) for k, x in enumerate([*lines, *near])]
    got = line_dedup.decide(spark.createDataFrame(docs, "doc_id int, text string"))
    n = len(lines)
    links = {r.doc_id: r.n_links for r in got.collect()}
    assert links == {k: int(k < 100 or k >= n) for k in range(n + 100)}
    assert {r.doc_id for r in got.filter("not kept").collect()} == set(range(n, n + 100))


def test_no_python_in_the_plan(spark, documents):
    for df in (line_dedup.decide(documents), line_dedup.clean(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_parts_are_cut_from_the_lines_that_need_them(spark):
    """Keys of a line, cut in Python; no part is cut from the line itself, whatever its length."""
    rows = [("x" * 3 + "abcdefghijklmnopqrstuvwxyz"[:n],) for n in (0, 5, 7, 8, 9, 14, 17, 18, 19, 26)] + [("é😀" * 13,)]
    keyed = line_dedup.with_keys(spark.createDataFrame(rows, "line string"), Rule())
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert "substr(text" in plan and "substr(line" not in plan

    def cut(line: str) -> set[tuple]:
        found = set()
        for shorter in range(3):
            other = len(line) - shorter
            edits = min(2, other // 10)
            n = edits + 1
            if edits < max(1, shorter):
                continue
            ends = [0]
            for k in range(n):
                ends.append(ends[-1] + other // n + (k >= n - other % n))
            for k in range(n):
                for shift in range(max(-k, shorter - (n - 1 - k)), min(k, shorter + (n - 1 - k)) + 1):
                    found.add((other, k, line[ends[k] + shift : ends[k + 1] + shift]))
        return found

    expected = [(line, *part) for (line,) in rows for part in cut(line)]
    hashed = spark.createDataFrame(expected, "line string, other int, k int, part string").select(
        "line", F.xxhash64("other", "k", "part").alias("key")
    )
    want = {(r.line, r.key) for r in hashed.collect()}
    assert {(r.line, k) for r in keyed.collect() for k in r["keys"]} == want and len(want) > 60
