"""Spans of sentences: the cut against a plain one, removal against brute force, odd rows."""

from __future__ import annotations

import random
import re

from conftest_llm import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textpipe.llm import substring_dedup
from textpipe.llm.queries import QUERIES
from textpipe.llm.substring_dedup import Spans, runs, sentences


def plain_sentences(text: str, how: Spans = Spans()) -> list[str]:
    """Sentences of a text whose long ones are not cut."""
    if not text.split():
        return []
    lead = len(text) - len(text.lstrip())
    parts = re.split(r"((?<=[.!?])\s+|\s*\n\s*)", text[lead:])
    joined = ["".join(parts[k : k + 2]) for k in range(0, len(parts), 2)]
    joined[0] = text[:lead] + joined[0]
    return [p for p in joined if p]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab.! \n\té😀", max_size=40), min_size=1, max_size=4))
def test_sentences_are_the_text(texts):
    s = sentences(texts, Spans(longest=1000))
    for k, text in enumerate(texts):
        mine = s.owner == k
        parts = [text[a:b] for a, b in zip(s.begin[mine], s.end[mine])]
        assert parts == plain_sentences(text)
        assert [len(p.split()) for p in parts] == s.words[mine].tolist()


def test_long_sentences_are_cut_alike_everywhere():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(80)]
    passage = " ".join(words)
    one, two = runs([f"Some words before {passage} and after"])[2], runs([f"{passage}. Another. End"])[2]
    assert len(set(one.tolist()) & set(two.tolist())) >= 4


def test_passages_are_found_in_differing_contexts(spark):
    """Passages of 51 words inside other text share a run; also with few different words."""
    rng = random.Random(4)
    prose = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    prose = [t.split() for t in prose if len(t.split()) > 120]
    few = [[rng.choice("abcdefghijkl") * 2 for _ in range(120)] for _ in range(200)]
    periodic = [(["ab", "cd", "ef"][: 1 + k % 3] * 120)[:120] for k in range(6)]
    for texts in (prose, few, periodic):
        missed = 0
        for _ in range(1500):
            words, other, third = (rng.choice(texts) for _ in range(3))
            at = rng.randrange(len(words) - 51)
            passage = words[at : at + 51]
            contexts = [" ".join([*c[:n], *passage, *c[n : n + 30]]) for c, n in ((other, rng.randrange(30)), (third, rng.randrange(30)))]
            # Runs of the passage itself, so that what the contexts share does not count.
            inside = set(runs([" ".join(passage)])[2].tolist())
            missed += not inside.intersection(*(runs([c])[2].tolist() for c in contexts))
        assert missed == 0, missed
    s = sentences([" ".join(w) for w in prose + few])
    assert s.words.max() <= Spans().within + 3


def test_case_and_space_do_not_matter():
    a, b = (runs([t], Spans(least=1))[2].tolist() for t in ("A b c. D e.  F g.", "a B c. d e.\nf  G."))
    assert a == b and len(a) == 1


def brute(texts: dict[int, str], how: Spans) -> dict[int, str]:
    seen, out = set(), {}
    for i in sorted(texts):
        s = sentences([texts[i]], how)
        parts = [texts[i][a:b] for a, b in zip(s.begin, s.end)]
        gone = set()
        words = [tuple(p.lower().split()) for p in parts]
        for k in range(len(parts)):
            end = k + how.span
            while sum(map(len, words[k:end])) < how.least and end < len(parts):
                end += 1
            if sum(map(len, words[k:end])) < how.least or (end > len(parts) and k):
                continue
            # Sentences are compared one by one, as they are hashed.
            run = tuple(words[k:end])
            if run in seen:
                gone |= set(range(k, min(end, len(parts))))
            seen.add(run)
        out[i] = "".join(p for k, p in enumerate(parts) if k not in gone) if parts else texts[i]
    return out


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: r.text for r in got} == brute(docs, Spans())
    changed = [r for r in got if r.n_removed]
    assert 20 < len(changed) < 500
    for r in got:
        text, done, left = docs[r.doc_id], 0, []
        for a, b in r.removed:
            left.append(text[done:a])
            done = b
        assert "".join([*left, text[done:]]) == r.text


def test_short_sentences(spark):
    """Passages of sentences with one or two words, which three sentences do not make long enough."""
    steps = "Go on. Stop. Turn left. Wait. Look up. Breathe. Sit. Stand up. Run. Walk. Jump high. Rest."
    docs = [(1, f"One text begins here. {steps} Then it goes on."), (2, f"Another one starts. {steps} It ends otherwise.")]
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(spark.createDataFrame(docs, "doc_id int, text string")).collect()}
    # A run that has ten words only with what follows the passage is not the same in both.
    assert got == {1: docs[0][1], 2: "Another one starts. Rest. It ends otherwise."}
    assert got == brute(dict(docs), Spans())


def test_text_ids(spark, odd):
    named = odd.withColumn("doc_id", F.concat(F.lit("id "), F.col("doc_id").cast("string")))
    by_number = {r.doc_id: r.text for r in substring_dedup.deduplicate(odd, Spans(least=3)).filter("doc_id > 1").collect()}
    by_text = {r.doc_id: r.text for r in substring_dedup.deduplicate(named, Spans(least=3)).collect()}
    assert {f"id {i}": t for i, t in by_number.items()}.items() <= by_text.items()


def test_odd_rows(spark, odd):
    got = substring_dedup.deduplicate(odd, Spans(least=3))
    assert got.columns == [*odd.columns, "n_sentences", "n_removed", "removed"]
    rows = got.collect()
    assert len(rows) == odd.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r.text)
    assert of[2] == [None] and of[3] == [""] and of[4] == [" \t\n "] and None in of[None]
    # Row 1 comes twice and is one document; 7 is its copy. 6 shares its beginning with 5.
    assert sorted(of[1]) == sorted(r.text for r in odd.filter("doc_id = 1").collect())
    assert of[7] == [""]
    assert len(of[6][0]) < 200 < len(of[5][0])
    clash = odd.withColumn("removed", F.lit(1)).withColumn("At", F.lit(2))
    assert substring_dedup.deduplicate(clash).columns[-1] == "_removed"
    assert substring_dedup.deduplicate(odd.limit(0)).count() == 0
