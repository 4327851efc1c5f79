"""Quality rules: counts against plain Python, learned lists, odd rows."""

from __future__ import annotations

import re
import unicodedata

from conftest_llm import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textpipe.llm import quality_rules
from textpipe.llm.quality_rules import Condition, Learning, learn, statistics, text_counts, verdict
from textpipe.llm.queries import QUERIES
from textpipe.llm.toxicity import trained_on

MEDIUM = "/root/testdata/sf0.1"


def plain_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows: dict[tuple, list[int]] = {}
    for k in range(len(words) - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + i for at in windows.values() if len(at) > 1 for k in at for i in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_query_against_plain_python(spark):
    got = QUERIES["op4_quality_rules"](spark, SF)
    assert got.columns == ["doc_id", *quality_rules.BASE, "base_failed", "kept"]
    assert {t for c, t in got.dtypes if c in quality_rules.BASE} == {"bigint"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = plain_counts(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.BASE) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_odd_texts(spark):
    texts = ["", " ", None, "a", "a a a", "a a a a", "a b c a b c", "a b c d a b c\n\na b c", "x\x0by\x0cz\r\n",
             "\u00a0 \u2003", "a\n a\na\n\n\n", "😀😀 é#*$%&|<>", "A1 B2 C3 " * 40, "\n".join(["same line"] * 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in text_counts(docs).collect()}
    assert got == {k: plain_counts(t) for k, t in enumerate(texts)}


def test_random_texts(spark):
    drawn = []

    @settings(max_examples=150, deadline=None, database=None)
    @given(st.text("ab \n\t#", max_size=60))
    def draw(text):
        drawn.append(text)

    draw()
    docs = spark.createDataFrame(list(enumerate(drawn)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in text_counts(docs).collect()}
    assert got == {k: plain_counts(t) for k, t in enumerate(drawn)}


# Different windows of each meet in 36 bits of the hash, one between two equal ones.
MEETING = [
    "a357190 b357190 c357190 x1 a594392 b594392 c594392 x2 a357190 b357190 c357190",
    "a357190 b357190 c357190 x1 a594392 b594392 c594392 x2 a594392 b594392 c594392",
    "a594392 b594392 c594392 a357190 b357190 c357190 a594392 b594392 c594392 a357190 b357190 c357190",
]


def test_windows_that_meet_in_the_hash(spark):
    docs = spark.createDataFrame(list(enumerate(MEETING)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_repeat_words for r in text_counts(docs).collect()}
    assert got[0] == got[1] == 6
    assert got == {k: plain_counts(t)[4] for k, t in enumerate(MEETING)}


def test_few_bits_of_the_hash(spark):
    import random

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [" ".join(str(rng.randrange(40)) for _ in range(300)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for bits in (1, 3, 8, 36):
        got = {r.doc_id: tuple(r[c] for c in quality_rules.BASE) for r in text_counts(docs, bits).collect()}
        assert got == {k: plain_counts(t) for k, t in enumerate(texts)}, bits


def test_verdicts_from_the_learned_list(spark):
    """``kept`` of every document, worked out in plain Python from the texts and the rules."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    _, rules = quality_rules.learned(docs, labels, trained_on())
    assert rules
    kept = {r.doc_id: r.kept for r in QUERIES["op4_quality_rules"](spark, SF).collect()}
    for r in docs.collect():
        words, chars, symbols, dup, repeats = plain_counts(r.text)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (r.text or "").split("\n"))
        capitals = sum(unicodedata.category(c) == "Lu" for c in r.text or "")
        n = max(words, 1)
        values = {
            "words": words, "word_length": chars / n, "symbols": symbols / n,
            "capitals": capitals / max(chars, 1), "line_repeats": dup / max(lines, 1), "repeats": repeats / n,
        }
        caught = any(
            all((values[c.statistic] > c.threshold) == c.above for c in rule) for rule in rules
        )
        assert kept[r.doc_id] == (not (words < 50 or 2 * repeats > words) and not caught), r.doc_id


def _labelled(spark, rule):
    names = list(statistics())
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1000)) / 1000).alias(n) for n in names],
    )
    return rows.withColumn("bad", F.expr(rule))


def test_learns_a_planted_list(spark):
    rows = _labelled(spark, "(symbols > 0.8 and repeats <= 0.5) or capitals > 0.9")
    rules = learn(rows)
    assert 2 <= len(rules) <= 5
    assert {c.statistic for r in rules for c in r} == {"symbols", "repeats", "capitals"}
    judged = rows.withColumn("kept", verdict(rules))
    wrong = judged.filter(F.col("kept") == F.col("bad")).count()
    assert wrong < 100
    # The first rule that holds decides; the list is one conditional expression.
    assert str(verdict(rules)).count("CASE WHEN") == 1 or "WHEN" in str(verdict(rules))


def test_noise_gives_no_rules(spark):
    rows = _labelled(spark, "pmod(xxhash64(doc_id, 5), 10) = 0")
    assert learn(rows) == []


def test_pruning_drops_what_does_not_hold(spark):
    rows = _labelled(spark, "symbols > 0.9")
    rule = (Condition("symbols", True, 0.9), Condition("words", True, 0.5))
    assert quality_rules._prune(rows, rule, Learning())[0] == rule[0]
    assert quality_rules._prune(rows, (Condition("words", True, 0.5),), Learning()) == ()


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    frame = QUERIES["op4_quality_rules"](spark, MEDIUM).join(labels, "doc_id").toPandas()
    import zlib

    frame = frame[~frame.base_failed]
    held = frame[[zlib.crc32(str(i).encode()) % 5 == 0 for i in frame.doc_id]]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.1


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (6, None), (None, 1)], "doc_id bigint, quality int")
    got = quality_rules.judged(odd, labels).collect()
    assert len(got) == odd.count()
    assert {r.kept for r in got if r.n_words == 0} == {False}
    # Without labels there are no rules beyond the base, which the short and the repeated fail.
    unlabelled = quality_rules.judged(odd, labels.limit(0))
    assert unlabelled.filter("kept = base_failed").count() == 0
    assert quality_rules.judged(odd.limit(0), labels).count() == 0
