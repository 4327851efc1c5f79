"""Quality rules: a decision list learned from labelled statistics by sequential covering.

Each rule is a conjunction of thresholds on text statistics, such as ``symbols > 0.31 and
repeats <= 0.2``. It is grown on two thirds of the labelled rows, condition by condition, by
information gain over the rows that no earlier rule has caught; pruned on the other third; and kept
only if it is precise there. The list becomes one ordered conditional expression.

Learning reads a written table of numbers. A step is one aggregation: rows are sorted into the
bins between candidate thresholds, and what comes to the driver are two counts for each bin.
Everything is made of DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpipe.llm.common import WHITE_SPACE, materialize

SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
_POSITION = (1 << 28) - 1
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Learning:
    """``bins`` thresholds for each statistic and class; a rule needs ``support`` rows to prune
    on and ``precision`` there."""

    bins: int = 32
    rules: int = 12
    conditions: int = 4
    support: int = 5
    precision: float = 0.8


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def statistics() -> dict[str, Column]:
    """What rules may speak of, from the counts of ``text_counts``. No words: zeros."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "capitals": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "line_repeats": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
    }


def _place(key: Column) -> Column:
    return key.bitwiseAND(F.lit(_POSITION).cast("bigint"))


def _windows(words: Column, hash_bits: int) -> Column:
    """Sorted numbers, one for each window of three words: bits of its hash, then its place."""
    high = F.lit(-(1 << (64 - hash_bits))).cast("bigint")

    def key(i: Column) -> Column:
        hashed = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return hashed.bitwiseAND(high).bitwiseOR(_place(i.cast("bigint")))

    some = F.transform(F.sequence(F.lit(0), F.size(words) - 3), key)
    return F.when(F.size(words) >= 3, F.sort_array(some)).otherwise(F.array().cast("array<bigint>"))


def _same_hash(x: Column, y: Column) -> Column:
    return F.coalesce(F.shiftright(x, 28) == F.shiftright(y, 28), F.lit(False))


def _shared(keys: Column) -> Column:
    """The sorted keys whose bits of the hash another key has; equal ones stay side by side."""
    return F.filter(keys, lambda x, at: _same_hash(x, F.get(keys, at - 1)) | _same_hash(x, F.get(keys, at + 1)))


def _repeated(shared: Column, words: Column) -> Column:
    """Places of the windows whose three words another window has.

    Where neighbours with equal bits have equal words all along, each run of equal bits is one
    window. Where they have not, two windows have met in a hash, and the words themselves are sorted.
    """

    def window(x: Column) -> Column:
        i = _place(x).cast("int")
        return F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)])

    def differs(x: Column, at: Column) -> Column:
        before = F.get(shared, at - 1)
        return F.when(_same_hash(x, before), window(x) != window(before)).otherwise(False)

    spelled = F.sort_array(F.transform(shared, lambda x: F.struct(window(x).alias("w"), _place(x).alias("at"))))

    def met(x: Column, at: Column, every: Column) -> Column:
        return F.coalesce(x["w"] == F.get(every, at - 1)["w"], F.lit(False)) | F.coalesce(
            x["w"] == F.get(every, at + 1)["w"], F.lit(False)
        )

    # An array of one keeps the sorted windows from being made again for each of them.
    exact = F.transform(
        F.array(spelled), lambda every: F.filter(every, lambda x, at: met(x, at, every))["at"]
    )[0]
    collided = F.exists(F.transform(shared, differs), lambda x: x)
    return F.sort_array(F.when(collided, exact).otherwise(F.transform(shared, _place)))


def text_counts(docs: DataFrame, hash_bits: int = 36) -> DataFrame:
    """``doc_id`` and counts of each whole text (null: empty), as long numbers.

    Words are runs without ASCII white space; ``word_chars`` their characters; ``n_symbols`` the
    characters that are one of ``#*$%&|<>``; ``n_lines`` the lines with a word and ``n_dup_lines``
    those that equal an earlier one; ``n_repeat_words`` the words within windows of three words
    that the text has twice or more; ``n_capitals`` the upper-case letters. ``hash_bits`` (36 at
    most) of a window's hash are compared before its words; the counts do not depend on them.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{WHITE_SPACE}+"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    # Each step is a projection of its own, so that no array is made twice.
    cut = text.select("doc_id", "text", words.alias("words"), lines.alias("lines"))
    keyed = cut.withColumn("keys", _windows(F.col("words"), hash_bits))
    shared = keyed.withColumn("shared", _shared(F.col("keys")))
    placed = shared.withColumn("at", _repeated(F.col("shared"), F.col("words")))
    # A repeated window covers three words, or fewer if the next one begins within them.
    covered = F.transform("at", lambda x, i: F.coalesce(F.least(F.lit(3), F.get("at", i + 1) - x), F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return placed.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        total.alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
    )


def base_failed() -> Column:
    """The fixed rules: too short, or more than half repeated."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _thresholds(rows: DataFrame, names: list[str], bins: int) -> dict[str, list[float]]:
    """Quantiles of each statistic within both classes."""
    steps = [k / bins for k in range(1, bins)]
    found = rows.groupBy("bad").agg(
        *[F.percentile_approx(n, steps, 10_000).alias(n) for n in names]
    )
    cuts: dict[str, set[float]] = {n: set() for n in names}
    for row in found.collect():
        for n in names:
            cuts[n].update(row[n] or [])
    return {n: sorted(c) for n, c in cuts.items()}


def _bin(name: str, cuts: list[float]) -> Column:
    """How many of the thresholds the value is above."""
    return F.size(F.filter(F.lit(cuts), lambda t: F.col(name) > t)) if cuts else F.lit(0)


def _all(rule: Rule) -> Column:
    held = F.lit(True)
    for condition in rule:
        held = held & condition.holds()
    return held


def _grow(rows: DataFrame, cuts: dict[str, list[float]], how: Learning) -> Rule:
    """Add the condition that gains most, until nothing is gained or no good row is left."""
    rule: Rule = ()
    codes = [F.struct(F.lit(k).alias("statistic"), F.col(f"{n}_bin").alias("bin")) for k, n in enumerate(cuts)]
    names = list(cuts)
    while len(rule) < how.conditions:
        counts = (
            rows.filter(_all(rule))
            .select("bad", F.explode(F.array(*codes)).alias("code"))
            .groupBy("code.statistic", "code.bin")
            .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n"))
            .collect()
        )
        tables: dict[int, dict[int, tuple[int, int]]] = {}
        for r in counts:
            tables.setdefault(r.statistic, {})[r.bin] = (r.p, r.n)
        p_all, n_all = (sum(c[k] for c in tables.get(0, {}).values()) for k in (0, 1))
        if not p_all or not n_all:
            break
        before = log2(p_all / (p_all + n_all))
        best, chosen = 0.0, None
        for k, name in enumerate(names):
            p, n = 0, 0
            for cut, threshold in enumerate(cuts[name]):
                # Bin b holds the values above b thresholds.
                more_p, more_n = tables.get(k, {}).get(cut, (0, 0))
                p, n = p + more_p, n + more_n
                for above, a, b in ((False, p, n), (True, p_all - p, n_all - n)):
                    gain = a * (log2(a / (a + b)) - before) if a >= how.support else 0.0
                    if gain > best + 1e-9:
                        best, chosen = gain, Condition(name, above, threshold)
        if chosen is None:
            break
        rule += (chosen,)
    return rule


def _prune(rows: DataFrame, rule: Rule, how: Learning) -> Rule:
    """The beginning of the rule that is best on rows it was not grown on; nothing if none is."""
    parts = [rule[: k + 1] for k in range(len(rule))]
    sums = []
    for k, part in enumerate(parts):
        held = _all(part)
        sums += [F.count_if(held & F.col("bad")).alias(f"p{k}"), F.count_if(held & ~F.col("bad")).alias(f"n{k}")]
    found = rows.agg(*sums).first()
    best, kept = 0.0, ()
    for k, part in enumerate(parts):
        p, n = found[f"p{k}"], found[f"n{k}"]
        precision = p / (p + n) if p >= how.support else 0.0
        worth = (p - n) / (p + n) if precision >= how.precision else 0.0
        if worth > best:
            best, kept = worth, part
    return kept


def learn(labelled: DataFrame, how: Learning = Learning()) -> list[Rule]:
    """Rules that find the rows with ``bad``, in the order in which they were learned.

    ``labelled`` has ``doc_id``, ``bad`` (boolean) and the columns of ``statistics``. Without rows
    of both classes there are no rules.
    """
    names = list(statistics())
    cuts = _thresholds(labelled, names, how.bins)
    binned = labelled.withColumns({f"{n}_bin": _bin(n, c) for n, c in cuts.items()}).withColumn(
        "prune", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    )
    rows = materialize(binned, "labelled")
    rules: list[Rule] = []
    while len(rules) < how.rules:
        left = rows
        for rule in rules:
            left = left.filter(~_all(rule))
        rule = _grow(left.filter("not prune"), cuts, how)
        rule = _prune(left.filter("prune"), rule, how) if rule else ()
        if not rule:
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False by the first rule that holds, true if none does."""
    if not rules:
        return F.lit(True)
    found = F.when(_all(rules[0]), False)
    for rule in rules[1:]:
        found = found.when(_all(rule), False)
    return found.otherwise(True)


def learned(
    docs: DataFrame, labels: DataFrame, used: Column | None = None, how: Learning = Learning()
) -> tuple[DataFrame, list[Rule]]:
    """The written counts and statistics of each document, and the decision list."""
    counts = materialize(text_counts(docs).withColumns(statistics()), "counts")
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(
        (F.min("quality") == 0).alias("bad")
    )
    labelled = counts.join(known if used is None else known.filter(used), "doc_id")
    # What fails the base is gone in any case: the rules are for the others.
    return counts, learn(labelled.filter(~base_failed()), how)


def judged(docs: DataFrame, labels: DataFrame, used: Column | None = None, how: Learning = Learning()) -> DataFrame:
    """Counts and statistics of each document, ``base_failed`` and ``kept``.

    Rules are learned from the rows of ``docs`` whose id has a label ``quality`` of 0 or 1 in
    ``labels``, and for which ``used`` (of ``doc_id``) holds where it is given. An id with both
    labels counts as bad. Null texts are empty, and empty texts fail the base; repeated rows are
    judged each; null ids are judged but not learned from. An empty table gives no rows.
    """
    counts, rules = learned(docs, labels, used, how)
    return counts.select("*", base_failed().alias("base_failed")).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules))
    )
