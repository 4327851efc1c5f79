"""Line deduplication with a segment-partition edit join.

Two lines at most ``max_edits`` edits apart share a segment: of ``max_edits + 1`` segments of the
shorter line, each edit spoils one at most, and the others occur in the longer line near the place
where they are in the shorter. Every line is indexed by its own segments and probes the segments of
lines that are as long or shorter by up to ``max_edits`` characters, at the places that the number
of edits to the left and to the right still allows. Key and length meet in one hash, so all of this
is one table of numbers, dealt by hash and sorted; equal lines are one before it is made.

Short lines are allowed fewer edits, and have fewer and longer segments; of the shortest only equal
ones are found.

Only lines that share a key with another line go on. Where very many share one, as the lines of a
template do, they meet under finer keys: an edit changes at most two of the bits that say which
characters a line has an odd number of times, so two of enough blocks of these bits are the same in
both lines. The lines of a key are cut into tiles, and tiles are compared two by two inside a row: what
leaves a tile pair is a count for each line, never a row for each pair. A pair that meets under
several keys is looked at under its smallest one. The odd characters tell most pairs apart, and the
survivors are verified by a banded bit-parallel edit distance, which keeps one diagonal band of the
matrix in the bits of a number.

Everything is made of DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpipe.llm.common import documents_of, free_names, materialize, text_key

TILE = 128
# Lines of one key from which on they meet under finer keys.
CROWD = 512
# Eight to sixteen bytes a row: up to 32 MB are broadcast, more is joined by shuffle.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Near lines are at most ``max_edits`` edits apart, and one for every ``per_edit`` characters
    of the shorter."""

    max_edits: int = 2
    per_edit: int = 10

    def allowed(self, length: Column) -> Column:
        """The edits that a shorter line of this length is allowed."""
        return F.least(F.lit(self.max_edits), F.floor(length / self.per_edit).cast("int"))


def lines_of(docs: DataFrame) -> DataFrame:
    """The lines that take part: ``doc_id, text_key, pos, line`` and two numbers of the line."""
    rows = documents_of(docs).select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    return rows.filter(F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "").withColumns(
        {"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(1), "line")}
    )


def _place() -> Column:
    """Documents in the order of their ids, without an id last; lines in their order."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "pos")


def _segment(length: Column, n: int, k: int) -> tuple[Column, Column]:
    """Place (from 1) and length of segment ``k`` (from 0) of ``n``; the last ones are longer."""
    base, longer = F.floor(length / n).cast("int"), F.pmod(length, F.lit(n))
    begin = base * k + F.greatest(F.lit(0), F.lit(k - n) + longer) + 1
    return begin, base + F.when(F.lit(k) >= F.lit(n) - longer, 1).otherwise(0)


def with_keys(lines: DataFrame, rule: Rule) -> DataFrame:
    """``lines`` with ``size``, their length, and ``keys``: those under which a line is indexed and
    those that it probes.

    A key is that of a segment of a shorter line with one segment more than the edits that this
    one is allowed.
    """
    parts, chosen, texts = {}, [], {}
    for edits in range(1, rule.max_edits + 1):
        # Parts that are not chosen are cut from nothing: most lines are long, and need one kind only.
        needed = [rule.allowed(F.col("size") - shorter) == edits for shorter in range(edits + 1)]
        texts[f"text{edits}"] = F.when(reduce(or_, needed), F.col("line")).otherwise("")
    for shorter in range(rule.max_edits + 1):
        other = F.col("size") - shorter
        for edits in range(max(1, shorter), rule.max_edits + 1):
            n, keys = edits + 1, []
            for k in range(n):
                begin, size = _segment(other, n, k)
                low = max(-k, shorter - (n - 1 - k))
                high = min(k, shorter + (n - 1 - k))
                for shift in range(low, high + 1):
                    text = F.substr(F.col(f"text{edits}"), begin + shift, size)
                    keys.append(F.xxhash64(other, F.lit(k), text))
            name = f"part{len(parts)}"
            parts[name] = F.array(*keys)
            # Keys are made for all lines in a projection before, where what they have in common is
            # worked out once; naming a part twice keeps it there.
            fits = rule.allowed(other) == edits
            chosen.append(F.when(fits, F.col(name)).otherwise(F.slice(name, 1, 0)))
    sized = lines.select("*", F.char_length("line").alias("size"))
    cut = sized.withColumns(texts).withColumns(parts)
    return cut.withColumn("keys", F.array_distinct(F.concat(*chosen))).drop(*texts, *parts)


def _blocks(max_edits: int) -> list[int]:
    """Masks of so many blocks of bits that ``max_edits`` edits leave two of them as they are."""
    n = 2 * max_edits + 2
    cuts = [64 * k // n for k in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def _masks(max_edits: int) -> list[Column]:
    """For each pair of blocks the bits of both."""
    pairs = (a | b for a, b in combinations(_blocks(max_edits), 2))
    return [F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in pairs]


def parity(line: Column) -> Column:
    """A bit for each kind of character that occurs an odd number of times.

    An edit takes away one character, adds one, or both, so it changes two bits at most.
    """
    one = F.lit(1).cast("bigint")

    def flip(bits: Column, c: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(F.hash(c), F.lit(64))))

    return F.aggregate(_characters(line), F.lit(0).cast("bigint"), flip)


def _characters(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit("(?s)."), F.lit(0))


def banded_distance(short: Column, long: Column, band: int) -> Column:
    """Edit distance of two arrays of characters whose lengths differ by ``band`` at most.

    Exact up to ``band``, and more than ``band`` where the distance is. Bit ``k`` at column ``j``
    stands for row ``j - band + k``; the window moves one row down with every column. The distance
    is followed along the lowest diagonal of the band and then along the last row.
    """
    width = (1 << (2 * band + 1)) - 1
    m, n = F.size(short), F.size(long)

    def step(state: Column, j: Column) -> Column:
        vp, vn = state["vp"], state["vn"]
        here = F.get(long, j - 1)
        equal = F.lit(0).cast("bigint")
        for k in range(2 * band + 1):
            same = F.get(short, j - 1 - band + k) == here
            equal = equal + F.when(same, F.lit(1 << k)).otherwise(0)
        d0 = F.transform(
            F.array(equal),
            lambda e: ((e.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(e).bitwiseOR(vn).bitwiseAND(F.lit(width).cast("bigint")),
        )

        def after(d: Column) -> Column:
            full = F.lit(width).cast("bigint")
            hp = vn.bitwiseOR(full.bitwiseXOR(d.bitwiseOR(vp)))
            hn = d.bitwiseAND(vp)
            down = F.shiftright(d, 1)
            row = m - j + band
            lowest = F.when(d.bitwiseAND(F.lit(1 << (2 * band)).cast("bigint")) == 0, 1).otherwise(0)
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), row)
            along = F.sign(hp.bitwiseAND(bit)) - F.sign(hn.bitwiseAND(bit))
            return F.struct(
                hn.bitwiseOR(full.bitwiseXOR(down.bitwiseOR(hp))).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (state["d"] + F.when(row >= 2 * band, lowest).otherwise(along)).cast("bigint").alias("d"),
            )

        return F.transform(d0, after)[0]

    start = F.struct(
        F.lit(width & ~((1 << band) - 1)).cast("bigint").alias("vp"),
        F.lit(0).cast("bigint").alias("vn"),
        F.least(F.lit(band), m).cast("bigint").alias("d"),
    )
    return F.when(n == 0, m).otherwise(F.aggregate(F.sequence(F.lit(1), n), start, step)["d"])


def _maybe(x: Column, y: Column, rule: Rule) -> Column:
    """What two near lines (structs with size and parity) have in common, for next to no work."""
    return (F.abs(x["size"] - y["size"]) <= rule.max_edits) & (
        F.bit_count(x["parity"].bitwiseXOR(y["parity"])) <= 2 * rule.max_edits
    )


def _linked(x: Column, y: Column, rule: Rule) -> Column:
    """Whether two lines are near, by their distance."""
    swap = x["size"] > y["size"]
    short, long = F.when(swap, y["line"]).otherwise(x["line"]), F.when(swap, x["line"]).otherwise(y["line"])
    both = F.struct(_characters(short).alias("short"), _characters(long).alias("long"))
    # An array of one keeps the characters from being cut again at every step.
    distance = F.transform(F.array(both), lambda p: banded_distance(p["short"], p["long"], rule.max_edits))[0]
    # The shorter line is the one that is allowed fewer edits.
    return distance <= F.least(x["edits"], y["edits"])


def _classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row for each different line: its numbers, first place, number of rows, and keys."""
    rows = with_keys(lines_of(docs), rule).select("a", "b", _place().alias("place"), "keys")
    # The keys follow from the line, so that any of them will do.
    return materialize(
        rows.groupBy("a", "b").agg(
            F.min("place").alias("first"), F.count("*").alias("n"), F.any_value("keys").alias("keys")
        ),
        "lines",
    )


def _met(classes: DataFrame) -> DataFrame:
    """``key, a, n`` of the keys that different lines share, and how many do.

    What is found out about a key is summed up in the map tasks, and lines find their keys by a join whose
    partitions can be divided, so that the lines of a key need not meet in one task.
    """
    rows = classes.select("a", F.explode("keys").alias("key"))
    ends = rows.groupBy("key").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    shared = materialize(ends.filter("low != high").select("key"), "shared")
    if shared.count() <= BROADCAST_IDS:
        shared = F.broadcast(shared)
    met = materialize(rows.join(shared, "key").distinct(), "met")
    sizes = materialize(met.groupBy("key").agg(F.count("*").alias("n")), "sizes")
    if sizes.count() <= BROADCAST_IDS:
        sizes = F.broadcast(sizes)
    return met.join(sizes, "key")


def _tiled(met: DataFrame, items: DataFrame, rule: Rule) -> DataFrame:
    """``key, pair, bits, tiles, tile, items``: the lines of each key, or finer key, in tiles."""
    masks = _masks(rule.max_edits)
    finer = F.array(
        *[F.struct(F.lit(k).alias("pair"), F.col("item.parity").bitwiseAND(m).alias("bits")) for k, m in enumerate(masks)]
    )
    whole = F.array(F.struct(F.lit(-1).alias("pair"), F.lit(0).cast("bigint").alias("bits")))
    crowded = F.col("n") > CROWD
    sub = F.explode(F.when(crowded, finer).otherwise(whole))
    by = ["key", "pair", "bits"]
    places = materialize(
        met.join(items.select("a", F.struct("item.parity").alias("item")), "a")
        .select("key", "a", sub.alias("sub"))
        .select("key", "a", "sub.pair", "sub.bits"),
        "places",
    )
    tiles = places.groupBy(*by).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"), F.count("*").alias("held"))
    dealt = places.join(tiles.filter("held > 1").drop("held"), by).withColumn(
        "tile", F.pmod(F.xxhash64("a", *by), "tiles").cast("int")
    )
    return materialize(
        dealt.join(items, "a").groupBy(*by, "tiles", "tile").agg(F.collect_list("item").alias("items")), "tiles"
    )


def line_links(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``a, b, n_links, earliest`` of each line with a near line: how many, and the first place."""
    met = _met(classes)
    wanted = materialize(met.select("a").distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    lines = lines_of(docs).join(wanted, "a").withColumn("place", _place())
    items = lines.groupBy("a", "b").agg(F.first("line").alias("line"), F.min("place").alias("first"))
    edits = rule.allowed(F.col("size")).alias("edits")
    item = F.struct("a", "b", "line", "size", edits, parity(F.col("line")).alias("parity"), "first", "keys")
    items = materialize(with_keys(items, rule).select("a", item.alias("item")), "items")
    tiled = _tiled(met, items, rule)
    by = ["key", "pair", "bits"]
    alone = tiled.filter("tiles = 1").select("key", "pair", "items", F.col("items").alias("others"))
    many = tiled.filter("tiles > 1")
    ahead = many.select(*by, "items", F.explode(F.expr("sequence(0, tiles - 1)")).alias("tile"))
    across = ahead.join(many.select(*by, "tile", F.col("items").alias("others")), [*by, "tile"])
    pairs = alone.unionByName(across.select("key", "pair", "items", "others"))

    def first_pair(diff: Column) -> Column:
        found = F.lit(-1)
        for k, mask in reversed(list(enumerate(_masks(rule.max_edits)))):
            found = F.when(diff.bitwiseAND(mask) == 0, F.lit(k)).otherwise(found)
        return found

    def found(x: Column) -> Column:
        def near(y: Column) -> Column:
            other = (x["a"] != y["a"]) | (x["b"] != y["b"])
            smallest = F.array_min(F.array_intersect(x["keys"], y["keys"])) == F.col("key")
            finest = (F.col("pair") < 0) | (first_pair(x["parity"].bitwiseXOR(y["parity"])) == F.col("pair"))
            return _maybe(x, y, rule) & other & finest & smallest & _linked(x, y, rule)

        return F.struct(
            x["a"].alias("a"),
            x["b"].alias("b"),
            F.transform(F.filter("others", near), lambda y: y["first"]).alias("firsts"),
        )

    each = pairs.select(F.explode(F.filter(F.transform("items", found), lambda f: F.size(f["firsts"]) > 0)).alias("f"))
    return each.groupBy("f.a", "f.b").agg(
        F.sum(F.size("f.firsts")).alias("n_links"), F.min(F.array_min("f.firsts")).alias("earliest")
    )


def decide(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, text_key, pos, first, n_links, kept`` of each line that takes part.

    Lines are what ``\\n`` separates; those without a word, and null texts, take no part. ``first`` is
    the place of the first equal line, in the order of ids (rows without an id last) and positions:
    the class of the line. ``n_links`` counts the different lines that are near by ``rule``. A line is
    kept if it is the first of its class and no near line has its first place before it. Rows that
    agree in id and text share their places, so they are treated alike. An empty table gives no
    rows; other columns are not read.
    """
    classes = _classes(docs, rule)
    links = line_links(docs, classes, rule)
    # Most lines are alone; only the others have to be found again.
    told = (
        classes.filter("n > 1")
        .select("a", "b", "first")
        .join(links, ["a", "b"], "full")
        .select("a", "b", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), "earliest")
    )
    told = materialize(told, "classes")
    lines = lines_of(docs).select("doc_id", "text_key", "pos", "a", "b", _place().alias("place"))
    first = F.coalesce("first", "place")
    kept = (first == F.col("place")) & (F.col("earliest").isNull() | (F.col("earliest") > F.col("place")))
    return lines.join(told, ["a", "b"], "left").select(
        "doc_id",
        "text_key",
        "pos",
        first.alias("first"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        kept.alias("kept"),
    )


def clean(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs``, with all columns and rows, without the lines that are not kept."""
    dropped = decide(docs, rule).filter(~F.col("kept")).select("doc_id", "text_key", "pos").distinct()
    id_name, text_name, drop_name = free_names(docs, "id_key", "text_key", "dropped")
    by_row = dropped.groupBy(
        F.xxhash64(F.col("doc_id").isNull(), "doc_id").alias(id_name), F.col("text_key").alias(text_name)
    ).agg(F.collect_list("pos").alias(drop_name))
    keyed = docs.withColumns(
        {id_name: F.xxhash64(F.col("doc_id").isNull(), "doc_id"), text_name: text_key()}
    )
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop_name))
    text = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    joined = keyed.join(by_row, [id_name, text_name], "left")
    cleaned = F.when(F.col(drop_name).isNull(), F.col("text")).otherwise(text)
    return joined.select(*[cleaned.alias(c) if c == "text" else c for c in docs.columns])
