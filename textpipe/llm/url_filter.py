"""URL filters: rules, and a tree of path templates that is judged by labelled purity.

The tree of a host is grown level by level. Below a node, path segments that many of its URLs share
stay literal; all others are one wildcard. Literal branches whose labelled shares do not differ
significantly become one node, whose URLs are counted together from there on. The purity of a branch
is its labelled share of blocked URLs, smoothed towards that of its parent; a root is smoothed towards
all labelled URLs. A URL goes down the tree as far as its path, or until too few others go on with
it, and is blocked if the template where it ends is pure enough.

A level is two aggregations of URLs, by node and by node and segment, summed up in the map tasks, so
that a host with a third of all URLs is no more work than others. Segments with few URLs never meet:
the counts of a wildcard are those of its node less those of the literal branches, and of these a
node has few, since each has a minimum share. Everything is made of DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpipe.llm.common import BROADCAST_BYTES, broadcast_if, materialize

# (host, path, verdict)
Rule = tuple[str, str, str]


@dataclass(frozen=True)
class Tree:
    """``support`` URLs and ``share`` of its node keep a segment literal, and a node of which fewer
    than ``support`` URLs go on is not divided; ``smoothing`` counts for so many labels; branches
    within ``similar`` standard errors merge; ``reject`` is the purity from which a template is
    blocked. All levels of a path are looked at."""

    support: int = 5
    share: float = 0.02
    smoothing: float = 2.0
    similar: float = 1.96
    reject: float = 0.8


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule) -> Column:
    host, path, _ = rule
    name = F.col("host")
    return ((name == host) | F.endswith(name, F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))


def ruled(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``urls`` (host, path) with the longest rule that fits, as host and path, and its verdict."""
    found = F.lit(None).cast("string")
    said = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        found = F.when(_fits(rule), F.lit(rule[0] + rule[1])).otherwise(found)
        said = F.when(_fits(rule), F.lit(rule[2])).otherwise(said)
    return urls.withColumns({"rule": found, "said": said})


def _purity(block: str, n: str, towards: Column, smoothing: float) -> Column:
    return (F.col(block) + smoothing * towards) / (F.col(n) + smoothing)


# Characters that stand for something in a template.
_MARKS = r"([*{|}\\])"


def _pooled(literal: DataFrame, how: Tree) -> DataFrame:
    """The literal branches with ``set``: neighbours by labelled share that do not differ have one.

    A node has at most 1 / share of them, so that a window over a node is small.
    """
    one = Window.partitionBy("node").orderBy("rate", "segment")
    rate, n = F.col("rate"), F.col("n")
    last_rate, last_n = F.lag("rate").over(one), F.lag("n").over(one)
    pooled = (rate * n + last_rate * last_n) / (n + last_n)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / last_n))
    apart = F.coalesce(((rate - last_rate) > how.similar * error).cast("int"), F.lit(0))
    known = literal.filter("n > 0").withColumn("rate", F.col("block") / F.col("n"))
    numbered = known.withColumn("apart", apart).withColumn("number", F.sum("apart").over(one))
    known = numbered.select("node", "segment", "urls", "n", "block", F.col("number").cast("string").alias("set"))
    # Without labels nothing says that branches are alike.
    unknown = literal.filter("n = 0").select("node", "segment", "urls", "n", "block", F.concat(F.lit("/"), "segment").alias("set"))
    return known.unionByName(unknown)


def _branches(going: DataFrame, level: int, how: Tree) -> DataFrame | None:
    """``node, segments, child, child_purity`` of the nodes that are divided; the wildcard of a node
    has no segments. None if no node is."""
    totals = (
        going.groupBy("node")
        .agg(
            F.count("*").alias("urls"),
            F.count("blocked").alias("n"),
            F.count_if("blocked").alias("block"),
            # One node has one purity.
            F.min("purity").alias("purity"),
        )
        .filter(F.col("urls") >= how.support)
    )
    totals = materialize(totals, "nodes")
    if totals.isEmpty():
        return None
    small = broadcast_if(totals, 200)
    every = small.select("node", F.col("urls").alias("total"))
    counts = going.groupBy("node", F.get("segments", level).alias("segment")).agg(
        F.count("*").alias("urls"), F.count("blocked").alias("n"), F.count_if("blocked").alias("block")
    )
    literal = counts.filter(F.col("urls") >= how.support).join(every, "node")
    literal = literal.filter(F.col("urls") >= how.share * F.col("total")).drop("total")
    escaped = F.regexp_replace("segment", _MARKS, r"\\$1")
    sets = _pooled(materialize(literal, "segments"), how).groupBy("node", "set").agg(
        F.sum("urls").alias("urls"),
        F.sum("n").alias("n"),
        F.sum("block").alias("block"),
        F.sort_array(F.collect_list("segment")).alias("segments"),
        F.sort_array(F.collect_list(escaped)).alias("names"),
    )
    sets = materialize(sets.drop("set"), "sets")
    taken = sets.groupBy("node").agg(*[F.sum(c).alias(f"of_{c}") for c in ("urls", "n", "block")])
    rest = totals.join(taken, "node", "left")
    for c in ("urls", "n", "block"):
        rest = rest.withColumn(c, F.col(c) - F.coalesce(f"of_{c}", F.lit(0)))
    nothing = F.lit(None).cast("array<string>")
    wild = rest.filter("urls > 0").select("node", "n", "block", nothing.alias("segments"), F.lit("*").alias("name"))
    names = F.array_join("names", "|")
    name = F.when(F.size("segments") > 1, F.concat(F.lit("{"), names, F.lit("}"))).otherwise(names)
    branches = sets.select("node", "n", "block", "segments", name.alias("name")).unionByName(wild)
    return materialize(
        branches.join(small.select("node", "purity"), "node").select(
            "node",
            "segments",
            F.concat("node", F.lit("/"), "name").alias("child"),
            _purity("block", "n", F.col("purity"), how.smoothing).alias("child_purity"),
        ),
        "branches",
    )


def judged(urls: DataFrame, how: Tree = Tree()) -> DataFrame:
    """``urls`` with ``template`` (host and path template where each URL ends) and ``purity``.

    ``urls`` has ``host``, ``path`` and ``blocked``: true or false where a URL is labelled, else
    null. In a template ``*`` is a wildcard and ``{a|b}`` a merged branch; a backslash stands before
    such characters of a path. Empty segments are passed over, so that a slash at the end makes no
    difference. Without any label every purity is 0. There are as many rounds as segments in the
    longest path that ``support`` URLs go along.
    """
    columns = [c for c in urls.columns if c not in ("template", "purity")]
    kept = urls.select(*[F.col(c).alias(f"url_{c}") for c in columns], "host", "blocked", "path")
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    every = urls.agg(F.count_if("blocked").alias("block"), F.count("blocked").alias("n")).select(
        F.when(F.col("n") > 0, F.col("block") / F.col("n")).otherwise(0.0).alias("prior")
    )
    prior = every.first()["prior"]
    roots = urls.groupBy(F.col("host").alias("node")).agg(
        F.count("blocked").alias("n"), F.count_if("blocked").alias("block")
    )
    roots = materialize(
        roots.select("node", _purity("block", "n", F.lit(prior), how.smoothing).alias("purity")), "hosts"
    )
    at = kept.withColumns({"segments": segments, "node": F.col("host")}).drop("host", "path")
    at = materialize(at.join(broadcast_if(roots, 200), "node"), "urls")
    done, level = [], 0
    while True:
        more = F.size("segments") > level
        branches = _branches(at.filter(more), level, how)
        if branches is None:
            done.append(at)
            break
        literal = branches.select(
            "node", F.explode("segments").alias("segment"), F.col("child").alias("named"), F.col("child_purity").alias("named_purity")
        )
        wild = branches.filter("segments is null").select(
            "node", F.col("child").alias("other"), F.col("child_purity").alias("other_purity")
        )
        few = branches.count() * 300 <= BROADCAST_BYTES
        # A node has at most 1 / share literal segments.
        literal, wild = (F.broadcast(x) if few else x for x in (literal, wild))
        moved = (
            at.withColumn("segment", F.get("segments", level))
            .join(literal, ["node", "segment"], "left")
            .join(wild, "node", "left")
        )
        child, purity = F.coalesce("named", "other"), F.coalesce("named_purity", "other_purity")
        # Nodes without a branch are not divided: their URLs end there.
        goes = F.col("segment").isNotNull() & child.isNotNull()
        moved = moved.select(
            *[c for c in at.columns if c not in ("node", "purity")],
            F.when(goes, child).otherwise(F.col("node")).alias("node"),
            F.when(goes, purity).otherwise(F.col("purity")).alias("purity"),
            goes.alias("goes"),
        )
        moved = materialize(moved, "urls")
        done.append(moved.filter("not goes").drop("goes"))
        at, level = moved.filter("goes").drop("goes"), level + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(*[F.col(f"url_{c}").alias(c) for c in columns], F.col("node").alias("template"), "purity")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], how: Tree = Tree()) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of each row of ``pages``.

    The verdict is that of the longest rule that fits; else a URL is blocked if the purity of its
    template is at least ``reject``. The labels of the tree are the verdicts of the rules. A null
    URL, or one without ``://``, has an empty host and path. Rows may repeat; an empty table gives
    no rows; other columns are not read.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = ruled(parts, rules).withColumn("blocked", F.col("said") == "block")
    found = judged(urls, how)
    own = F.when(F.col("purity") >= how.reject, "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), "template", "purity"
    )
