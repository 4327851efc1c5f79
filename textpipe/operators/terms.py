"""Term counts and the vocabulary.

A document is one row, so everything about a single document is computed inside its row:
sorting the tokens puts equal ones side by side, and comparing neighbours finds the first of
each run. Only counts per term, already summed up in each task, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from textpipe.functions.text import tokens
from textpipe.sources.local import broadcast_if_small, local_table, measured_bytes, small_table


def _sorted_tokens(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    return docs.select(*keep, F.sort_array(tokens(text)).alias("sorted"))


def _neighbours(**extra: Column) -> Column:
    """Each sorted token with the one before it, and a closing entry without a token.

    No token is empty, so the empty string before the first token starts a run.
    """
    return F.arrays_zip(
        F.col("sorted").alias("term"),
        F.concat(F.array(F.lit("")), F.col("sorted")).alias("before"),
        *(column.alias(name) for name, column in extra.items()),
    )


def keep_terms(df: DataFrame, stop_words: list[str]) -> DataFrame:
    return df.filter(~F.col("term").isin(*stop_words)) if stop_words else df


def term_frequency(
    docs: DataFrame, stop_words: list[str], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, term, tf)``: how often a term occurs in a document. No shuffle."""
    places = _neighbours(place=F.sequence(F.lit(0), F.size("sorted")))
    starts = F.filter(
        places, lambda x: x["term"].isNull() | (x["term"] != x["before"])
    )
    runs = _sorted_tokens(docs, text, key).select(key, starts.alias("starts"))
    # Zipping the starts with themselves, moved by one, pairs each run with its end.
    ends = F.slice("starts", F.lit(2), F.greatest(F.size("starts") - 1, F.lit(0)))
    counted = runs.select(
        key, F.inline(F.arrays_zip(F.col("starts").alias("run"), ends.alias("next")))
    ).filter(F.col("run.term").isNotNull())
    return keep_terms(
        counted.select(
            key,
            F.col("run.term").alias("term"),
            (F.col("next.place") - F.col("run.place")).cast("bigint").alias("tf"),
        ),
        stop_words,
    )


def term_statistics(
    docs: DataFrame, stop_words: list[str], text: str = "text", only: DataFrame | None = None
) -> DataFrame:
    """``(term, corpus_tf, df)``: occurrences of a term and documents with it, in one pass.

    ``only`` is a small table of the terms to count, if not all are.
    """
    occurrences = (
        _sorted_tokens(docs, text)
        .select(F.inline(_neighbours()))
        .filter(F.col("term").isNotNull())
    )
    kept = keep_terms(occurrences, stop_words)
    if only is not None:
        kept = kept.join(only, "term", "left_semi")
    return (
        kept.groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("corpus_tf"),
            F.count_if(F.col("term") != F.col("before")).alias("df"),
        )
    )


def count_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(term, corpus_tf)`` of all terms, stop words too. Nothing is sorted inside the documents."""
    occurrences = docs.select(F.explode(tokens(text)).alias("term"))
    return occurrences.groupBy("term").agg(F.count(F.lit(1)).alias("corpus_tf"))


def document_counts(counted: DataFrame, vector: str) -> DataFrame:
    """``(idx, df)``: documents in whose vector of counts a term occurs."""
    found = counted.select(F.explode(F.unwrap_udt(vector)["indices"]).alias("idx"))
    return found.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))


def frequent_terms(
    docs: DataFrame, stop_words: list[str], max_features: int, text: str = "text", tracked: int = 200_000
) -> DataFrame | None:
    """What ``top_terms`` of ``term_statistics`` gives, without a shuffle of all terms; or None.

    A sketch of frequent items, merged from those of the tasks, names twice as many candidates as
    are wanted, and a second pass counts these exactly. Other terms cannot be among the most
    frequent if the last of these occurs more often than the sketch can be wrong: by its bound of
    3.5 occurrences for each of the items that it tracks, or by its estimate for the last
    candidate, which is no lower than the true count. Where that is not so, the answer is None:
    the terms have to be counted in full. Of equally frequent terms at the cut all must be known,
    so the last one has to be above the bound.
    """
    spark = docs.sparkSession
    occurrences = keep_terms(docs.select(F.explode(tokens(text)).alias("term")), stop_words)
    wanted = min(2 * max_features, tracked)
    found = occurrences.agg(
        F.call_function("approx_top_k", F.col("term"), F.lit(wanted), F.lit(tracked)).alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if not found.n:
        return None
    bound = 3.5 * found.n / tracked
    if len(found.top) == wanted:
        bound = max(bound, found.top[-1]["count"])
    rows = [(item["item"],) for item in found.top]
    # At most twice as many rows as the vocabulary.
    candidates = small_table(spark, rows, StructType([StructField("term", StringType())]))
    counted = term_statistics(docs, stop_words, text, candidates)
    top = top_terms(counted, max_features).collect()
    distinct_known = len(found.top) < wanted and found.n <= tracked
    if not distinct_known and (len(top) < max_features or top[-1].corpus_tf <= bound):
        return None
    return local_table(spark, top, counted.schema)


def top_terms(statistics: DataFrame, max_features: int) -> DataFrame:
    """The terms that occur most; of equally frequent ones the alphabetically first."""
    return statistics.orderBy(F.desc("corpus_tf"), "term").limit(max_features)


def index_terms(vocabulary: DataFrame) -> DataFrame:
    """Number the terms alphabetically from 0. Takes a vocabulary, not a corpus."""
    position = F.row_number().over(Window.orderBy("term")) - 1
    return vocabulary.withColumn("idx", position)


def lookup_terms(frequencies: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Replace terms by vocabulary entries; terms outside the vocabulary are dropped."""
    small = broadcast_if_small(vocabulary, measured_bytes(vocabulary))
    return frequencies.join(small, "term")
