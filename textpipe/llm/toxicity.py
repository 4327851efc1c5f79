"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, runs of characters other than letters and digits become one space, and the
n-grams of 3 to 5 characters are hashed into buckets. From labelled texts, each bucket gets the log
ratio of its smoothed frequencies in toxic and in other texts; only the buckets whose counts speak
most clearly (log-likelihood ratio) stay. A text has the ratio of each of its buckets as a feature,
and a logistic regression is fitted on these.

The fit reads a bounded sample of labelled rows (``max_rows`` of each class, those with the
smallest hash of id and text); the score of a text is one sum over all of it, in the map tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpipe.llm.common import chunks, code_points, give_back, materialize

SHORTEST, LONGEST = 3, 5
BUCKET_BITS = 18
MAX_ROWS = 6_000
MAX_FEATURES = 1_024
LEAST_COUNT = 5
SMOOTHING = 1.0
PENALTY = 1e-3
ITERATIONS = 60
_MULTIPLIER = np.uint32(0x9E3779B1)
_CHARACTERS_AT_ONCE = 1 << 19


def _buckets(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The bucket of the n-gram that begins at each place, for every length."""
    shift = np.uint32(32 - BUCKET_BITS)
    rolled = codes.copy()
    for n in range(2, LONGEST + 1):
        rolled = rolled[:-1] * _MULTIPLIER + codes[n - 1 :]
        if n >= SHORTEST:
            mixed = (rolled ^ (rolled >> np.uint32(15))) * _MULTIPLIER + np.uint32(n)
            yield (mixed * _MULTIPLIER) >> shift


def present(texts: Iterable, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place of the text, bucket), each once; only ``wanted`` buckets where given."""
    for first, part in chunks(texts, _CHARACTERS_AT_ONCE):
        codes, begin, lengths = code_points(part, LONGEST)
        ends = begin + lengths
        found = []
        for buckets in _buckets(codes):
            at = np.arange(len(buckets)) if wanted is None else np.flatnonzero(wanted[buckets])
            owner = np.searchsorted(begin, at, side="right") - 1
            inside = at < ends[owner]
            found.append(owner[inside] << BUCKET_BITS | buckets[at[inside]].astype(np.int64))
        pairs = np.unique(np.concatenate(found))
        yield (pairs >> BUCKET_BITS) + first, pairs & ((1 << BUCKET_BITS) - 1)


@dataclass(frozen=True)
class Model:
    """Weights of buckets; ``intercept`` is the log odds of a text that has none of them."""

    intercept: float
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, text: str = "text") -> Column:
        """Probability of the label 1, from the whole text. A null text counts as empty."""
        intercept, buckets, weights = self.intercept, self.buckets, self.weights

        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            weight = np.zeros(1 << BUCKET_BITS)
            weight[buckets] = weights
            for texts in batches:
                total = np.full(len(texts), intercept)
                for rows, found in present(texts, weight != 0):
                    total += np.bincount(rows, weight[found], len(texts))
                yield pa.array(1 / (1 + np.exp(-np.clip(total, -60, 60))))
            give_back()

        return scored(F.coalesce(F.col(text), F.lit("")))


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled texts of the sample, and how many labelled rows each class has in all.

    Rows are chosen by a hash of id and text; rows that agree in both are one row of the sample.
    """
    known = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = materialize(keyed.select("doc_id", "row").join(known, "doc_id").select("row", "toxic"), "labelled")
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    each = rows.distinct()
    chosen = [each.filter(F.col("toxic") == c).orderBy("row").limit(max_rows) for c in (0, 1)]
    # At most 2 * max_rows numbers and labels, so a broadcast is bounded by the parameter.
    wanted = F.broadcast(materialize(chosen[0].union(chosen[1]), "chosen"))
    held = keyed.join(wanted, "row").select("row", "toxic", "text").dropDuplicates(["row"])
    # Spread over tasks: the rows are few, but cutting texts takes time.
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    return materialize(held.select("toxic", "text").repartition(2 * tasks), "sample"), totals


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << BUCKET_BITS
    counts = np.zeros(2 * size, dtype=np.int64)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for rows, found in present(batch.column("text")):
            counts += np.bincount(toxic[rows] * size + found, minlength=2 * size)
    at = np.flatnonzero(counts[:size] + counts[size:])
    give_back()
    yield pa.record_batch(
        [pa.array(at), pa.array(counts[:size][at]), pa.array(counts[size:][at])],
        names=["bucket", "clean", "toxic"],
    )


def _clearest(counts: pd.DataFrame, n_clean: int, n_toxic: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets whose presence depends on the class most clearly, and their log-count ratios."""
    clean, toxic = counts.clean.to_numpy(float), counts.toxic.to_numpy(float)
    every, n = clean + toxic, n_clean + n_toxic

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)

    ratio = 2 * (
        part(toxic, every * n_toxic / n)
        + part(clean, every * n_clean / n)
        + part(n_toxic - toxic, np.maximum(n - every, 1e-9) * n_toxic / n)
        + part(n_clean - clean, np.maximum(n - every, 1e-9) * n_clean / n)
    )
    p, q = toxic + SMOOTHING, clean + SMOOTHING
    log_ratio = np.log((p / p.sum()) / (q / q.sum()))
    best = np.lexsort((counts.bucket, -np.where(every >= LEAST_COUNT, ratio, -1)))[:most]
    best = best[(every[best] >= LEAST_COUNT) & (log_ratio[best] != 0)]
    return counts.bucket.to_numpy()[best], log_ratio[best]


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES
) -> Model:
    """Fit on the rows of ``docs`` whose id has a label ``toxic`` of 0 or 1.

    ``max_rows`` bounds the sampled labelled rows of each class, ``max_features`` the buckets that
    stay. An id with both labels counts as toxic; rows with a null id or label are not labelled; a
    row that repeats counts once; columns of other names are not read. Without rows of both classes the model
    is the smoothed share of toxic rows (none at all: every score is 0.5 / 1.5).
    """
    sample, totals = _sample(docs, labels, max_rows)
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    if not n_clean or not n_toxic:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1.5)
        return Model(float(np.log(share / (1 - share))))
    # At most one row for each bucket, whatever the size of the sample.
    counts = (
        sample.mapInArrow(_counts, "bucket bigint, clean bigint, toxic bigint")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= LEAST_COUNT)
        .toPandas()
    )
    buckets, ratios = _clearest(counts, n_clean, n_toxic, max_features)
    if not len(buckets):
        return Model(float(np.log((n_toxic + 0.5) / (n_clean + 0.5))))
    wanted = np.zeros(1 << BUCKET_BITS, dtype=bool)
    wanted[buckets] = True

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(present(batch.column("text"), wanted))
            rows = np.concatenate([r for r, _ in pairs])
            found = pa.array(np.concatenate([f for _, f in pairs])).cast(pa.string())
            ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(batch)))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
            yield pa.record_batch({"toxic": batch.column("toxic"), "terms": lists})

    present_terms = sample.mapInArrow(terms, "toxic int, terms array<string>")
    # A feature is the log-count ratio of a bucket that the text has, else zero.
    counted = CountVectorizerModel.from_vocabulary(
        [str(b) for b in buckets], inputCol="terms", outputCol="present", binary=True
    ).transform(present_terms)
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense(ratios), inputCol="present", outputCol="features"
    ).transform(counted)
    weight = F.when(F.col("toxic") == 1, totals[1] / n_toxic).otherwise(totals[0] / n_clean)
    rows = materialize(
        scaled.select(F.col("toxic").cast("double").alias("label"), weight.alias("weight"), "features"),
        "vectors",
    )
    fitted = LogisticRegression(
        weightCol="weight",
        regParam=PENALTY,
        maxIter=ITERATIONS,
        standardization=False,
        family="binomial",
    ).fit(rows)
    return Model(fitted.intercept, buckets, fitted.coefficients.toArray() * ratios)


def trained_on(doc_id: str = "doc_id") -> Column:
    """False for the rows held out: those whose id, as text, has a CRC-32 divisible by 5."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) != 0
