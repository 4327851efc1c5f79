"""TF-IDF vectors: fit on the train side, transform any side.

The vocabulary and its weights come from relational counts, so they are reproducible; the
vectors come from Spark ML stages, which work row by row in the JVM and can be saved.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textpipe.functions.stopwords import resolve
from textpipe.functions.text import TOKEN_PATTERN
from textpipe.operators.terms import (
    count_terms,
    document_counts,
    frequent_terms,
    index_terms,
    keep_terms,
    term_statistics,
    top_terms,
)
from textpipe.operators.validate import require_text
from textpipe.sources.local import broadcast_if_small, local_table, measured_bytes

FEATURES = "features"
_STEPS = ("_tokens", "_tf", "_weighted")
COUNTS = _STEPS[1]
NO_TERMS = "Empty vocabulary: the documents hold only stop words or no tokens"
STATISTICS = StructType().add("term", "string").add("corpus_tf", "long").add("df", "long")


@dataclass(frozen=True)
class Vectorizer:
    """A fitted vectorizer: the ML stages, and the vocabulary table they were made from."""

    model: PipelineModel
    vocabulary: DataFrame

    @property
    def n_features(self) -> int:
        return len(self.model.stages[1].vocabulary)

    def transform(self, docs: DataFrame) -> DataFrame:
        """Add ``features``. Tokens outside the vocabulary are dropped."""
        return self.model.transform(docs).drop(*_STEPS)

    def count(self, docs: DataFrame) -> DataFrame:
        """Add ``COUNTS``, the vector of how often each term occurs: the work on the texts."""
        return PipelineModel(self.model.stages[:2]).transform(docs).drop(_STEPS[0])

    def weigh(self, counted: DataFrame) -> DataFrame:
        """Turn ``COUNTS`` into ``features``."""
        return PipelineModel(self.model.stages[2:]).transform(counted).drop(*_STEPS)

    def save(self, model_path: str, vocabulary_path: str) -> None:
        self.model.write().overwrite().save(model_path)
        self.vocabulary.coalesce(1).write.mode("overwrite").parquet(vocabulary_path)

    @classmethod
    def load(cls, spark: SparkSession, model_path: str, vocabulary_path: str) -> Vectorizer:
        return cls(PipelineModel.load(model_path), spark.read.parquet(vocabulary_path))


def weigh_terms(vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """Number the terms and add the smoothed inverse document frequency."""
    idf = F.ln((1.0 + F.lit(n_docs)) / (1.0 + F.col("df"))) + 1.0
    return index_terms(vocabulary).select("term", "idx", "corpus_tf", "df", idf.alias("idf"))


def fit_vocabulary(
    train: DataFrame,
    max_features: int = 5000,
    stop_words: str | Iterable[str] | None = "english",
    text: str = "text",
    n_docs: int | None = None,
    sketch: bool = False,
) -> DataFrame:
    """The vocabulary table of the train documents, with at most ``max_features`` rows.

    With ``sketch`` a sketch of frequent items chooses the terms that are counted: the texts are cut
    twice, but the terms of the corpus are not shuffled. The table is the same.

    The table is fetched and kept as a local relation: whatever joins or reloads it later
    does not count the corpus again.
    """
    require_text(train, text)
    n_docs = train.count() if n_docs is None else n_docs
    words = resolve(stop_words)
    top = frequent_terms(train, words, max_features, text) if sketch else None
    if top is None:
        top = top_terms(term_statistics(train, words, text), max_features)
    vocabulary = weigh_terms(top, n_docs)
    rows = vocabulary.collect()
    if not rows:
        raise ValueError(NO_TERMS)
    return local_table(train.sparkSession, rows, vocabulary.schema)


def build_vectorizer(vocabulary: DataFrame, text: str = "text") -> Vectorizer:
    """Make the ML stages for a vocabulary.

    Stop words need no stage of their own: they are not in the vocabulary.
    """
    rows = vocabulary.orderBy("idx").select("term", "idf").collect()
    _, tf, weighted = _STEPS
    cut, count = _counting([row.term for row in rows], text)
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([row.idf for row in rows]), inputCol=tf, outputCol=weighted
    )
    scale = Normalizer(p=2.0, inputCol=weighted, outputCol=FEATURES)
    return Vectorizer(PipelineModel([cut, count, weigh, scale]), vocabulary)


def _counting(terms: Sequence[str], text: str) -> tuple[SQLTransformer, CountVectorizerModel]:
    """The stages that cut texts and count the terms of a vocabulary."""
    tokens, tf, _ = _STEPS
    cut = SQLTransformer(
        statement=f"SELECT *, regexp_extract_all(lower(`{text}`), r'{TOKEN_PATTERN}', 0) "
        f"AS {tokens} FROM __THIS__"
    )
    return cut, CountVectorizerModel.from_vocabulary(terms, inputCol=tokens, outputCol=tf)


def fit_counted(
    docs: DataFrame,
    path: str,
    max_features: int = 5000,
    stop_words: str | Iterable[str] | None = "english",
    text: str = "text",
    n_docs: int | None = None,
    term_counts: DataFrame | None = None,
) -> Vectorizer:
    """``fit_vectorizer`` on the train rows of ``docs``, and the vectors of counts of all its rows,
    stored at ``path`` with ``doc_id``, ``label`` and ``split``.

    What it costs beside cutting the texts is less: the terms of the train side are only counted, and
    the documents that hold a term follow from the stored vectors, which know no other terms.
    ``n_docs`` is the number of train rows and ``term_counts`` what ``count_terms`` gives for them,
    where they are known.
    """
    train = docs.filter("split = 'train'")
    require_text(train, text)
    n_docs = train.count() if n_docs is None else n_docs
    counts = count_terms(train, text) if term_counts is None else term_counts
    top = index_terms(top_terms(keep_terms(counts, resolve(stop_words)), max_features)).collect()
    if not top:
        raise ValueError(NO_TERMS)
    cut, count = _counting([row.term for row in sorted(top, key=lambda row: row.idx)], text)
    counted = PipelineModel([cut, count]).transform(docs)
    counted.select("doc_id", "label", "split", COUNTS).write.mode("overwrite").partitionBy("split").parquet(path)
    spark = docs.sparkSession
    stored = spark.read.parquet(path).filter("split = 'train'")
    held = {row.idx: row.df for row in document_counts(stored, COUNTS).collect()}
    rows = [(row.term, row.corpus_tf, held[row.idx]) for row in top]
    vocabulary = weigh_terms(local_table(spark, rows, STATISTICS), n_docs)
    return build_vectorizer(local_table(spark, vocabulary.collect(), vocabulary.schema), text)


def fit_vectorizer(
    train: DataFrame,
    max_features: int = 5000,
    stop_words: str | Iterable[str] | None = "english",
    text: str = "text",
    n_docs: int | None = None,
    sketch: bool = False,
) -> Vectorizer:
    """Fit vocabulary and weights on the train documents."""
    vocabulary = fit_vocabulary(train, max_features, stop_words, text, n_docs, sketch)
    return build_vectorizer(vocabulary, text)


def weights_table(vectors: DataFrame, vocabulary: DataFrame, key: str = "doc_id") -> DataFrame:
    """Vectors as rows ``(key, term, idx, tfidf)``. Reads the vectors in place: no shuffle."""
    vector = F.unwrap_udt(FEATURES)
    entries = vectors.select(key, vector.alias("vector")).select(
        key,
        F.inline(
            F.arrays_zip(F.col("vector.indices").alias("idx"), F.col("vector.values").alias("tfidf"))
        ),
    )
    named = vocabulary.select("idx", "term")
    small = broadcast_if_small(named, measured_bytes(named))
    return entries.join(small, "idx").select(key, "term", "idx", "tfidf")
