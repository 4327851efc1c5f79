"""Term counts, vocabulary and TF-IDF against a brute-force computation in Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textpipe.functions.stopwords import ENGLISH
from textpipe.operators import vectorize
from textpipe.operators.terms import (
    frequent_terms,
    index_terms,
    lookup_terms,
    term_frequency,
    term_statistics,
    top_terms,
)
from textpipe.operators.vectorize import (
    Vectorizer,
    fit_vectorizer,
    fit_vocabulary,
    weights_table,
)

TRAIN = [
    "the striker scored and scored again before half time",
    "a keeper saved the penalty in extra time",
    "the goalkeeper, the striker and the referee argued",
    "bond yields rose while shares fell",
    "shares of the bank fell after weak earnings",
    "weak earnings and weak guidance: yields rose",
    "engineers taught the robot to fold laundry",
    "a robot and 2 engineers landed the probe on Mars",
    "the probe sent laundry_list.txt back, twice",
    "ministers met at the border to sign a treaty",
    "the treaty ended talks between ministers",
    "border talks ended; ministers signed",
]
TEST = [
    "ministers signed the treaty",
    "the striker met the robot",
    "earnings of the goalkeeper rose and rose",
    "volcano erupted near an unknown village",
    "talks about laundry",
    "",
    "the of and about",
]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def words(text):
    return [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in set(ENGLISH)]


def python_vocabulary(texts, k):
    corpus, df = Counter(), Counter()
    for text in texts:
        corpus.update(words(text))
        df.update(set(words(text)))
    kept = sorted(sorted(corpus, key=lambda t: (-corpus[t], t))[:k])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    return kept, corpus, df, idf


def python_tfidf(train, texts, k=5000):
    kept, _, _, idf = python_vocabulary(train, k)
    place = {t: i for i, t in enumerate(kept)}
    out = {}
    for i, text in enumerate(texts):
        weights = {t: n * idf[t] for t, n in Counter(words(text)).items() if t in idf}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out.update({(i, t): (place[t], w / norm) for t, w in weights.items()})
    return out


def random_texts(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i:03d}" for i in range(120)] + ["the", "and", "é1", "日本", "x"]
    return [
        " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 40, 300]))) for _ in range(n)
    ]


def test_term_frequency_and_statistics(spark):
    texts = random_texts(80)
    df = docs(spark, texts)
    got = {(r.doc_id, r.term): r.tf for r in term_frequency(df, ENGLISH).collect()}
    expected = {(i, t): n for i, x in enumerate(texts) for t, n in Counter(words(x)).items()}
    assert got == expected
    _, corpus, documents, _ = python_vocabulary(texts, 1)
    got = {r.term: (r.corpus_tf, r.df) for r in term_statistics(df, ENGLISH).collect()}
    assert got == {t: (corpus[t], documents[t]) for t in corpus}


def test_no_stop_words(spark):
    got = term_frequency(docs(spark, ["The the cat"]), []).collect()
    assert {(r.term, r.tf) for r in got} == {("the", 2), ("cat", 1)}


def test_term_frequency_does_not_shuffle(spark):
    plan = term_frequency(docs(spark, TRAIN), ENGLISH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("k", [1, 7, 50, 1000])
def test_vocabulary_ties_are_cut_alphabetically(spark, k):
    texts = random_texts(60)
    top = index_terms(top_terms(term_statistics(docs(spark, texts), ENGLISH), k)).collect()
    kept, *_ = python_vocabulary(texts, k)
    assert {r.term: r.idx for r in top} == {t: i for i, t in enumerate(kept)}


def test_lookup_drops_unknown_terms_in_a_broadcast_join(spark):
    vocabulary = fit_vocabulary(docs(spark, TRAIN))
    joined = lookup_terms(term_frequency(docs(spark, TEST), ENGLISH), vocabulary)
    found = {r.term for r in joined.collect()}
    assert found.isdisjoint({"volcano", "erupted", "village"}) and "striker" in found
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("k", [5, 5000])
def test_tfidf_values(spark, k):
    fitted = fit_vectorizer(docs(spark, TRAIN), k)
    for texts in (TRAIN, TEST):
        vectors = fitted.transform(docs(spark, texts))
        got = {
            (r.doc_id, r.term): (r.idx, r.tfidf)
            for r in weights_table(vectors, fitted.vocabulary).collect()
        }
        expected = python_tfidf(TRAIN, texts, k)
        assert got.keys() == expected.keys()
        for pair, (place, weight) in expected.items():
            assert got[pair][0] == place and got[pair][1] == pytest.approx(weight, abs=1e-12)


def test_vectors_have_unit_or_zero_length_and_equal_width(spark):
    fitted = fit_vectorizer(docs(spark, TRAIN))
    rows = fitted.transform(docs(spark, TRAIN + TEST)).select("features").collect()
    assert {r.features.size for r in rows} == {fitted.n_features}
    for r in rows:
        assert r.features.norm(2) == pytest.approx(1.0) or r.features.numNonzeros() == 0
    assert sum(r.features.numNonzeros() == 0 for r in rows) == 3


def test_transform_adds_only_the_features(spark):
    df = docs(spark, TRAIN)
    out = fit_vectorizer(df).transform(df)
    assert out.columns == ["doc_id", "text", "features"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_reload(spark, tmp_path):
    fitted = fit_vectorizer(docs(spark, TRAIN))
    paths = str(tmp_path / "v"), str(tmp_path / "t")
    for _ in range(2):
        fitted.save(*paths)
    loaded = Vectorizer.load(spark, *paths)
    key = lambda v: [(r.doc_id, r.features) for r in v.orderBy("doc_id").collect()]
    assert key(loaded.transform(docs(spark, TEST))) == key(fitted.transform(docs(spark, TEST)))
    assert sorted(map(tuple, loaded.vocabulary.collect())) == sorted(map(tuple, fitted.vocabulary.collect()))


def test_statistics_do_not_depend_on_partitioning(spark):
    texts = random_texts(70)
    tables = [
        sorted(map(tuple, fit_vocabulary(docs(spark, texts).repartition(n), 30).collect()))
        for n in (1, 5, 33)
    ]
    assert tables[0] == tables[1] == tables[2]


def test_hot_texts_are_counted_in_the_map_tasks(spark):
    """A third of all rows are copies of one text: its terms still reach the shuffle once per task."""
    texts = random_texts(200) + [TRAIN[0]] * 100
    statistics = term_statistics(docs(spark, texts), ENGLISH)
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(term")
    got = {r.term: (r.corpus_tf, r.df) for r in statistics.collect()}
    _, corpus, documents, _ = python_vocabulary(texts, 1)
    assert got == {t: (corpus[t], documents[t]) for t in corpus}


@pytest.mark.parametrize("texts", [["the and of", "a I"], ["", "   "], ["a b c"]])
def test_empty_vocabulary(spark, texts):
    with pytest.raises(ValueError, match="Empty vocabulary"):
        fit_vectorizer(docs(spark, texts))


def test_null_text(spark):
    with pytest.raises(ValueError, match="Null documents"):
        fit_vectorizer(docs(spark, ["fine", None]))


def test_column_names_are_parameters(spark):
    df = docs(spark, TRAIN).withColumnRenamed("text", "the body")
    fitted = fit_vectorizer(df, text="the body")
    assert fitted.transform(df).select(F.count("features")).first()[0] == len(TRAIN)


@pytest.mark.parametrize("tracked", [200_000, 40, 8])
def test_sketched_vocabulary(spark, tracked):
    """The sketch gives the full counts or says that it cannot tell."""
    rows = [(f"w{k:03d} " * (200 // (k + 1)) + f"rare{k}",) for k in range(60)]
    docs = spark.createDataFrame(rows, "text string")
    full = [tuple(r) for r in top_terms(term_statistics(docs, []), 5).collect()]
    found = frequent_terms(docs, [], 5, tracked=tracked)
    if tracked > 100:
        assert found is not None
    if found is not None:
        assert [tuple(r) for r in found.collect()] == full
    assert [tuple(r) for r in fit_vocabulary(docs, 5, None, sketch=True).collect()] == [
        tuple(r) for r in fit_vocabulary(docs, 5, None).collect()
    ]


def test_sketch_of_equal_counts(spark):
    """Equally frequent terms at the cut are all known, or the terms are counted in full."""
    docs = spark.createDataFrame([(" ".join(f"t{k:04d}" for k in range(500)),)] * 3, "text string")
    found = frequent_terms(docs, [], 5, tracked=1000)
    assert found is None
    assert fit_vocabulary(docs, 5, None, sketch=True).count() == 5
    assert frequent_terms(docs.limit(0), [], 5) is None


@pytest.mark.parametrize("stop_words", ["english", None, ("tie",)])
def test_fit_with_stored_counts(spark, tmp_path, stop_words):
    """The vocabulary, to the last bit, and the vectors are those of ``fit_vectorizer``."""
    rows = [(i, f"the Tie of {'wool ' * (i % 3)}é{i % 5} and x ÉTÉ_{i % 7}", i % 2, "test" if i % 4 == 0 else "train")
            for i in range(60)]
    rows += [(60, "", 0, "train"), (61, "the", 1, "train"), (62, "the", 1, "test")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, label int, split string")
    train = docs.filter("split = 'train'")
    for n in (3, 100):
        path = str(tmp_path / f"counts{n}")
        got = vectorize.fit_counted(docs, path, n, stop_words)
        want = vectorize.fit_vectorizer(train, n, stop_words)
        assert got.vocabulary.orderBy("idx").collect() == want.vocabulary.orderBy("idx").collect()
        assert got.vocabulary.dtypes == want.vocabulary.dtypes
        weighed = got.weigh(spark.read.parquet(path)).select("doc_id", "label", "split", "features")
        cut = want.transform(docs).select("doc_id", "label", "split", "features")
        assert sorted(map(str, weighed.collect())) == sorted(map(str, cut.collect()))
        counted = want.count(docs).select("doc_id", vectorize.COUNTS).collect()
        assert sorted(map(str, counted)) == sorted(
            map(str, spark.read.parquet(path).select("doc_id", vectorize.COUNTS).collect())
        )
    with pytest.raises(ValueError, match="Empty vocabulary"):
        vectorize.fit_counted(docs.withColumn("text", F.lit("!")), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="Null documents"):
        vectorize.fit_counted(docs.withColumn("text", F.lit(None).cast("string")), str(tmp_path / "none"))
