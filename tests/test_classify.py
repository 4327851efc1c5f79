"""The classifier: optimality of the reference objective, labels, errors, persistence."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from textpipe.operators import classify
from textpipe.operators.classify import (
    load_classifier,
    predict,
    save_classifier,
    train_classifier,
)


def dense(spark, n, p, labels, seed=42):
    rng = np.random.default_rng(seed)
    x, y = rng.random((n, p)), rng.choice(labels, n)
    rows = [(i, Vectors.dense(x[i]), int(y[i])) for i in range(n)]
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("features", VectorUDT()),
            StructField("label", IntegerType()),
        ]
    )
    return spark.createDataFrame(rows, schema), x, y


def largest_gradient(model, x, y, labels, c=1.0):
    """Of mean log loss + |W|^2 / (2 C n), by weights and by intercepts."""
    solved = model.stages[0]
    w, b = solved.coefficientMatrix.toArray(), solved.interceptVector.toArray()
    n = len(y)
    if len(labels) == 2:
        p = 1 / (1 + np.exp(-(x @ w[0] + b[0])))
        error = (p - (y == labels[1]))[:, None]
    else:
        z = x @ w.T + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = p - (y[:, None] == np.array(labels))
    return abs(error.T @ x / n + w / (c * n)).max(), abs(error.mean(0)).max()


@pytest.mark.parametrize("labels", [[0, 1, 2, 3], [0, 1], [0, 5], [-3, 2, 9]])
@pytest.mark.parametrize("c", [1.0, 0.1])
def test_solution_is_the_optimum(spark, labels, c):
    df, x, y = dense(spark, 100, 50, labels)
    model = train_classifier(df, inverse_regularization=c, tol=1e-9)
    assert max(largest_gradient(model, x, y, labels, c)) < 1e-5
    got = {r.prediction for r in predict(model, df).collect()}
    assert got <= set(labels)


def test_default_tolerance_is_tighter_than_the_reference_stop(spark):
    df, x, y = dense(spark, 100, 50, [0, 1, 2, 3])
    assert max(largest_gradient(train_classifier(df), x, y, [0, 1, 2, 3])) < 1e-4


def test_prediction_is_the_largest_score(spark):
    labels = [1, 4, 6]
    df, x, _ = dense(spark, 90, 8, labels)
    model = train_classifier(df)
    solved = model.stages[0]
    scores = x @ solved.coefficientMatrix.toArray().T + solved.interceptVector.toArray()
    expected = np.array(labels)[scores.argmax(1)].tolist()
    rows = predict(model, df).orderBy("doc_id")
    assert rows.columns == ["doc_id", "features", "label", "prediction"]
    assert dict(rows.dtypes)["prediction"] == "int"
    assert [r.prediction for r in rows.collect()] == expected


def test_reload_predicts_the_same(spark, tmp_path):
    df, *_ = dense(spark, 100, 50, [0, 1, 2, 3])
    model = train_classifier(df)
    for _ in range(2):
        save_classifier(model, str(tmp_path / "m"))
    loaded = load_classifier(str(tmp_path / "m"))
    rows = [predict(m, df).orderBy("doc_id").select("prediction").collect() for m in (model, loaded)]
    assert rows[0] == rows[1]


def test_text_labels(spark):
    df, *_ = dense(spark, 60, 5, [0, 1, 2])
    named = df.withColumn("label", F.element_at(F.array(F.lit("it's"), F.lit("b\\c"), F.lit("d")), F.col("label") + 1))
    got = {r.prediction for r in predict(train_classifier(named), named).collect()}
    assert got <= {"it's", "b\\c", "d"} and len(got) > 1


def test_partitioning_does_not_change_the_predictions(spark):
    df, *_ = dense(spark, 120, 6, [0, 1, 2])
    rows = [
        predict(train_classifier(df.repartition(n), tol=1e-9), df).orderBy("doc_id").select("prediction").collect()
        for n in (1, 6)
    ]
    assert rows[0] == rows[1]


def test_nothing_stays_cached(spark):
    df, *_ = dense(spark, 40, 4, [0, 1])
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    train_classifier(df)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


@pytest.mark.parametrize(
    ("where", "message"),
    [("doc_id < 0", "empty table"), ("label = 0", "single class")],
)
def test_preconditions(spark, where, message):
    df, *_ = dense(spark, 50, 4, [0, 1])
    with pytest.raises(ValueError, match=message):
        train_classifier(df.filter(where))


def test_null_label(spark):
    df, *_ = dense(spark, 50, 4, [0, 1, 2])
    with pytest.raises(ValueError, match="null labels"):
        train_classifier(df.withColumn("label", F.when(F.col("label") > 0, F.col("label"))))


def test_solver_gets_large_blocks(spark, monkeypatch):
    """Every block costs a dense gradient, so that the default of 1 MB is too small for sparse rows."""
    given = {}

    class Solver(LogisticRegression):
        def __init__(self, **settings):
            given.update(settings)
            super().__init__(**settings)

    monkeypatch.setattr(classify, "LogisticRegression", Solver)
    rows = [(i % 2, Vectors.dense([float(i % 2), 1.0])) for i in range(20)]
    classify.train_classifier(spark.createDataFrame(rows, ["label", "features"]))
    assert given["maxBlockSizeInMB"] == classify.BLOCK_MB >= 16
