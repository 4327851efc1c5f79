"""The report against direct definitions, and its text."""

from __future__ import annotations

import random

import pytest

from textpipe.operators.metrics import (
    accuracy,
    class_report,
    confusion_counts,
    metrics_lines,
    report_labels,
    write_metrics_text,
)


def report(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, prediction int")
    return class_report(confusion_counts(df))


def python_report(pairs):
    def ratio(a, b):
        return a / b if b else 0.0

    labels = sorted({x for pair in pairs for x in pair})
    rows, n = {}, len(pairs)
    for c in labels:
        tp = sum(y == p == c for y, p in pairs)
        pp, support = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
        rows[str(c)] = (ratio(tp, pp), ratio(tp, support), ratio(2 * tp, pp + support), support)
    classes = list(rows.values())
    rows["macro avg"] = (*(sum(r[i] for r in classes) / len(classes) for i in range(3)), n)
    rows["weighted avg"] = (*(sum(r[i] * r[3] for r in classes) / n for i in range(3)), n)
    rows["accuracy"] = (None, None, sum(y == p for y, p in pairs) / n, n)
    return rows


def random_pairs(seed):
    rng = random.Random(seed)
    true, predicted = rng.choice([([0, 1], [0, 1, 2]), ([0, 1, 2, 3], [0, 3]), ([5], [0, 5, -1])])
    return [(rng.choice(true), rng.choice(predicted)) for _ in range(rng.choice([1, 9, 200]))]


@pytest.mark.parametrize("seed", range(6))
def test_report_values(spark, seed):
    pairs = random_pairs(seed)
    got = {r.row_name: r for r in report(spark, pairs).collect()}
    expected = python_report(pairs)
    assert got.keys() == expected.keys()
    for name, (precision, recall, f1, support) in expected.items():
        row = got[name]
        assert row.precision == pytest.approx(precision) and row.recall == pytest.approx(recall)
        assert row.f1_score == pytest.approx(f1) and row.support == support
    assert got["weighted avg"].recall == pytest.approx(got["accuracy"].f1_score)
    assert sum(r.support for r in got.values() if r.place == 0) == len(pairs)


def test_accuracy_is_the_mean_of_equal_pairs(spark):
    pairs = random_pairs(2)
    counts = confusion_counts(spark.createDataFrame(pairs, "label int, prediction int"))
    expected = sum(y == p for y, p in pairs) / len(pairs)
    assert accuracy(counts).first()[0] == pytest.approx(expected, abs=1e-12)


def test_perfect_predictions(spark):
    rows = {r.row_name: r for r in report(spark, [(i % 4, i % 4) for i in range(10)]).collect()}
    assert rows["accuracy"].f1_score == rows["macro avg"].precision == 1.0


def test_label_that_is_only_predicted(spark):
    counts = confusion_counts(spark.createDataFrame([(0, 2), (1, 1)], "label int, prediction int"))
    assert sorted(r.label for r in report_labels(counts).collect()) == [0, 1, 2]
    rows = {r.row_name: r for r in class_report(counts).collect()}
    assert tuple(rows["2"])[1:5] == (0.0, 0.0, 0.0, 0)
    assert rows["macro avg"].f1_score == pytest.approx(1 / 3)


def test_other_column_names(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "actual int, guess int")
    assert accuracy(confusion_counts(df, "actual", "guess")).first()[0] == 0.5


EXPECTED = """\
Accuracy: 0.6000

Classification Report:
              precision    recall  f1-score   support

           0       0.50      1.00      0.67         1
           1       0.00      0.00      0.00         1
           2       1.00      0.67      0.80         3
          10       0.00      0.00      0.00         0

    accuracy                           0.60         5
   macro avg       0.38      0.42      0.37         5
weighted avg       0.70      0.60      0.61         5
"""


def test_text_of_the_report(spark, tmp_path):
    table = report(spark, [(0, 0), (1, 0), (2, 10), (2, 2), (2, 2)])
    assert "\n".join(metrics_lines(table)) + "\n" == EXPECTED
    path = str(tmp_path / "metrics.txt")
    for _ in range(2):
        write_metrics_text(table, path)
    assert spark.read.text(path, wholetext=True).first()[0] == EXPECTED


def test_one_pass_over_the_predictions(spark):
    """Only the confusion counts read the predictions; the report never joins."""
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    plan = class_report(confusion_counts(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Join" not in plan and "Cartesian" not in plan
