"""Accuracy and the per-class report.

Everything is derived from the confusion counts, the only pass over the predictions. They
take any table with a label and a prediction column, whatever made the predictions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Row names, headings and titles of the report.
ACCURACY, MACRO, WEIGHTED = "accuracy", "macro avg", "weighted avg"
REPORT_HEADINGS = ("precision", "recall", "f1-score", "support")
ACCURACY_LINE = "Accuracy: {:.4f}"
REPORT_TITLE = "Classification Report:"


def confusion_counts(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per pair of label and prediction."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def report_labels(confusion: DataFrame) -> DataFrame:
    """Labels that occur as a label or as a prediction."""
    return confusion.select(F.explode(F.array("label", "prediction")).alias("label")).distinct()


def accuracy(confusion: DataFrame) -> DataFrame:
    """One row: the share of right predictions."""
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0))
    return confusion.agg((right / F.sum("n_rows")).alias("accuracy"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each label; a zero denominator gives 0.0."""
    n = F.col("n_rows")
    zero = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col("label").alias("label"),
        F.when(F.col("label") == F.col("prediction"), n).otherwise(zero).alias("right"),
        zero.alias("predicted"),
        n.alias("support"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("label"),
        zero.alias("right"),
        n.alias("predicted"),
        zero.alias("support"),
    )
    sums = (
        confusion.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("label")
        .agg(*(F.sum(name).alias(name) for name in ("right", "predicted", "support")))
    )
    right, predicted, support = F.col("right"), F.col("predicted"), F.col("support")
    return sums.select(
        "label",
        "right",
        _ratio(right, predicted).alias("precision"),
        _ratio(right, support).alias("recall"),
        _ratio(2 * right, predicted + support).alias("f1_score"),
        "support",
    )


def class_report(confusion: DataFrame) -> DataFrame:
    """The class rows, then accuracy, macro and weighted averages, in one aggregation.

    Each class row is copied into the four rows it contributes to. A label that occurs only
    as a prediction counts in the macro average.
    """
    classes = class_metrics(confusion)
    places = F.array(F.col("label").cast("string"), F.lit(ACCURACY), F.lit(MACRO), F.lit(WEIGHTED))
    copies = classes.select("*", F.posexplode(places).alias("place", "row_name"))
    place, support = F.max("place"), F.sum("support")

    def column(name: str) -> Column:
        plain = F.avg(name)
        weighted = _ratio(F.sum(F.col(name) * F.col("support")), support)
        value = F.when(place == 3, weighted).when(place != 1, plain)
        if name == "f1_score":
            value = value.otherwise(_ratio(F.sum("right"), support))
        return value.alias(name)

    return copies.groupBy("row_name").agg(
        column("precision"),
        column("recall"),
        column("f1_score"),
        support.alias("support"),
        place.alias("place"),
        F.min(F.when(F.col("place") == 0, F.col("label"))).alias("label"),
    )


def report_lines(rows: list[Row], digits: int = 2) -> list[str]:
    """The rows of a report, in order, as lines of text."""
    # The first column fits the longest row name.
    width = max(len(row.row_name) for row in rows)

    def line(name: str, cells: Iterable[str]) -> str:
        return f"{name:>{width}}  " + " ".join(f"{cell:>9}" for cell in cells)

    def number(value: float | None) -> str:
        return "" if value is None else f"{value:.{digits}f}"

    def row_line(row: Row) -> str:
        shares = map(number, (row.precision, row.recall, row.f1_score))
        return line(row.row_name, [*shares, str(row.support)])

    classes = [row_line(row) for row in rows if row.place == 0]
    totals = [row_line(row) for row in rows if row.place > 0]
    return [line("", REPORT_HEADINGS), "", *classes, "", *totals]


def metrics_lines(report: DataFrame) -> list[str]:
    """The metrics file: accuracy with four digits, a blank line and the report.

    Fetches the report, one row per class and the three summary rows.
    """
    rows = report.orderBy("place", "label").collect()
    share = next(row.f1_score for row in rows if row.row_name == ACCURACY)
    return [ACCURACY_LINE.format(share), "", REPORT_TITLE, *report_lines(rows)]


def write_metrics_text(report: DataFrame, path: str) -> None:
    """Write the metrics file: one line per class and a few more."""
    spark = report.sparkSession
    lines = [(line,) for line in metrics_lines(report)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)
