from __future__ import annotations

import logging

import pytest

from textpipe.operators.validate import (
    observe_text,
    profile,
    require_text,
    validate_table,
    validate_text,
)


def texts(spark, *values, column="text"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def test_valid_table(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "text string, label int")
    assert validate_table(df, ["text", "label"], 2) is True


@pytest.mark.parametrize(
    ("rows", "schema", "min_rows", "message"),
    [
        ([], "text string, label int", 1, "DataFrame is empty"),
        ([], "body string", 100, "DataFrame is empty"),
        ([("a", 0)], "text string, label int", 5, "DataFrame has 1 rows, minimum required: 5"),
        ([("a", 0)], "body string, topic int", 100, "DataFrame has 1 rows, minimum required: 100"),
        ([("a", 0), ("b", 1)], "text string, topic int", 1, r"Missing required columns: \['label'\]"),
        ([("a", 0)], "x string, y int", 1, r"Missing required columns: \['text', 'label'\]"),
        ([("a", 0)], "text string, label int", 5000, "DataFrame has 1 rows, minimum required: 5000"),
    ],
)
def test_invalid_table(spark, rows, schema, min_rows, message):
    with pytest.raises(ValueError, match=message):
        validate_table(spark.createDataFrame(rows, schema), ["text", "label"], min_rows)


def test_table_without_columns(spark):
    with pytest.raises(ValueError, match="DataFrame is empty"):
        validate_table(spark.range(3).drop("id"), [])


def test_text_warnings(spark, caplog):
    with caplog.at_level(logging.WARNING):
        assert validate_text(texts(spark, "a", None, "", "   ", "b")) is True
    assert caplog.messages == ["Found null values in text column", "Found 2 empty text entries"]


def test_clean_text_and_other_column(spark, caplog):
    with caplog.at_level(logging.WARNING):
        assert validate_text(texts(spark, "a", "b", "c", column="body"), "body") is True
    assert caplog.messages == []


def test_null_is_not_blank(spark):
    assert profile(texts(spark, None, None, "\u00a0", "x")).first().asDict() == {
        "n_rows": 4, "n_null": 2, "n_blank": 1,
    }


def test_observation_agrees_with_profile(spark, tmp_path):
    df = texts(spark, *(["x", None, " "] * 50)).repartition(7)
    observed, found = observe_text(df)
    observed.write.parquet(str(tmp_path / "t"))
    assert found.get == profile(df).first().asDict()


def test_require_text(spark):
    require_text(texts(spark, "a", ""))
    with pytest.raises(ValueError, match="Null documents"):
        require_text(texts(spark, "a", None))
