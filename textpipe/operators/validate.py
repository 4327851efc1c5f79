"""Checks on the shape of a table and on the quality of its texts."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textpipe.functions.text import is_blank

logger = logging.getLogger(__name__)

# The wording of errors and warnings.
EMPTY = "DataFrame is empty"
TOO_FEW_ROWS = "DataFrame has {found} rows, minimum required: {minimum}"
MISSING_COLUMNS = "Missing required columns: {missing}"
NULL_TEXTS = "Found null values in %s column"
BLANK_TEXTS = "Found %d empty text entries"


# Up to this many rows, stopping at the first splits that hold them beats a full count.
TAKE_LIMIT = 1000


def count_up_to(df: DataFrame, n: int) -> int:
    """The number of rows if there are fewer than ``n``, else ``n`` or more."""
    if n > TAKE_LIMIT:
        return df.count()
    return len(df.select(F.lit(1)).take(n))


def validate_table(df: DataFrame, required_columns: Sequence[str], min_rows: int = 1) -> bool:
    """Raise ``ValueError`` for an empty or short table, or one without the columns."""
    found = count_up_to(df, max(min_rows, 1)) if df.columns else 0
    if found == 0:
        raise ValueError(EMPTY)
    if found < min_rows:
        raise ValueError(TOO_FEW_ROWS.format(found=found, minimum=min_rows))
    missing = [name for name in required_columns if name not in df.columns]
    if missing:
        raise ValueError(MISSING_COLUMNS.format(missing=missing))
    return True


def _quality(text_column: str) -> list[Column]:
    text = F.col(text_column)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(text.isNull()).alias("n_null"),
        F.count_if(is_blank(text)).alias("n_blank"),
    ]


def profile(df: DataFrame, text_column: str = "text") -> DataFrame:
    """One row with the number of rows, null texts and blank texts, in a single pass."""
    return df.agg(*_quality(text_column))


def observe_text(df: DataFrame, text_column: str = "text") -> tuple[DataFrame, Observation]:
    """Take the profile along with whatever reads the table next, without a pass of its own."""
    observation = Observation("text quality")
    return df.observe(observation, *_quality(text_column)), observation


def warn_about_text(found: Mapping[str, int], text_column: str = "text") -> None:
    """Warn about null and blank texts. They are reported and kept."""
    if found["n_null"]:
        logger.warning(NULL_TEXTS, text_column)
    if found["n_blank"]:
        logger.warning(BLANK_TEXTS, found["n_blank"])


def validate_text(df: DataFrame, text_column: str = "text") -> bool:
    """Profile the texts and warn."""
    warn_about_text(profile(df, text_column).first().asDict(), text_column)
    return True


def require_text(df: DataFrame, text_column: str = "text") -> None:
    """Raise ``ValueError`` if a text is null.

    The null test reaches the Parquet scan, which skips row groups without nulls by their
    statistics.
    """
    if not df.filter(F.col(text_column).isNull()).select(F.lit(1)).isEmpty():
        raise ValueError(f"Null documents in {text_column} column cannot be vectorized")
