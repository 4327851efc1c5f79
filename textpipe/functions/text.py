"""Text expressions. All are built-in Spark expressions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as white space at the ends of a text.
# Spark's own trim() only knows U+0020.
WHITESPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# A token is a maximal run of two or more word characters in any script.
# Java's own \w is ASCII only.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Cell contents that a CSV scan reads as null, besides the empty string.
NA_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def is_blank(text: Column | str) -> Column:
    """True for a text of which nothing is left without its outer white space, false for a null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.rlike(text, F.lit(f"^{WHITESPACE}*$")), F.lit(False))


def null_if_na(cell: Column | str) -> Column:
    """Read the empty string and the NA tokens as null."""
    cell = F.col(cell) if isinstance(cell, str) else cell
    return F.when(~cell.isin("", *NA_TOKENS), cell)


def tokens(text: Column | str) -> Column:
    """Lower-case a text and cut it into its tokens, in reading order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def without_stop_words(token_array: Column | str, stop_words: list[str]) -> Column:
    """Drop the stop words from an array of tokens and keep repeats and order."""
    if not stop_words:
        return F.col(token_array) if isinstance(token_array, str) else token_array
    return F.filter(token_array, lambda token: ~token.isin(*stop_words))
