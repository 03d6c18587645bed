"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode space separators, which SQL TRIM removes.
SPACES = "".join(map(chr, [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))

# Every character a text strip removes in the loaders.
WHITESPACE = SPACES + "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u2028\u2029"

# CSV cell texts that mean "missing".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

EMAIL_PATTERN = "%@%.%"


def clean(col: Column) -> Column:
    """TRIM as in SQL: outer space separators only."""
    return F.btrim(col, F.lit(SPACES))


def strip(col: Column) -> Column:
    """Remove all outer whitespace, line breaks and tabs included."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean_upper(col: Column) -> Column:
    return F.upper(clean(col))


def clean_lower(col: Column) -> Column:
    return F.lower(clean(col))


def null_if_token(col: Column) -> Column:
    return F.when(~col.isin(NULL_TOKENS), col)


def looks_like_email(col: Column) -> Column:
    return col.like(EMAIL_PATTERN)
