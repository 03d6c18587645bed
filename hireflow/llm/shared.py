"""Helpers that several text operators use."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hireflow.session import scratch_path

#: Tables up to this many bytes may be broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = "[\\x20\\x09-\\x0D]+"


def whole_text(col: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A to Z only.

    ``lower`` does the same on texts without other letters and is far quicker; the
    character table is looked up only for the rest.
    """
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, upper, low)
    )


def words_of(col: Column, separators: str = SPACES) -> Column:
    """Array of the words between runs of separators; empty for an empty text."""
    return F.filter(F.split(col, separators), lambda w: w != "")


def spaced_words(text: Column) -> Column:
    """The same for ``SPACES``: every separator becomes a blank, and a text is split at blanks.

    Empty pieces have to be looked for only where two blanks meet.
    """
    for separator in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(separator), F.lit(" "))

    def cut(t: Column) -> Column:
        pieces = F.split(t, " ")
        return (
            F.when(t == "", F.array().cast("array<string>"))
            .when(F.contains(t, F.lit("  ")), F.filter(pieces, lambda w: w != ""))
            .otherwise(pieces)
        )

    return let(F.trim(text), cut)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write a table below the shared folder and read it back.

    Cuts lineage in a way that survives lost executors. The folder goes with the shared folder.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def bounded(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast when its counted size is below the bound, else as it is."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
