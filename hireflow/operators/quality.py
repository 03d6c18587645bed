"""Data-quality checks. Each returns the failing rows; a check passes when there are none."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.functions.text import looks_like_email
from hireflow.operators.impacted import orphans

# Fixed values.
DEGREES = ["MS", "BS", "PHD"]
JOB_STATUSES = ["OPEN", "CLOSED", "DRAFT"]
EVENT_STATUSES = [
    "APPLIED", "SCREENING", "INTERVIEW", "OFFER", "WITHDRAWN", "REJECTED", "HIRED",
]
FRESHNESS_DAYS = {"warn": 2, "error": 7}
ROW_BOUNDS = {
    "jobs": (400, 600),
    "candidates": (1800, 2200),
    "education": (1800, 2200),
    "applications": (4500, 5500),
    "workflow_events": (15000, 18000),
}


# Row rules: true where a row fails. Undecided counts as passed.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: list[str]) -> Column:
    return ~F.col(column).isin(values)


def is_bad_email(column: str) -> Column:
    return ~looks_like_email(F.col(column))


# Checks.


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their number of rows."""
    return (
        df.filter(is_unaccepted(column, values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    return orphans(child, foreign_key, parent, key)


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    """The row count, if it lies outside the bounds."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(
        (F.col("row_count") < low) | (F.col("row_count") > high)
    )


def email_format(df: DataFrame, column: str = "email") -> DataFrame:
    return df.filter(is_bad_email(column))


def source_freshness(
    df: DataFrame,
    source: str,
    now: datetime,
    warn_days: int = FRESHNESS_DAYS["warn"],
    error_days: int = FRESHNESS_DAYS["error"],
) -> DataFrame:
    """One row: age of the newest load and pass, warn or error. No rows at all is an error."""
    moment = F.lit(now).cast("timestamp_ntz")
    newest = F.col("max_loaded_at")

    def older_than(days: int) -> Column:
        return newest < moment - F.expr(f"interval {days} days")

    return df.agg(F.max("_ingestion_ts").alias("max_loaded_at")).select(
        F.lit(source).alias("source"),
        newest,
        F.timestamp_diff("SECOND", newest, moment).alias("age_seconds"),
        F.when(newest.isNull() | older_than(error_days), "error")
        .when(older_than(warn_days), "warn")
        .otherwise("pass")
        .alias("status"),
    )
