"""Cleaned, typed, one row per business key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.functions import lists
from hireflow.functions.dates import parse_mixed_date, try_timestamp
from hireflow.functions.text import clean, clean_lower, clean_upper
from hireflow.operators.latest import newest_snapshot
from hireflow.sources.schemas import AUDIT_COLUMNS


def stamp(now: datetime | None) -> Column:
    """One processing time per run; the clock of the query when none is given."""
    return F.localtimestamp() if now is None else F.lit(now).cast("timestamp_ntz")


def _staged(newest: DataFrame, columns: list[Column | str], now: datetime | None) -> DataFrame:
    return newest.select(*columns, *AUDIT_COLUMNS, stamp(now).alias("_processed_ts"))


def stg_jobs(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _staged(
        newest_snapshot(raw, "job_id"),
        [
            "job_id",
            clean(F.col("title")).alias("title"),
            clean_upper(F.col("department")).alias("department"),
            clean_upper(F.col("status")).alias("status"),
            parse_mixed_date(F.col("posted_date")).alias("posted_date"),
        ],
        now,
    )


def stg_candidates(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    listed = newest_snapshot(raw, "candidate_id").withColumn(
        "skills_array", lists.sorted_items(F.col("skills"))
    )
    return _staged(
        listed,
        [
            "candidate_id",
            clean(F.col("first_name")).alias("first_name"),
            clean(F.col("last_name")).alias("last_name"),
            clean_lower(F.col("email")).alias("email"),
            "email_hash",
            clean(F.col("phone")).alias("phone"),
            "phone_hash",
            "skills",
            "skills_array",
            F.array_join("skills_array", ",").alias("skills_normalized"),
            lists.item_count(F.col("skills_array")).alias("skills_count"),
        ],
        now,
    )


def stg_educations(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _staged(
        newest_snapshot(raw, "candidate_id"),
        [
            "candidate_id",
            clean_upper(F.col("degree")).alias("degree"),
            clean(F.col("institution")).alias("institution"),
            "year",
        ],
        now,
    )


def stg_applications(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _staged(
        newest_snapshot(raw, "application_id"),
        [
            "application_id",
            "job_id",
            "candidate_id",
            parse_mixed_date(F.col("apply_date")).alias("apply_date"),
        ],
        now,
    )


def stg_workflow_events(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    at = try_timestamp(F.col("event_timestamp"))
    return _staged(
        newest_snapshot(raw, "_event_id"),
        [
            F.col("_event_id").alias("event_id"),
            "application_id",
            clean_upper(F.col("old_status")).alias("old_status"),
            clean_upper(F.col("new_status")).alias("new_status"),
            at.alias("event_timestamp"),
            at.cast("date").alias("event_date"),
        ],
        now,
    )
