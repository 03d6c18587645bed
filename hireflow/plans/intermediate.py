"""Events in the context of their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.operators.impacted import history_of, with_flag
from hireflow.operators.skew import HotKeys, number_across_ranges, number_rows, split_hot


def timeline() -> list[Column]:
    """Undated events come last; the id settles equal times."""
    return [F.col("event_timestamp").asc_nulls_last(), F.col("event_id").asc()]


def hired_before_applying() -> Column:
    return (F.col("new_status") == "HIRED") & (F.col("event_timestamp") < F.col("apply_date"))


def with_apply_date(events: DataFrame, applications: DataFrame) -> DataFrame:
    """Events with their application's date (if any) and the anomaly flag."""
    dates = applications.select("application_id", "apply_date")
    return events.join(dates, "application_id", "left").withColumn(
        "is_anomaly", with_flag(hired_before_applying())
    )


def int_workflow_events_enriched(
    events: DataFrame,
    applications: DataFrame,
    hot: HotKeys | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Staged events plus apply date, anomaly flag and place in their application's timeline.

    Join and numbering share one shuffle on ``application_id``. Applications in ``hot`` are
    joined and numbered apart, spread over many tasks. With ``touched`` only the timelines of
    those applications are made.
    """
    key, place = "application_id", "event_sequence"
    known = events.filter(F.col(key).isNotNull())

    def wanted(part: DataFrame, keys: DataFrame | None) -> DataFrame:
        return part if keys is None else history_of(part, keys, key)

    if hot is None:
        enriched = number_rows(
            with_apply_date(wanted(known, touched), applications), key, timeline(), place
        )
    else:
        ordinary, big = split_hot(known, key, hot)
        few = hot.few(split_hot(applications, key, hot)[1])
        few_touched = touched
        if touched is not None:
            few_touched = hot.few(split_hot(touched, key, hot)[1].distinct())
        enriched = number_rows(
            with_apply_date(wanted(ordinary, touched), applications), key, timeline(), place
        ).unionByName(
            number_across_ranges(
                with_apply_date(wanted(big, few_touched), few), key, timeline(), place
            )
        )
    return enriched.select(
        "event_id", "application_id", "old_status", "new_status", "event_timestamp", "event_date",
        "apply_date", "is_anomaly", "event_sequence", "_ingestion_ts", "_ingestion_date",
        "_batch_id", "_source_system", "_file_name", "_source_file_checksum", "_record_hash",
        "_processed_ts",
    )
