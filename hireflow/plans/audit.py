"""Persisted anomalies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from hireflow.functions.dates import days_between
from hireflow.plans.intermediate import hired_before_applying
from hireflow.plans.staging import stamp


def hired_before_applied(events: DataFrame, applications: DataFrame) -> DataFrame:
    """HIRED events dated before their application. The comparison is part of the join."""
    hires = events.filter(F.col("new_status") == "HIRED")
    dates = applications.select("application_id", "apply_date")
    return hires.join(dates, "application_id").filter(hired_before_applying())


def dq_hired_before_applied_anomalies(
    events: DataFrame, applications: DataFrame, now: datetime | None = None
) -> DataFrame:
    return _described(hired_before_applied(events, applications), now)


def anomalies_of_timeline(enriched_events: DataFrame, now: datetime | None = None) -> DataFrame:
    """The same from events that carry their apply date and flag, without a join."""
    return _described(enriched_events.filter("is_anomaly"), now)


def _described(anomalies: DataFrame, now: datetime | None) -> DataFrame:
    return anomalies.select(
        "event_id", "application_id", "old_status", "new_status", "event_timestamp", "apply_date",
        days_between(F.col("event_timestamp"), F.col("apply_date")).alias("days_before_apply"),
        "_ingestion_date", "_batch_id",
        stamp(now).alias("detected_at"),
    )
