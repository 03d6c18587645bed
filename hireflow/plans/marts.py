"""Dimensions, facts and the time-to-hire aggregate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from hireflow.functions.dates import days_between
from hireflow.plans.staging import stamp


def dim_job(jobs: DataFrame, now: datetime | None = None) -> DataFrame:
    """Current state per job. Staged jobs are unique already, so there is nothing to dedupe."""
    return jobs.select(
        "job_id", "title", "department", "posted_date", "status", stamp(now).alias("_updated_at")
    )


def dim_candidate(
    candidates: DataFrame, educations: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Current state per candidate with education as a JSON object, absent values as null."""
    school = educations.select("candidate_id", "degree", "institution", "year")
    education = F.to_json(
        F.struct("degree", "institution", "year"), {"ignoreNullFields": "false"}
    )
    return candidates.join(school, "candidate_id", "left").select(
        "candidate_id", "first_name", "last_name", "email", "email_hash", "phone", "phone_hash",
        F.col("skills_array").alias("skills"),
        education.alias("education"),
        stamp(now).alias("_updated_at"),
    )


def application_outcomes(enriched_events: DataFrame) -> DataFrame:
    """First valid hire and newest status per application in one aggregation.

    The newest status is that of the last dated event, or of the last one if none is dated. An
    anomalous hire counts as status but not as hire.
    """
    valid_hire = (F.col("new_status") == "HIRED") & ~F.col("is_anomaly")
    recency = F.struct(F.col("event_timestamp").isNotNull(), F.col("event_sequence"))
    return enriched_events.groupBy("application_id").agg(
        F.min(F.when(valid_hire, F.col("event_timestamp"))).alias("hired_date"),
        F.max_by("new_status", recency).alias("current_status"),
    )


def fct_applications(
    applications: DataFrame, enriched_events: DataFrame, now: datetime | None = None
) -> DataFrame:
    outcomes = application_outcomes(enriched_events)
    return applications.join(outcomes, "application_id", "left").select(
        "application_id", "job_id", "candidate_id", "apply_date", "hired_date", "current_status",
        F.col("hired_date").isNotNull().alias("is_hired"),
        days_between(F.col("apply_date"), F.col("hired_date")).alias("time_to_hire_days"),
        "_ingestion_ts", "_ingestion_date", "_batch_id",
        stamp(now).alias("_updated_at"),
    )


def fct_workflow_events(enriched_events: DataFrame, now: datetime | None = None) -> DataFrame:
    return enriched_events.select(
        "event_id", "application_id", "old_status", "new_status", "event_timestamp", "event_date",
        "event_sequence", "is_anomaly", "_ingestion_ts", "_ingestion_date", "_batch_id",
        stamp(now).alias("_updated_at"),
    )


def hires_per_job(facts: DataFrame) -> DataFrame:
    """Counts and sums of hired applications, one row per job of the facts."""
    days = F.col("time_to_hire_days")
    return (
        facts.filter("is_hired")
        .groupBy(F.col("job_id").alias("fact_job_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(days).alias("n_days"),
            F.sum(days).alias("days"),
            F.min(days).alias("lo"),
            F.max(days).alias("hi"),
        )
    )


def describe_hires(
    per_job: DataFrame, jobs: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Figures per known job; jobs missing from the dimension form one NULL group."""
    described = jobs.select("job_id", "title", "department")
    return _figures(
        per_job.join(described, F.col("fact_job_id") == F.col("job_id"), "left"), now
    )


def _figures(described: DataFrame, now: datetime | None) -> DataFrame:
    return (
        described.groupBy("job_id", "title", "department")
        .agg(
            F.sum("n").alias("applications_count"),
            F.sum("n").alias("hired_applications_count"),
            F.try_divide(F.sum("days"), F.sum("n_days")).alias("avg_time_to_hire_days"),
            F.min("lo").alias("min_time_to_hire_days"),
            F.max("hi").alias("max_time_to_hire_days"),
        )
        .withColumn("_updated_at", stamp(now))
    )


def agg_time_to_hire_by_job_department(
    facts: DataFrame, jobs: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Time-to-hire figures of hired applications per job.

    Facts are summed up per job before the dimension is joined, so the join sees one row per job
    however many applications a job has.
    """
    return describe_hires(hires_per_job(facts), jobs, now)


def hire_counts(changes: DataFrame) -> DataFrame:
    """How many hires of each job took how many days, from facts that came and went (``_change``).

    The days are kept apart because the least and the greatest cannot be taken back otherwise.
    """
    by = ["job_id", "time_to_hire_days"]
    counted = changes.filter("is_hired").groupBy(*by).agg(F.sum("_change").alias("n"))
    key = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    return counted.select(key.alias("hire_key"), *by, "n")


def hires_of_counts(counts: DataFrame) -> DataFrame:
    """The sums of :func:`hires_per_job` from such counts."""
    n, days = F.col("n"), F.col("time_to_hire_days")
    return (
        counts.filter(n > 0)
        .groupBy(F.col("job_id").alias("fact_job_id"))
        .agg(
            F.sum(n).alias("n"),
            F.coalesce(F.sum(F.when(days.isNotNull(), n)), F.lit(0)).alias("n_days"),
            F.sum(n * days).alias("days"),
            F.min(days).alias("lo"),
            F.max(days).alias("hi"),
        )
    )


# -- incremental aggregate -------------------------------------------------------------------------


def jobs_of_changed_facts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Jobs whose figures can differ between two states of the facts, old and new job alike."""
    seen = ["application_id", "job_id", "is_hired", "time_to_hire_days"]
    old, new = before.select(*seen, F.lit(-1).alias("d")), after.select(*seen, F.lit(1).alias("d"))
    return (
        old.unionByName(new)
        .groupBy(*seen)
        .agg(F.sum("d").alias("d"))
        .filter(F.col("d") != 0)
        .select("job_id")
        .distinct()
    )


def refresh_time_to_hire(
    previous: DataFrame,
    facts: DataFrame,
    jobs: DataFrame,
    impacted_jobs: DataFrame,
    now: datetime | None = None,
) -> DataFrame:
    """The aggregate with only impacted jobs recomputed.

    A job is impacted if its facts changed, and if its row in the dimension is new, has another
    title or department, or is gone. The NULL group collects hires of unknown jobs and is made anew
    every time, so a job that becomes known leaves it. Facts are read once and summed up per job
    first, so a job with very many applications is one row in the joins.
    """
    known = previous.filter(F.col("job_id").isNotNull()).select(
        "job_id",
        F.struct("title", "department").alias("_was"),
    )
    changed = impacted_jobs.select("job_id", F.lit(True).alias("_changed")).distinct()
    dimension = (
        jobs.select("job_id", "title", "department")
        .join(known, "job_id", "left")
        .join(changed, "job_id", "left")
        .withColumn(
            "_redo",
            F.coalesce("_changed", F.lit(False))
            | ~F.struct("title", "department").eqNullSafe(F.col("_was")),
        )
        .select("job_id", "title", "department", "_redo")
    )
    described = hires_per_job(facts).join(
        dimension, F.col("fact_job_id") == F.col("job_id"), "left"
    )
    fresh = _figures(described.filter(F.col("job_id").isNull() | F.col("_redo")), now)
    untouched = previous.join(dimension.filter(~F.col("_redo")), "job_id", "left_semi")
    return untouched.unionByName(fresh)
