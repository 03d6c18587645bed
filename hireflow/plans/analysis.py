"""Hiring questions over the staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def open_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("status") == "OPEN").agg(F.count(F.lit(1)).alias("open_jobs"))


def jobs_per_candidate(applications: DataFrame) -> DataFrame:
    return applications.groupBy("candidate_id").agg(
        F.countDistinct("job_id").alias("jobs_applied")
    )


def eager_candidate_count(applications: DataFrame, more_than: int = 3) -> DataFrame:
    """How many candidates applied to more than the given number of distinct jobs."""
    eager = jobs_per_candidate(applications).filter(F.col("jobs_applied") > more_than)
    return eager.agg(F.count(F.lit(1)).alias(f"candidates_with_more_than_{more_than}_jobs"))


def eager_candidates(
    applications: DataFrame, candidates: DataFrame, more_than: int = 3
) -> DataFrame:
    """The same candidates with name and email. Counting comes first, so the join is small."""
    eager = jobs_per_candidate(applications).filter(F.col("jobs_applied") > more_than)
    people = candidates.select("candidate_id", "first_name", "last_name", "email")
    return (
        people.join(eager, "candidate_id")
        .select("candidate_id", "first_name", "last_name", "email", "jobs_applied")
        .orderBy(F.col("jobs_applied").desc(), F.col("candidate_id").asc())
    )


def top_departments(applications: DataFrame, jobs: DataFrame, k: int = 5) -> DataFrame:
    """Departments by applications. Applications are counted per job before the join."""
    per_job = applications.groupBy("job_id").agg(F.count("application_id").alias("n"))
    return (
        per_job.join(jobs.select("job_id", "department"), "job_id")
        .groupBy("department")
        .agg(F.sum("n").alias("total_applications"))
        .orderBy(F.col("total_applications").desc(), F.col("department").asc_nulls_last())
        .limit(k)
    )


def register_views(spark, **tables: DataFrame) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
