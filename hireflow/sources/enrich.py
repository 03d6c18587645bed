"""Source columns plus lineage, identity and privacy columns, in contract order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.functions import hashing, lists
from hireflow.functions.dates import try_timestamp
from hireflow.sources.schemas import RAW, SourceSpec


def record_hash(source: str) -> Column:
    """Hash of the business columns of one source, NULL-safe."""
    columns = {
        "jobs": ["job_id", "title", "department", "posted_date", "status"],
        "education": ["candidate_id", "degree", "institution", "year"],
        "applications": ["application_id", "job_id", "candidate_id", "apply_date"],
        "workflow_events": ["application_id", "old_status", "new_status", "event_timestamp"],
        "candidates": ["candidate_id", "first_name", "last_name", "email", "phone"],
    }[source]
    parts = [F.col(c) for c in columns]
    if source == "candidates":
        parts.append(lists.order_free_csv(F.col("skills")))
    return hashing.stable_hash(*parts)


def event_id() -> Column:
    """An event is its four raw values; case counts, because it is hashed before cleaning."""
    return record_hash("workflow_events")


def lineage(spec: SourceSpec, batch_id: str, checksum: str, now: datetime) -> dict[str, Column]:
    return {
        "_ingestion_ts": F.lit(now).cast("timestamp_ntz"),
        "_ingestion_date": F.lit(now.date()),
        "_batch_id": F.lit(batch_id),
        "_source_system": F.lit(spec.system),
        "_source_file_checksum": F.lit(checksum),
    }


def to_contract(df: DataFrame, source: str, *more: str) -> DataFrame:
    """Exactly the contract's columns, by name and with its types, and any asked for besides."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            f.name if have.get(f.name) == f.dataType else F.col(f.name).cast(f.dataType)
            for f in RAW[source]
        ],
        *more,
    )


def with_identity(df: DataFrame, source: str) -> DataFrame:
    """Hashes and derived raw columns. ``skills`` arrives as text and leaves as comma text."""
    df = df.withColumn("_record_hash", record_hash(source))
    if source == "workflow_events":
        return df.withColumns(
            {
                "_event_id": F.col("_record_hash"),
                "_event_date": try_timestamp(F.col("event_timestamp")).cast("date"),
            }
        )
    if source == "candidates":
        return df.withColumns(
            {
                "email_hash": hashing.email_hash(F.col("email")),
                "phone_hash": hashing.phone_hash(F.col("phone")),
                "skills": lists.list_to_csv(F.col("skills")),
            }
        )
    return df


def enrich(
    df: DataFrame, spec: SourceSpec, batch_id: str, checksum: str, now: datetime, *more: str
) -> DataFrame:
    with_lineage = df.withColumns(lineage(spec, batch_id, checksum, now))
    return to_contract(with_identity(with_lineage, spec.name), spec.name, *more)
