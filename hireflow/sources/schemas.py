"""Fixed raw contracts and one description per source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType] | str) -> T.StructType:
    struct = T.StructType()
    for field in fields:
        name, kind = (field, T.StringType()) if isinstance(field, str) else field
        struct.add(name, kind)
    return struct


_AUDIT: list = [
    ("_ingestion_ts", T.TimestampNTZType()),
    ("_ingestion_date", T.DateType()),
    "_batch_id",
    "_source_system",
    "_file_name",
    "_source_file_checksum",
    "_record_hash",
]
AUDIT_COLUMNS = _struct(*_AUDIT).names

# Column lists of the source files.
JOBS_FILE = _struct("job_id", "title", "department", "posted_date", "status")
CANDIDATES_FILE = _struct("candidate_id", "first_name", "last_name", "email", "phone", "skills")
EDUCATION_FILE = _struct("candidate_id", "degree", "institution", ("year", T.IntegerType()))
APPLICATIONS_FILE = _struct("application_id", "job_id", "candidate_id", "apply_date")
EVENTS_FILE = _struct("application_id", "old_status", "new_status", "event_timestamp")

# Column lists of the raw tables.
RAW = {
    "jobs": _struct(*JOBS_FILE.names, *_AUDIT),
    "candidates": _struct(
        "candidate_id", "first_name", "last_name", "email", "email_hash", "phone", "phone_hash",
        "skills", *_AUDIT,
    ),
    "education": _struct(
        "candidate_id", "degree", "institution", ("year", T.IntegerType()), *_AUDIT
    ),
    "applications": _struct(*APPLICATIONS_FILE.names, *_AUDIT),
    "workflow_events": _struct(
        "_event_id", *EVENTS_FILE.names, ("_event_date", T.DateType()), *_AUDIT
    ),
}

LEDGER = _struct(
    "batch_id", "source_name", "source_system", "file_name", "file_checksum", "load_strategy",
    "status", ("started_at", T.TimestampNTZType()), ("completed_at", T.TimestampNTZType()),
    ("rows_loaded", T.LongType()), "error_message",
)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    system: str
    file_name: str
    layout: str  # csv, json_array or jsonl
    strategy: str
    replay: str  # skip: a loaded batch is left alone; replace: it is written again
    columns: T.StructType
    key: str


# In load order.
SOURCES = {
    spec.name: spec
    for spec in [
        SourceSpec("applications", "application_daily_extract", "applications.csv", "csv",
                   "append_extract", "skip", APPLICATIONS_FILE, "application_id"),
        SourceSpec("education", "education_batch_file", "education.csv", "csv",
                   "batch_replace", "replace", EDUCATION_FILE, "candidate_id"),
        SourceSpec("candidates", "candidate_profile_snapshot", "candidates.json", "json_array",
                   "append_snapshot", "skip", CANDIDATES_FILE, "candidate_id"),
        SourceSpec("jobs", "job_requisition_snapshot", "jobs.csv", "csv",
                   "append_snapshot", "skip", JOBS_FILE, "job_id"),
        SourceSpec("workflow_events", "workflow_event_export", "workflow_events.jsonl", "jsonl",
                   "append_batch", "replace", EVENTS_FILE, "application_id"),
    ]
}
