"""The given star-schema tables seen as the five hiring sources.

Every source uses all rows of its tables. Arrival days and text layouts follow from columns of
the row, so three run days, mixed dates, noisy casing, repeated events, orphans and anomalies all
occur.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hireflow.functions.hashing import stable_hash
from hireflow.operators.skew import HotKeys, hot_keys
from hireflow.plans import intermediate, marts, staging
from hireflow.session import scratch_path
from hireflow.sources.enrich import to_contract, with_identity
from hireflow.sources.schemas import SOURCES

DAYS = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
NOW = datetime(2024, 1, 4, 12)

STATUSES = ["Applied", "Screening", "Interview", "Offer", "Withdrawn", "Rejected", "Hired"]
JOB_LAYOUTS = {
    "ECONOMY": "yyyy-MM-dd",
    "MEDIUM": "yyyy/MM/dd",
    "STANDARD": "yyyy.MM.dd",
    "PROMO": "dd-MMM-yyyy",
    "SMALL": "MMMM dd, yyyy",
    "LARGE": "MM/dd/yyyy",
}
APPLY_LAYOUTS = {
    "1-URGENT": "yyyy-MM-dd",
    "2-HIGH": "yyyy/MM/dd",
    "3-MEDIUM": "yyyy.MM.dd",
    "4-NOT SPECIFIED": "dd-MMM-yyyy",
    "5-LOW": "MMMM dd, yyyy",
}


# Schemas of the given tables, so that reading one needs no look at its footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(col: Column, choices: dict, fallback=None) -> Column:
    picked = reduce(
        lambda acc, kv: acc.when(col == kv[0], kv[1]), choices.items(), F.when(F.lit(False), None)
    )
    return picked if fallback is None else picked.otherwise(fallback)


def _render(day: Column, by: Column, layouts: dict[str, str]) -> Column:
    return _pick(by, {k: F.date_format(day, layout) for k, layout in layouts.items()})


def _arrived(by: Column, days: dict) -> Column:
    return _pick(by, {k: F.lit(DAYS[i]) for k, i in days.items()})


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots: all jobs as drafts, then all jobs in their final state."""
    part = table(spark, sf_dir, "part")
    job_id = F.col("p_partkey").cast("string").alias("job_id")
    posted = F.date_add(F.lit(date(1995, 1, 1)), F.col("p_size") * 29)
    drafts = part.select(
        job_id,
        F.col("p_name").alias("title"),
        F.lower("p_type").alias("department"),
        F.date_format(posted, "yyyy-MM-dd").alias("posted_date"),
        F.lit("Draft").alias("status"),
        F.lit(DAYS[0]).alias("_ingestion_date"),
    )
    final = part.select(
        job_id,
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("title"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit(" "), F.lower("p_type"))).alias(
            "department"
        ),
        _render(posted, F.col("p_type"), JOB_LAYOUTS).alias("posted_date"),
        F.when(F.col("p_size") <= 17, "Open").when(F.col("p_size") <= 34, " closed ").otherwise(
            "Draft"
        ).alias("status"),
        F.lit(DAYS[1]).alias("_ingestion_date"),
    )
    return drafts.unionByName(final)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and suppliers as people who never apply and list no skills."""

    def people(df: DataFrame, prefix: str, skills: Column, day: date) -> DataFrame:
        name = F.col(f"{prefix}_name")
        key = F.col("c_custkey" if prefix == "c" else "s_suppkey").cast("string")
        host = F.when(F.col(f"{prefix}_acctbal") < 0, "@invalid").otherwise("@Example.COM ")
        return df.select(
            (key if prefix == "c" else F.concat(F.lit("S"), key)).alias("candidate_id"),
            F.concat(F.lit(" "), F.split_part(name, F.lit("#"), F.lit(1))).alias("first_name"),
            F.concat(F.split_part(name, F.lit("#"), F.lit(2)), F.lit(" ")).alias("last_name"),
            F.concat(F.lit(" "), F.replace(name, F.lit("#"), F.lit("-")), host).alias("email"),
            F.concat(F.lit(" +1-"), F.col(f"{prefix}_nationkey"), F.lit("-"), key).alias("phone"),
            skills.alias("skills"),
            F.lit(day).alias("_ingestion_date"),
        )

    skills = F.to_json(F.array("c_mktsegment", F.lit(" spark"), F.lit("sql ")))
    return people(table(spark, sf_dir, "customer"), "c", skills, DAYS[0]).unionByName(
        people(table(spark, sf_dir, "supplier"), "s", F.lit(None).cast("string"), DAYS[1])
    )


def education(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per customer; suppliers have none."""
    degrees = {
        "BUILDING": "bs", "MACHINERY": " MS", "AUTOMOBILE": "PhD ", "FURNITURE": "BS",
        "HOUSEHOLD": "Diploma",
    }
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("candidate_id"),
            _pick(F.col("c_mktsegment"), degrees).alias("degree"),
            F.concat(F.lit(" "), "n_name").alias("institution"),
            (F.col("c_nationkey") + 1990).cast("int").alias("year"),
            F.lit(DAYS[0]).alias("_ingestion_date"),
        )
    )


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("application_id"),
        F.floor(F.col("o_orderkey") * 2 / 15).cast("string").alias("job_id"),
        F.col("o_custkey").cast("string").alias("candidate_id"),
        _render(F.col("o_orderdate"), F.col("o_orderpriority"), APPLY_LAYOUTS).alias("apply_date"),
        _arrived(F.col("o_orderstatus"), {"F": 0, "O": 1, "P": 2}).alias("_ingestion_date"),
    )


def workflow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    new = _pick(line, {i + 1: s for i, s in enumerate(STATUSES)})
    old = _pick(line, {i + 2: s for i, s in enumerate(STATUSES[:-1])})
    noisy = F.col("l_linestatus") == "O"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("application_id"),
        F.when(noisy, F.concat(F.lit(" "), F.upper(old))).otherwise(old).alias("old_status"),
        F.when(noisy, F.concat(F.lit(" "), F.upper(new))).otherwise(new).alias("new_status"),
        F.when(
            F.col("l_returnflag") == "N", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
        ).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("event_timestamp"),
        _arrived(F.col("l_returnflag"), {"A": 0, "R": 1, "N": 2}).alias("_ingestion_date"),
    )


_FILES = {
    "jobs": jobs,
    "candidates": candidates,
    "education": education,
    "applications": applications,
    "workflow_events": workflow_events,
}


def file_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return _FILES[source](spark, sf_dir)


#: Later days, on each of which one application of a hundred is hired late.
LATE_DAYS = [date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)]
LATE_BY = 400


def late_hires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hires of one application of a hundred a day, ``LATE_BY`` days after it was made."""
    kind = F.col("o_orderkey") % 100
    days = {i: F.lit(day) for i, day in enumerate(LATE_DAYS)}
    return table(spark, sf_dir, "orders").where(kind < len(LATE_DAYS)).select(
        F.col("o_orderkey").cast("string").alias("application_id"),
        F.lit(None).cast("string").alias("old_status"),
        F.lit("Hired").alias("new_status"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), LATE_BY), "yyyy-MM-dd").alias(
            "event_timestamp"
        ),
        _pick(kind, days).alias("_ingestion_date"),
    )


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """A source as raw table: each day's rows are one batch, received at six in the morning."""
    return _received(file_rows(spark, sf_dir, source), source)


def raw_with_late_hires(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    rows = file_rows(spark, sf_dir, source)
    if source == "workflow_events":
        rows = rows.unionByName(late_hires(spark, sf_dir))
    return _received(rows, source)


def _received(rows: DataFrame, source: str) -> DataFrame:
    spec = SOURCES[source]
    day = F.col("_ingestion_date")
    received = rows.withColumns(
        {
            "_ingestion_ts": day.cast("timestamp_ntz") + F.expr("interval 6 hours"),
            "_batch_id": stable_hash(F.lit(source), day),
            "_source_system": F.lit(spec.system),
            "_file_name": F.lit(spec.file_name),
            "_source_file_checksum": F.md5(F.lit(spec.file_name)),
        }
    )
    return to_contract(with_identity(received, source), source)


def staged(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    transform = {
        "jobs": staging.stg_jobs,
        "candidates": staging.stg_candidates,
        "education": staging.stg_educations,
        "applications": staging.stg_applications,
        "workflow_events": staging.stg_workflow_events,
    }[source]
    return transform(raw(spark, sf_dir, source), NOW)


def hot_applications(spark: SparkSession, sf_dir: str) -> HotKeys | None:
    """Counted before deduplication, which can only list too many."""
    return hot_keys(raw(spark, sf_dir, "workflow_events"), "application_id")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_workflow_events_enriched(
        staged(spark, sf_dir, "workflow_events"),
        staged(spark, sf_dir, "applications"),
        hot_applications(spark, sf_dir),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_applications(
        staged(spark, sf_dir, "applications"), enriched(spark, sf_dir), NOW
    )


def time_to_hire(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = marts.dim_job(staged(spark, sf_dir, "jobs"), NOW)
    return marts.agg_time_to_hire_by_job_department(facts(spark, sf_dir), dim, NOW)


# -- source files ------------------------------------------------------------------------------------


def _json_array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one JSON array per partition."""
    first = True
    for batch in batches:
        lines = "," + batch["value"]
        if first and len(lines):
            lines.iloc[0] = "[" + lines.iloc[0][1:]
            first = False
        yield lines.to_frame("value")
    if not first:
        yield pd.DataFrame({"value": ["]"]})


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One file with one JSON array per partition of the frame."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).mapInPandas(
        _json_array_lines, "value string"
    ).write.text(path)


_roots: dict[tuple[str, str], str] = {}
_written: set[tuple[str, str]] = set()


def source_files(spark: SparkSession, sf_dir: str, *sources: str) -> str:
    """The newest snapshot of some sources (or all) as files, each a folder of parts.

    Each is written once, when it is first asked for. Lines are compressed; arrays are not, as files of
    them are read by many tasks.
    """
    memo = (spark.sparkContext.applicationId, sf_dir)
    root = _roots.setdefault(memo, scratch_path(spark, "files"))
    for name in sources or SOURCES:
        if (root, name) not in _written:
            _write_source(file_rows(spark, sf_dir, name), name, root)
            _written.add((root, name))
    return root


def _write_source(rows: DataFrame, name: str, root: str) -> None:
    spec = SOURCES[name]
    if name == "jobs":
        rows = rows.filter(F.col("_ingestion_date") == F.lit(DAYS[1])).withColumn(
            "department", F.coalesce("department", F.lit("N/A"))
        )
    rows = rows.select(*spec.columns.names)
    target = f"{root}/{spec.file_name}"
    if spec.layout == "csv":
        rows.write.option("header", True).option("compression", "gzip").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(target)
    elif spec.layout == "jsonl":
        rows.write.option("ignoreNullFields", False).option("compression", "gzip").json(target)
    else:
        write_json_arrays(
            rows.withColumn("skills", F.from_json("skills", "array<string>")), target
        )
