"""Quality checks, profiles, incremental builds and the end-to-end run."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hireflow.operators import profile, quality as q
from hireflow.operators.history import StoredHistory, scd2
from hireflow.operators.keyed_table import KeyedTable
from hireflow.operators.skew import hot_keys
from hireflow.operators.impacted import ingested_on
from hireflow.plans import marts, metrics, sharing, staging
from hireflow.plans.build import MODELS, Run, Warehouse
from hireflow.plans.run import run_all
from hireflow.plans.suite import checks, store_failures, summarize
from hireflow.session import ensure_checkpoint_dir, scratch_path
from hireflow.sources.schemas import SOURCES
from hireflow.verification import canonical as c
from hireflow.verification.model_queries import (
    ENRICHED_COLUMNS, ENRICHED_SQL, FACTS_COLUMNS, FACTS_SQL, TIME_TO_HIRE_SQL,
    rounded_time_to_hire,
)
from hireflow.verification.registry import query, written_row

# -- quality -------------------------------------------------------------------------------------


@query("q01_not_null", """
    SELECT job_id, title FROM stg_jobs WHERE department IS NULL""")
def _(spark, sf):
    return q.not_null(c.staged(spark, sf, "jobs"), "department").select("job_id", "title")


@query("q02_unique", """
    SELECT _event_id, count(*) AS n_records
    FROM (SELECT md5(application_id || '||' || coalesce(old_status, '') || '||' || new_status
                     || '||' || event_timestamp) AS _event_id FROM event_files)
    GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT job_id, 2 FROM stg_jobs""")
def _(spark, sf):
    events = q.unique(c.raw(spark, sf, "workflow_events"), "_event_id")
    jobs = q.unique(c.raw(spark, sf, "jobs"), "job_id")
    return events.unionByName(jobs.withColumnRenamed("job_id", "_event_id"))


@query("q03_accepted_values", """
    SELECT degree, count(*) AS n_records FROM stg_educations
    WHERE degree NOT IN ('MS', 'BS', 'PHD') GROUP BY degree""")
def _(spark, sf):
    return q.accepted_values(c.staged(spark, sf, "education"), "degree", q.DEGREES)


@query("q04_relationships", """
    SELECT candidate_id, email FROM stg_candidates
    WHERE NOT EXISTS (SELECT 1 FROM stg_applications a
                      WHERE a.candidate_id = stg_candidates.candidate_id)""")
def _(spark, sf):
    return q.relationships(
        c.staged(spark, sf, "candidates"), "candidate_id",
        c.staged(spark, sf, "applications"), "candidate_id",
    ).select("candidate_id", "email")


@query("q05_row_count_between", """
    SELECT 'jobs' AS source, 2 * count(*) AS row_count FROM part
    HAVING 2 * count(*) NOT BETWEEN 400 AND 600
    UNION ALL SELECT 'candidates', count(*) FROM people HAVING count(*) NOT BETWEEN 1800 AND 2200
    UNION ALL SELECT 'education', count(*) FROM customer HAVING count(*) NOT BETWEEN 1800 AND 2200
    UNION ALL SELECT 'applications', count(*) FROM orders
              HAVING count(*) NOT BETWEEN 4500 AND 5500
    UNION ALL SELECT 'workflow_events', count(*) FROM lineitem
              HAVING count(*) NOT BETWEEN 15000 AND 18000""")
def _(spark, sf):
    return reduce(
        DataFrame.unionByName,
        [
            q.row_count_between(c.raw(spark, sf, s), low, high).select(
                F.lit(s).alias("source"), "row_count"
            )
            for s, (low, high) in q.ROW_BOUNDS.items()
        ],
    )


_AGES = [datetime(2024, 1, 4, 12), datetime(2024, 1, 6, 12), datetime(2024, 1, 12, 12)]


@query("q06_source_freshness", """
    SELECT source, CAST(newest AS VARCHAR) AS max_loaded_at,
           date_diff('second', newest, moment) AS age_seconds,
           CASE WHEN date_diff('second', newest, moment) > 604800 THEN 'error'
                WHEN date_diff('second', newest, moment) > 172800 THEN 'warn'
                ELSE 'pass' END AS status
    FROM (SELECT 'applications' AS source, max(day) + INTERVAL 6 HOUR AS newest
          FROM stg_applications
          UNION ALL SELECT 'workflow_events', max(day) + INTERVAL 6 HOUR FROM event_files),
         (VALUES (TIMESTAMP '2024-01-04 12:00:00'), (TIMESTAMP '2024-01-06 12:00:00'),
                 (TIMESTAMP '2024-01-12 12:00:00')) v(moment)""")
def _(spark, sf):
    return reduce(
        DataFrame.unionByName,
        [
            q.source_freshness(c.raw(spark, sf, s), s, now)
            for s in ("applications", "workflow_events")
            for now in _AGES
        ],
    )


@query("q07_email_format", """
    SELECT candidate_id, email FROM stg_candidates WHERE email LIKE '%@invalid'""")
def _(spark, sf):
    return q.email_format(c.staged(spark, sf, "candidates")).select("candidate_id", "email")


@query("q08_invalid_dates", """
    SELECT l_orderkey, l_linenumber, 'no date' AS text FROM lineitem
    WHERE l_returnflag = 'R'""")
def _(spark, sf):
    """Lines with return flag R carry no readable date."""
    texts = c.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "no date")
        .otherwise(F.date_format("l_shipdate", "MMM d, yyyy"))
        .alias("text"),
    )
    parsed = texts.withColumn("apply_date", staging.parse_mixed_date(F.col("text")))
    return q.not_null(parsed, "apply_date").drop("apply_date")


@query("q09_hired_before_applied", """
    SELECT 'stg_workflow_events' AS model, 'hired_before_applied' AS check_name,
           'warn' AS severity, count(*) AS failures, 'warn' AS status
    FROM int_events WHERE is_anomaly""")
def _(spark, sf):
    return summarize(
        {"stg_workflow_events": c.staged(spark, sf, "workflow_events"),
         "stg_applications": c.staged(spark, sf, "applications")},
        [x for x in checks() if x.name == "hired_before_applied"],
    )


@query("q10_suite_summary", """
    SELECT model, check_name, 'error' AS severity, failures,
           CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (
      SELECT 'stg_candidates' AS model, unnest(['not_null_candidate_id', 'not_null_email',
                 'not_null_email_hash', 'not_null_phone_hash', 'not_null__batch_id',
                 'not_null__record_hash', 'unique_candidate_id']) AS check_name, 0 AS failures
      UNION ALL
      SELECT 'stg_candidates', 'not_null_skills_normalized', count(*) FROM supplier
      UNION ALL
      SELECT 'stg_candidates', 'email_format', count(*) FROM stg_candidates
      WHERE email LIKE '%@invalid'
      UNION ALL
      SELECT 'stg_educations', unnest(['not_null_candidate_id', 'not_null_degree',
                 'not_null__batch_id', 'not_null__record_hash', 'unique_candidate_id']), 0
      UNION ALL
      SELECT 'stg_educations', 'accepted_values_degree', count(*) FROM stg_educations
      WHERE degree = 'DIPLOMA'
      UNION ALL
      SELECT 'stg_jobs', unnest(['not_null_job_id', 'not_null_posted_date', 'not_null__batch_id',
                 'not_null__record_hash', 'unique_job_id', 'accepted_values_status',
                 'invalid_posted_date']), 0)""")
def _(spark, sf):
    return summarize(
        {
            "stg_candidates": c.staged(spark, sf, "candidates"),
            "stg_educations": c.staged(spark, sf, "education"),
            "stg_jobs": c.staged(spark, sf, "jobs"),
        }
    )


# Checks that the given tables break on purpose; all others find nothing.
_FAILING_SQL = """
    SELECT 'stg_candidates' AS model, 'email_format' AS check_name, count(*) AS failures
    FROM stg_candidates WHERE email LIKE '%@invalid'
    UNION ALL SELECT 'stg_candidates', 'not_null_skills_normalized', count(*) FROM supplier
    UNION ALL SELECT 'stg_educations', 'accepted_values_degree', count(*) FROM stg_educations
              WHERE degree = 'DIPLOMA'
    UNION ALL SELECT 'stg_workflow_events', 'hired_before_applied', count(*) FROM int_events
              WHERE is_anomaly"""


def _all_checks_sql() -> str:
    names = ", ".join(f"('{k.model}', '{k.name}', '{k.severity}')" for k in checks())
    return f"""
    SELECT n.model, n.check_name, n.severity, coalesce(f.failures, 0) AS failures,
           CASE WHEN coalesce(f.failures, 0) = 0 THEN 'pass' WHEN n.severity = 'warn' THEN 'warn'
                ELSE 'fail' END AS status
    FROM (VALUES {names}) n(model, check_name, severity)
    LEFT JOIN ({_FAILING_SQL}) f ON f.model = n.model AND f.check_name = n.check_name"""


@query("q10_suite_of_all_models", _all_checks_sql())
def _(spark, sf):
    """Every declared check over the twelve datasets of a build day by day, passing ones too."""
    warehouse = three_days(spark, sf)
    return summarize({name: warehouse.read(name) for name in MODELS})


@query("q10_stored_failures", f"""
    SELECT model, check_name, failures AS rows FROM ({_FAILING_SQL}) WHERE failures > 0""")
def _(spark, sf):
    """The failing rows of each check that has any, as they were stored."""
    warehouse = three_days(spark, sf)
    tables = {name: warehouse.read(name) for name in MODELS}
    root = scratch_path(spark, "stored-failures")
    folders = store_failures(tables, summarize(tables), root)
    stored = [
        spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(folder.split("/")[-2]).alias("model"), F.lit(folder.split("/")[-1]).alias("check_name"),
            "rows",
        )
        for folder in folders
    ]
    return reduce(DataFrame.unionByName, stored)


# -- profiles ------------------------------------------------------------------------------------


@query("p01_source_inventory", """
    SELECT 'events' AS file, count(*) AS rows, CAST(6 AS BIGINT) AS columns,
           'event_id, ts, user_id, event_type, value, props' AS column_names FROM events
    UNION ALL
    SELECT 'documents', count(*), 5, 'doc_id, text, lang, source, n_chars' FROM documents
    UNION ALL SELECT 'labels', count(*), 3, 'doc_id, quality, toxic' FROM labels""")
def _(spark, sf):
    return profile.source_inventory(
        {name: c.table(spark, sf, name) for name in ("events", "documents", "labels")}
    )


def _profile_sql(table: str, file: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{file}' AS file, '{name}' AS \"column\", '{kind}' AS dtype, "
        f"count(*) FILTER ({name} IS NULL) AS null_count, "
        f"count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) "
        f"AS distinct_count FROM {table}"
        for name, kind in columns.items()
    )


@query(
    "p02_column_profile",
    _profile_sql("documents", "documents", {"doc_id": "bigint", "text": "string",
                                            "lang": "string", "source": "string",
                                            "n_chars": "bigint"})
    + " UNION ALL "
    + _profile_sql("job_files", "jobs", dict.fromkeys(
        ["job_id", "title", "department", "posted_date", "status"], "string")),
)
def _(spark, sf):
    jobs = c.file_rows(spark, sf, "jobs").filter(F.col("_ingestion_date") == F.lit(c.DAYS[1]))
    return profile.column_profile(c.table(spark, sf, "documents"), "documents").unionByName(
        profile.column_profile(jobs.drop("_ingestion_date"), "jobs")
    )


def _close_sql(table: str, file: str, columns: dict[str, str]) -> str:
    return f"SELECT file, \"column\", dtype, null_count, distinct_count, TRUE AS close FROM ({_profile_sql(table, file, columns)})"


def _beside_exact(estimated: DataFrame, exact: DataFrame, bound: float) -> DataFrame:
    """Exact figures, and whether the estimate of the distinct count is within a share of it."""
    guess = estimated.select("column", F.col("distinct_count").alias("guess"), F.col("null_count").alias("nulls"))
    near = F.abs(F.col("guess") - F.col("distinct_count")) <= bound * F.col("distinct_count")
    return exact.join(guess, "column").select(
        "file", "column", "dtype", "null_count", "distinct_count",
        (near & (F.col("nulls") == F.col("null_count"))).alias("close"),
    )


_DOCUMENTS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("p02_column_profile_approx", _close_sql("documents", "documents", _DOCUMENTS))
def _(spark, sf):
    """Estimates within five standard errors (2 % each) of the exact counts."""
    docs = c.table(spark, sf, "documents")
    return _beside_exact(
        profile.column_profile_approx(docs, "documents"), profile.column_profile(docs, "documents"), 0.1
    )


_LINES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
          "l_quantity": "double", "l_returnflag": "string", "l_shipdate": "timestamp_ntz"}


def line_sketches(spark: SparkSession, sf_dir: str) -> tuple[profile.ColumnSketches, DataFrame]:
    """Sketches of the line items, added by return flag, one of them twice."""
    lines = c.table(spark, sf_dir, "lineitem").select(*_LINES)
    sketches = profile.ColumnSketches(spark, scratch_path(spark, "sketches"))
    for flag in ("A", "N", "R", "N"):
        sketches.add(lines.filter(F.col("l_returnflag") == flag), flag)
    return sketches, lines


@query("p02_sketches_merged", _close_sql("lineitem", "lines", _LINES))
def _(spark, sf):
    """Merged over batches and within five standard errors (0.8 % each) of the exact counts."""
    sketches, lines = line_sketches(spark, sf)
    return _beside_exact(sketches.profile("lines"), profile.column_profile(lines, "lines"), 0.04)


@query("p02_sketched_medians", """
    SELECT name AS "column", n AS rows, TRUE AS close
    FROM (SELECT count(*) AS n FROM lineitem),
         (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'), ('l_quantity')) v(name)""")
def _(spark, sf):
    """Medians out of merged sketches, whose place among all rows is within 2 % of the middle."""
    sketches, lines = line_sketches(spark, sf)
    medians = written_row(sketches.profile("lines").where("median is not null"), scratch_path(spark, "medians"))
    numbers = [name for name, kind in _LINES.items() if kind in ("int", "bigint", "double")]
    values = lines.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("value")) for name in numbers
    ])))
    below, upto = F.count_if(F.col("value") < F.col("median")), F.count_if(F.col("value") <= F.col("median"))
    return values.join(F.broadcast(medians), "column").groupBy("column", "rows").agg(
        ((below <= 0.52 * F.first("rows")) & (upto >= 0.48 * F.first("rows"))).alias("close")
    )


@query("p03_full_duplicate_rows", """
    SELECT 'workflow_events' AS file,
           count(*) - count(DISTINCT (application_id, old_status, new_status, event_timestamp))
               AS full_duplicate_rows
    FROM event_files
    UNION ALL
    SELECT 'texts', count(*) - count(DISTINCT (text, lang)) FROM documents""")
def _(spark, sf):
    events = c.file_rows(spark, sf, "workflow_events").drop("_ingestion_date")
    texts = c.table(spark, sf, "documents").select("text", "lang")
    return profile.full_duplicate_rows(events, "workflow_events").unionByName(
        profile.full_duplicate_rows(texts, "texts")
    )


@query("p04_date_pattern_profile", """
    SELECT 'applications' AS file, 'apply_date' AS "column",
           CASE o_orderpriority WHEN '1-URGENT' THEN 'YYYY-MM-DD' WHEN '2-HIGH' THEN 'YYYY/MM/DD'
                WHEN '3-MEDIUM' THEN 'YYYY.MM.DD' WHEN '4-NOT SPECIFIED' THEN 'DD-Mon-YYYY'
                ELSE 'Month D, YYYY' END AS format, count(*) AS count
    FROM orders GROUP BY ALL
    UNION ALL
    SELECT 'jobs', 'posted_date',
           CASE p_type WHEN 'ECONOMY' THEN 'YYYY-MM-DD' WHEN 'MEDIUM' THEN 'YYYY/MM/DD'
                WHEN 'STANDARD' THEN 'YYYY.MM.DD' WHEN 'PROMO' THEN 'DD-Mon-YYYY'
                WHEN 'SMALL' THEN 'Month D, YYYY' ELSE 'other' END, count(*)
    FROM part GROUP BY ALL
    UNION ALL
    SELECT 'workflow_events', 'event_timestamp',
           CASE l_returnflag WHEN 'N' THEN 'ISO timestamp' ELSE 'YYYY-MM-DD' END, count(*)
    FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    jobs = c.file_rows(spark, sf, "jobs").filter(F.col("_ingestion_date") == F.lit(c.DAYS[1]))
    return profile.date_pattern_profile(
        {
            ("applications", "apply_date"): c.file_rows(spark, sf, "applications"),
            ("jobs", "posted_date"): jobs,
            ("workflow_events", "event_timestamp"): c.file_rows(spark, sf, "workflow_events"),
        }
    )


@query("p05_value_distribution", """
    SELECT old_status, count(*) AS count FROM event_files GROUP BY old_status""")
def _(spark, sf):
    return profile.value_distribution(c.file_rows(spark, sf, "workflow_events"), "old_status")


@query("p06_list_stats", """
    SELECT CAST(0 AS BIGINT) AS min_size, CAST(3 AS BIGINT) AS max_size, round(3.0 * n1 / (n1 + n2), 2) AS avg_size
    FROM (SELECT count(*) AS n1 FROM customer), (SELECT count(*) AS n2 FROM supplier)""")
def _(spark, sf):
    return profile.list_stats(_skills(spark, sf), "skills")


@query("p06_word_list_stats", """
    SELECT min(n) AS min_size, max(n) AS max_size, round(avg(n), 2) AS avg_size
    FROM (SELECT len(string_split(text, ' ')) AS n FROM documents)""")
def _(spark, sf):
    words = c.table(spark, sf, "documents").select(F.split("text", " ").alias("words"))
    return profile.list_stats(words, "words")


def _skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.file_rows(spark, sf_dir, "candidates").select(
        F.from_json("skills", "array<string>").alias("skills")
    )


@query("p07_top_elements", """
    SELECT element, count(*) AS count
    FROM (SELECT unnest([segment, ' spark', 'sql ']) AS element FROM people
          WHERE segment IS NOT NULL)
    GROUP BY element ORDER BY count DESC, element LIMIT 10""")
def _(spark, sf):
    return profile.top_elements(_skills(spark, sf), "skills")


@query("p07_top_words", """
    SELECT element, count(*) AS count
    FROM (SELECT unnest(string_split(text, ' ')) AS element FROM documents)
    GROUP BY element ORDER BY count DESC, element LIMIT 10""")
def _(spark, sf):
    words = c.table(spark, sf, "documents").select(F.split("text", " ").alias("words"))
    return profile.top_elements(words, "words")


@query("p08_anomaly_probe", """
    SELECT e.application_id, e.old_status, e.new_status, e.event_timestamp, f.apply_date
    FROM event_files e JOIN stg_applications a USING (application_id)
         JOIN application_files f USING (application_id)
    WHERE e.new_status = 'Hired' AND e.happened < a.apply_date""")
def _(spark, sf):
    return profile.anomaly_probe(
        c.file_rows(spark, sf, "workflow_events"), c.file_rows(spark, sf, "applications")
    )


@query("p09_relationship_profile", """
    WITH used AS (SELECT DISTINCT candidate_id FROM stg_applications),
         known AS (SELECT DISTINCT candidate_id FROM stg_candidates)
    SELECT 'applications.candidate_id' AS relationship, 'distinct_used' AS measure,
           count(*) AS keys FROM used
    UNION ALL SELECT 'applications.candidate_id', 'orphans', count(*)
    FROM used WHERE candidate_id NOT IN (SELECT candidate_id FROM known)
    UNION ALL SELECT 'applications.candidate_id', 'never_used', count(*)
    FROM known WHERE candidate_id NOT IN (SELECT candidate_id FROM used)""")
def _(spark, sf):
    return profile.relationship_profile(
        c.file_rows(spark, sf, "applications"), "candidate_id",
        c.file_rows(spark, sf, "candidates"), "candidate_id", "applications.candidate_id",
    )


# -- incremental builds --------------------------------------------------------------------------

_warehouses: dict[tuple[str, str], Warehouse] = {}
BUCKETS = 4


def three_days(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All layers, built day by day from three days of arrivals. Built once."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo not in _warehouses:
        warehouse = Warehouse(
            spark, scratch_path(spark, "days"), lambda s: c.raw(spark, sf_dir, s), BUCKETS
        )
        for day in c.DAYS:
            warehouse.build(Run(day, c.NOW))
        _warehouses[memo] = warehouse
    return _warehouses[memo]


@query("i01_upsert_by_key", """
    SELECT job_id, title, department, status, CAST(posted_date AS VARCHAR) AS posted_date,
           CAST(day AS VARCHAR) AS _ingestion_date FROM stg_jobs""")
def _(spark, sf):
    """Drafts arrive first, then the final state replaces every key."""
    table = KeyedTable(spark, scratch_path(spark, "upsert"), ["job_id"], buckets=BUCKETS)
    raw = c.raw(spark, sf, "jobs")
    for day in c.DAYS[:2]:
        table.upsert(staging.stg_jobs(ingested_on(raw, day), c.NOW))
    return table.read().select(
        "job_id", "title", "department", "status", "posted_date", "_ingestion_date"
    )


@query("i01_upsert_fine_changes", """
    SELECT o_orderkey AS id, kind,
           CASE kind WHEN 'microsecond'
                     THEN strftime(o_orderdate + INTERVAL 2 MICROSECOND, '%Y-%m-%d %H:%M:%S.%f')
                     WHEN 'to value' THEN strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')
           END AS at
    FROM orders, (VALUES ('microsecond'), ('to value'), ('to null')) AS t(kind)""")
def _(spark, sf):
    """Times that change by a microsecond, from NULL and to NULL are changes."""
    table = KeyedTable(spark, scratch_path(spark, "fine"), ["id", "kind"], buckets=BUCKETS)
    kinds = F.explode(F.array(*[F.lit(k) for k in ("microsecond", "to value", "to null")]))
    rows = c.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), kinds.alias("kind"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
    )
    micro = F.expr("INTERVAL 1 MICROSECOND")
    first = F.when(F.col("kind") == "microsecond", F.col("at") + micro).when(
        F.col("kind") == "to null", F.col("at"))
    second = F.when(F.col("kind") == "microsecond", F.col("at") + micro + micro).when(
        F.col("kind") == "to value", F.col("at"))
    table.upsert(rows.withColumn("at", first))
    table.upsert(rows.withColumn("at", second))
    return table.read().withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("i01_upsert_older_rows", """
    SELECT job_id, status, CAST(day AS VARCHAR) AS _ingestion_date FROM stg_jobs""")
def _(spark, sf):
    """A run for an older day leaves rows that were received later."""
    warehouse = Warehouse(
        spark, scratch_path(spark, "older"), lambda s: c.raw(spark, sf, s), BUCKETS
    )
    for day in (c.DAYS[1], c.DAYS[0]):
        warehouse._update("stg_jobs", Run(day, c.NOW))
    return warehouse.read("stg_jobs").select("job_id", "status", "_ingestion_date")


@query("i02_full_refresh", FACTS_SQL)
def _(spark, sf):
    warehouse = Warehouse(
        spark, scratch_path(spark, "full"), lambda s: c.raw(spark, sf, s), BUCKETS
    )
    warehouse.build(Run(c.DAYS[2], c.NOW, full_refresh=True), ["stg", "int", "fact"])
    return warehouse.read("fct_applications").select(*FACTS_COLUMNS)


@query("i03_impacted_keys", ENRICHED_SQL)
def _(spark, sf):
    return three_days(spark, sf).read("int_workflow_events_enriched").select(*ENRICHED_COLUMNS)


@query("i03_incremental_facts", FACTS_SQL)
def _(spark, sf):
    return three_days(spark, sf).read("fct_applications").select(*FACTS_COLUMNS)


_LATE_SQL = """
    SELECT a.*, a.is_hired OR CAST(a.application_id AS BIGINT) % 100 = 0 AS hired,
           CASE WHEN CAST(a.application_id AS BIGINT) % 100 = 0
                THEN least(coalesce(a.time_to_hire_days, 400), 400) ELSE a.time_to_hire_days END AS days
    FROM fct_apps a"""


def days_and_a_late_one(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Three days, and a fourth that touches one application of a hundred."""
    warehouse = Warehouse(
        spark, scratch_path(spark, "late"), lambda s: c.raw_with_late_hires(spark, sf_dir, s), BUCKETS
    )
    for day in [*c.DAYS, c.LATE_DAYS[0]]:
        warehouse.build(Run(day, c.NOW))
    return warehouse


@query("i03_small_day", f"""
    SELECT application_id, job_id, hired AS is_hired, days AS time_to_hire_days
    FROM ({_LATE_SQL})""")
def _(spark, sf):
    return days_and_a_late_one(spark, sf).read("fct_applications").select(
        "application_id", "job_id", "is_hired", "time_to_hire_days"
    )


@query("l03_aggregate_by_changes", f"""
    SELECT j.job_id, j.title, j.department, count(*) AS applications_count,
           count(*) AS hired_applications_count, round(avg(f.days), 6) AS avg_time_to_hire_days,
           min(f.days) AS min_time_to_hire_days, max(f.days) AS max_time_to_hire_days
    FROM ({_LATE_SQL}) f LEFT JOIN stg_jobs j USING (job_id) WHERE f.hired GROUP BY ALL""")
def _(spark, sf):
    """Kept up to date by the build from the facts that changed."""
    warehouse = days_and_a_late_one(spark, sf)
    return rounded_time_to_hire(warehouse.read("agg_time_to_hire_by_job_department"))


@query("l03_hire_counts", """
    SELECT job_id, time_to_hire_days, count(*) AS n FROM fct_apps WHERE is_hired GROUP BY ALL""")
def _(spark, sf):
    counts = three_days(spark, sf).hire_counts.read()
    return counts.filter("n > 0").select("job_id", "time_to_hire_days", "n")


@query("i01_rows_before_and_after", """
    SELECT job_id, status, CAST(n AS INT) AS _change FROM (
        SELECT CAST(p_partkey AS VARCHAR) AS job_id, 'DRAFT' AS status, -1 AS n FROM part
        UNION ALL SELECT job_id, status, 1 FROM stg_jobs)""")
def _(spark, sf):
    """What the second day's upsert took away and what it brought."""
    table = KeyedTable(spark, scratch_path(spark, "images"), ["job_id"], buckets=BUCKETS)
    raw = c.raw(spark, sf, "jobs")
    for day in c.DAYS[:2]:
        table.upsert(staging.stg_jobs(ingested_on(raw, day), c.NOW), ("_processed_ts",))
    return table.changes(1).select("job_id", "status", "_change")


@query("i04_full_table_rebuild", TIME_TO_HIRE_SQL)
def _(spark, sf):
    return rounded_time_to_hire(three_days(spark, sf).read("agg_time_to_hire_by_job_department"))


@query("i05_layer_selection", """
    SELECT job_id, title, status, CAST(posted_date AS VARCHAR) AS posted_date FROM stg_jobs""")
def _(spark, sf):
    """Only the dimensions, over staging tables that a run of its own has made."""
    warehouse = Warehouse(
        spark, scratch_path(spark, "layers"), lambda s: c.raw(spark, sf, s), BUCKETS
    )
    run = Run(c.DAYS[2], c.NOW, full_refresh=True)
    warehouse.build(run, ["stg"])
    if warehouse.table("dim_job").exists():
        raise RuntimeError("a layer that was not asked for was built")
    warehouse.build(run, ["dim"])
    return warehouse.read("dim_job").select("job_id", "title", "status", "posted_date")


# -- end to end ----------------------------------------------------------------------------------

_runs: dict[tuple[str, str], dict] = {}


def file_run(spark: SparkSession, sf_dir: str) -> dict:
    """Everything from files in one run. The data holds broken rows on purpose. Run once."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo not in _runs:
        _runs[memo] = run_all(
            spark, c.source_files(spark, sf_dir), scratch_path(spark, "run"),
            full_refresh=True, now=c.NOW, row_bounds=q.ROW_BOUNDS, buckets=BUCKETS, enforce=False,
        )
    return _runs[memo]


@query("e01_run_time_to_hire", TIME_TO_HIRE_SQL)
def _(spark, sf):
    warehouse = file_run(spark, sf)["warehouse"]
    return rounded_time_to_hire(warehouse.read("agg_time_to_hire_by_job_department"))


@query("e01_run_all_checks", _all_checks_sql())
def _(spark, sf):
    """Passing checks of the run from files as well."""
    return file_run(spark, sf)["results"].filter("check_name <> 'row_count_between'")


@query("e01_run_failed_checks", """
    SELECT 'stg_candidates' AS model, 'email_format' AS check_name, 'error' AS severity,
           count(*) AS failures FROM stg_candidates WHERE email LIKE '%@invalid' HAVING count(*) > 0
    UNION ALL SELECT 'stg_candidates', 'not_null_skills_normalized', 'error', count(*)
              FROM supplier
    UNION ALL SELECT 'stg_educations', 'accepted_values_degree', 'error', count(*)
              FROM stg_educations WHERE degree = 'DIPLOMA' HAVING count(*) > 0
    UNION ALL SELECT 'stg_workflow_events', 'hired_before_applied', 'warn', count(*)
              FROM int_events WHERE is_anomaly HAVING count(*) > 0
    UNION ALL SELECT 'jobs', 'row_count_between', 'error', 1
              FROM part HAVING count(*) NOT BETWEEN 400 AND 600
    UNION ALL SELECT 'candidates', 'row_count_between', 'error', 1
              FROM people HAVING count(*) NOT BETWEEN 1800 AND 2200
    UNION ALL SELECT 'education', 'row_count_between', 'error', 1
              FROM customer HAVING count(*) NOT BETWEEN 1800 AND 2200
    UNION ALL SELECT 'applications', 'row_count_between', 'error', 1
              FROM orders HAVING count(*) NOT BETWEEN 4500 AND 5500
    UNION ALL SELECT 'workflow_events', 'row_count_between', 'error', 1
              FROM lineitem HAVING count(*) NOT BETWEEN 15000 AND 18000""")
def _(spark, sf):
    return file_run(spark, sf)["results"].filter("failures > 0").drop("status")


# -- large scale ---------------------------------------------------------------------------------


@query("l03_incremental_aggregate", TIME_TO_HIRE_SQL)
def _(spark, sf):
    """The aggregate of the first two days, brought up to the third by touched jobs only."""
    jobs = marts.dim_job(c.staged(spark, sf, "jobs"), c.NOW)

    def facts_until(last) -> DataFrame:
        received = {
            s: c.raw(spark, sf, s).filter(F.col("_ingestion_date") <= F.lit(last))
            for s in ("applications", "workflow_events")
        }
        applications = staging.stg_applications(received["applications"], c.NOW)
        events = staging.stg_workflow_events(received["workflow_events"], c.NOW)
        enriched = c.intermediate.int_workflow_events_enriched(
            events, applications, hot_keys(received["workflow_events"], "application_id")
        )
        # Both states are used twice, as a stored table would be.
        ensure_checkpoint_dir(spark)
        return marts.fct_applications(applications, enriched, c.NOW).checkpoint()

    before, after = facts_until(c.DAYS[1]), facts_until(c.DAYS[2])
    previous = marts.agg_time_to_hire_by_job_department(before, jobs, c.NOW)
    touched = marts.jobs_of_changed_facts(before, after)
    return rounded_time_to_hire(marts.refresh_time_to_hire(previous, after, jobs, touched, c.NOW))


@query("l03_incremental_dimension", """
    SELECT job_id, title, department, applications_count FROM (
        SELECT CASE WHEN CAST(j.job_id AS INT) % 5 <> 3 THEN j.job_id END AS job_id,
               CASE WHEN CAST(j.job_id AS INT) % 5 = 3 THEN NULL
                    WHEN CAST(j.job_id AS INT) % 5 = 2 THEN 'renamed ' || j.title ELSE j.title END AS title,
               CASE WHEN CAST(j.job_id AS INT) % 5 <> 3 THEN j.department END AS department
        FROM stg_jobs j UNION ALL SELECT NULL, NULL, NULL) d
    JOIN (SELECT CASE WHEN CAST(job_id AS INT) % 5 <> 3 AND job_id IN (SELECT job_id FROM stg_jobs)
                      THEN job_id END AS fact_job, count(*) AS applications_count
          FROM fct_apps WHERE is_hired GROUP BY 1) f ON d.job_id IS NOT DISTINCT FROM f.fact_job
    GROUP BY ALL""")
def _(spark, sf):
    """Jobs that arrive after their hires, are renamed or vanish, with facts that stay as they are."""
    jobs = marts.dim_job(c.staged(spark, sf, "jobs"), c.NOW)
    kind = F.col("job_id").cast("int") % 5
    before = jobs.filter(kind != 1)
    after = jobs.filter(kind != 3).withColumn(
        "title", F.when(kind == 2, F.concat(F.lit("renamed "), "title")).otherwise(F.col("title"))
    )
    ensure_checkpoint_dir(spark)
    facts = c.facts(spark, sf).checkpoint()
    previous = marts.agg_time_to_hire_by_job_department(facts, before, c.NOW)
    none = jobs.select("job_id").limit(0)
    fresh = marts.refresh_time_to_hire(previous, facts, after, none, c.NOW)
    return fresh.select("job_id", "title", "department", "applications_count")


@query("l05_skill_bridge", """
    SELECT candidate_id, unnest([segment, 'spark', 'sql']) AS skill FROM people
    WHERE segment IS NOT NULL""")
def _(spark, sf):
    return sharing.candidate_skill(c.staged(spark, sf, "candidates"))


@query("l06_masked_candidates", """
    SELECT candidate_id,
           regexp_replace(regexp_replace(regexp_replace(first_name, '[A-Z]', 'X', 'g'),
                          '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS first_name,
           regexp_replace(last_name, '[0-9]', 'n', 'g') AS last_name,
           sha256('pepper' || email) AS email_token, sha256('pepper' || phone) AS phone_token,
           regexp_replace(regexp_replace(email, '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')
               AS email_masked,
           regexp_replace(phone, '[0-9]', 'n', 'g') AS phone_masked,
           skills_normalized, skills_count
    FROM stg_candidates""")
def _(spark, sf):
    return sharing.masked_candidates(c.staged(spark, sf, "candidates"), "pepper")


@query("l07_batch_metrics", """
    SELECT 'duplicate_rate' AS metric, 'workflow_events' AS subject,
           round((count(*) - count(DISTINCT event_id)) / count(*), 9) AS value
    FROM (SELECT md5(application_id || '||' || coalesce(old_status, '') || '||' || new_status
                     || '||' || event_timestamp) AS event_id FROM event_files)
    UNION ALL SELECT 'duplicate_rate', 'jobs', 0.5
    UNION ALL SELECT 'anomaly_count', 'hired_before_applied', count(*) FROM int_events
              WHERE is_anomaly
    UNION ALL SELECT 'freshness_days', 'workflow_events', 1.25""")
def _(spark, sf):
    events = c.raw(spark, sf, "workflow_events")
    anomalies = c.enriched(spark, sf).filter("is_anomaly")
    parts = [
        metrics.duplicate_rate(events, "_event_id", "workflow_events"),
        metrics.duplicate_rate(c.raw(spark, sf, "jobs"), "job_id", "jobs"),
        metrics.anomaly_count(anomalies),
        metrics.freshness_days(events, "workflow_events", c.NOW),
    ]
    union = reduce(DataFrame.unionByName, parts)
    return union.withColumn("value", F.round(F.col("value").cast("double"), 9))


@query("l07_run_figures", """
    SELECT metric, subject, value FROM (
        SELECT 'stg_jobs' AS subject, count(*) AS n FROM part
        UNION ALL SELECT 'stg_candidates', count(*) FROM people
        UNION ALL SELECT 'stg_educations', count(*) FROM customer
        UNION ALL SELECT 'stg_applications', count(*) FROM orders
        UNION ALL SELECT 'stg_workflow_events', count(*) FROM stg_events
        UNION ALL SELECT 'int_workflow_events_enriched', count(*) FROM stg_events
        UNION ALL SELECT 'dim_job', count(*) FROM part
        UNION ALL SELECT 'dim_candidate', count(*) FROM people
        UNION ALL SELECT 'fct_applications', count(*) FROM orders
        UNION ALL SELECT 'fct_workflow_events', count(*) FROM stg_events
        UNION ALL SELECT 'agg_time_to_hire_by_job_department', count(*) FROM tth
        UNION ALL SELECT 'dq_hired_before_applied_anomalies', count(*) FROM int_events WHERE is_anomaly),
        (VALUES ('rows_total'), ('rows_arrived'), ('rows_written'), ('rows_replaced')) m(metric),
        LATERAL (SELECT CAST(CASE metric WHEN 'rows_replaced' THEN 0 ELSE n END AS DOUBLE) AS value)""")
def _(spark, sf):
    """Rows of every dataset of a run from files, as its writes counted them."""
    return file_run(spark, sf)["metrics"].filter(
        F.col("metric").isin("rows_total", "rows_arrived", "rows_written", "rows_replaced")
        & F.col("subject").isin(*MODELS)
    ).drop("measured_at")


@query("l07_breaches", """
    SELECT metric, subject, round(CAST(value AS DOUBLE), 9) AS value, CAST("limit" AS DOUBLE) AS "limit" FROM (
        SELECT 'duplicate_rate' AS metric, 'jobs' AS subject, 0.5 AS value, 0.1 AS "limit"
        UNION ALL SELECT 'duplicate_rate', 'workflow_events',
                  (count(*) - (SELECT count(*) FROM stg_events)) / count(*), 0.1 FROM event_files
        UNION ALL SELECT 'anomaly_count', 'hired_before_applied', count(*), 5
                  FROM int_events WHERE is_anomaly)
    WHERE value > "limit" """)
def _(spark, sf):
    parts = [
        metrics.duplicate_rate(c.raw(spark, sf, "workflow_events"), "_event_id", "workflow_events"),
        metrics.duplicate_rate(c.raw(spark, sf, "jobs"), "job_id", "jobs"),
        metrics.anomaly_count(c.enriched(spark, sf).filter("is_anomaly")),
    ]
    limits = {"duplicate_rate": 0.1, "anomaly_count": 5.0}
    found = metrics.breaches(reduce(DataFrame.unionByName, parts), limits)
    return found.withColumn("value", F.round("value", 9))


@query("l07_drifts", """
    SELECT CAST(day AS VARCHAR) AS measured_at, CAST(n AS DOUBLE) AS value, round(usual, 6) AS usual
    FROM (SELECT day, n, avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual
          FROM (SELECT date_trunc('day', l_shipdate) AS day, count(*) AS n FROM lineitem GROUP BY 1))
    WHERE abs(n - usual) > 0.5 * abs(usual)""")
def _(spark, sf):
    """Days with far more or fewer shipped lines than the seven before, as if each were a run."""
    series = c.table(spark, sf, "lineitem").groupBy(
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("measured_at")
    ).agg(F.count(F.lit(1)).cast("double").alias("value")).withColumns(
        {"metric": F.lit("rows_read"), "subject": F.lit("lineitem")}
    )
    return metrics.drifts(series).select(
        "measured_at", "value", F.round("usual", 6).alias("usual")
    )


@query("l07_load_metrics", """
    SELECT metric, source AS subject,
           CASE WHEN metric IN ('rows_read', 'rows_written') THEN n ELSE 0 END AS value
    FROM (SELECT 'jobs' AS source, count(*)::DOUBLE AS n FROM part
          UNION ALL SELECT 'candidates', count(*) FROM people
          UNION ALL SELECT 'applications', count(*) FROM orders
          UNION ALL SELECT 'education', count(*) FROM customer
          UNION ALL SELECT 'workflow_events', count(*) FROM lineitem),
         (VALUES ('rows_read'), ('rows_written'), ('rows_rejected'), ('rejected_share'))
             m(metric)""")
def _(spark, sf):
    from hireflow.verification.source_queries import outcomes

    return metrics.load_metrics(outcomes(spark, file_run(spark, sf)["loads"]))


_HISTORY_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS job_id, 'Draft' AS status,
           '2024-01-01 06:00:00' AS valid_from, '2024-01-02 06:00:00' AS valid_to,
           FALSE AS is_current FROM part
    UNION ALL
    SELECT job_id, status, '2024-01-02 06:00:00', NULL, TRUE FROM job_files"""


@query("l08_scd2_history", _HISTORY_SQL)
def _(spark, sf):
    snapshots = _repeated(c.raw(spark, sf, "jobs"))
    return scd2(snapshots, "job_id", hot_keys(snapshots, "job_id")).select(
        "job_id", "status", "valid_from", "valid_to", "is_current"
    )


@query("l08_scd2_history_spread", _HISTORY_SQL)
def _(spark, sf):
    """The same with every job treated as too big for one task."""
    snapshots = _repeated(c.raw(spark, sf, "jobs"))
    return scd2(snapshots, "job_id", hot_keys(snapshots, "job_id", 0)).select(
        "job_id", "status", "valid_from", "valid_to", "is_current"
    )


@query("l08_history_merged", _HISTORY_SQL)
def _(spark, sf):
    """Snapshot by snapshot, out of order and one of them twice."""
    snapshots = _repeated(c.raw(spark, sf, "jobs"))
    history = StoredHistory(spark, scratch_path(spark, "history"), "job_id", BUCKETS)
    hour = F.hour("_ingestion_ts") == 7
    late = F.col("_ingestion_date") == F.lit(c.DAYS[1])
    for part in (late & hour, ~late & ~hour, late & ~hour, ~late & hour, late & hour):
        history.merge(snapshots.filter(part))
    return history.read().select("job_id", "status", "valid_from", "valid_to", "is_current")


def _repeated(raw: DataFrame) -> DataFrame:
    """Every snapshot once more an hour later, unchanged."""
    later = F.col("_ingestion_ts") + F.expr("interval 1 hour")
    return raw.unionByName(raw.withColumn("_ingestion_ts", later))


@query("l10_non_negative_time_to_hire", """
    SELECT count(*) AS hired, count(*) FILTER (time_to_hire_days < 0) AS negative,
           min(time_to_hire_days) AS shortest
    FROM fct_apps WHERE is_hired""")
def _(spark, sf):
    days = F.col("time_to_hire_days")
    return c.facts(spark, sf).filter("is_hired").agg(
        F.count(F.lit(1)).alias("hired"), F.count_if(days < 0).alias("negative"),
        F.min(days).alias("shortest"),
    )
