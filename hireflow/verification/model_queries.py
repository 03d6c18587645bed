"""Expressions, joins, aggregates, windows and datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hireflow.functions import lists, text
from hireflow.functions.dates import days_between, parse_mixed_date, try_timestamp
from hireflow.operators.impacted import (
    distinct_keys, history_of, ingested_on, orphans, with_flag,
)
from hireflow.operators.latest import latest_by
from hireflow.operators.skew import number_across_ranges, number_rows
from hireflow.plans import analysis, audit, intermediate, marts
from hireflow.verification import canonical as c
from hireflow.verification.registry import query

# -- scalar expressions --------------------------------------------------------------------------


@query("b01_ingestion_date_filter", """
    SELECT CAST(day AS VARCHAR) AS run_date, application_id, old_status, new_status,
           event_timestamp
    FROM event_files""")
def _(spark, sf):
    raw = c.raw(spark, sf, "workflow_events")
    return reduce(
        DataFrame.unionByName,
        [
            ingested_on(raw, day).select(
                F.lit(day).alias("run_date"), "application_id", "old_status", "new_status",
                "event_timestamp",
            )
            for day in c.DAYS
        ],
    )


_LAYOUTS = [
    "yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "dd-MM-yyyy", "MM/dd/yyyy", "MM.dd.yyyy",
    "MMMM d, yyyy", "MMM d, yyyy", "d-MMM-yyyy", "d-MMMM-yyyy", "'  'yyyy-M-d ",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM", "yyyyMMdd", "yyyy-MM-dd 'junk'",
]


@query("b02_parse_mixed_date", """
    SELECT o_orderkey, layout,
           CASE WHEN layout < 12 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed
    FROM orders, range(15) r(layout)""")
def _(spark, sf):
    texts = F.posexplode(
        F.array(*[F.date_format("o_orderdate", layout) for layout in _LAYOUTS])
    )
    rendered = c.table(spark, sf, "orders").select("o_orderkey", texts.alias("layout", "text"))
    return rendered.select(
        "o_orderkey", F.col("layout").cast("bigint").alias("layout"),
        parse_mixed_date(F.col("text")).alias("parsed"),
    )


@query("b03_trim", "SELECT candidate_id, first_name, last_name, phone FROM stg_candidates")
def _(spark, sf):
    return c.raw(spark, sf, "candidates").select(
        "candidate_id",
        *[text.clean(F.col(n)).alias(n) for n in ("first_name", "last_name", "phone")],
    )


@query("b04_standardise_case", """
    SELECT candidate_id, email, degree FROM stg_candidates LEFT JOIN stg_educations
    USING (candidate_id)""")
def _(spark, sf):
    people = c.raw(spark, sf, "candidates").select(
        "candidate_id", text.clean_lower(F.col("email")).alias("email")
    )
    degrees = c.raw(spark, sf, "education").select(
        "candidate_id", text.clean_upper(F.col("degree")).alias("degree")
    )
    return people.join(degrees, "candidate_id", "left")


@query("b05_try_timestamp", """
    SELECT l_orderkey, l_linenumber, layout,
           CASE WHEN layout < 5 THEN CAST(l_shipdate AS VARCHAR) END AS moment
    FROM lineitem, range(8) r(layout)""")
def _(spark, sf):
    layouts = [
        "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd",
        "yyyy-M-d'T'HH:mm:ss'+02:00'", "dd-MMM-yyyy", "yyyy", "yyyy-MM-dd'T'",
    ]
    texts = F.posexplode(F.array(*[F.date_format("l_shipdate", x) for x in layouts]))
    rendered = c.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", texts.alias("layout", "text")
    )
    return rendered.select(
        "l_orderkey", "l_linenumber", F.col("layout").cast("bigint").alias("layout"),
        try_timestamp(F.col("text")).alias("moment"),
    )


def _skills(spark, sf, out, expr):
    return c.raw(spark, sf, "candidates").select("candidate_id", expr(F.col("skills")).alias(out))


@query("b06_split", "SELECT candidate_id, segment || '| spark|sql ' AS items FROM people")
def _(spark, sf):
    return _skills(spark, sf, "items", lambda s: F.split(s, ","))


@query("b07_list_transform", "SELECT candidate_id, segment || '|spark|sql' AS items FROM people")
def _(spark, sf):
    return _skills(spark, sf, "items", lambda s: F.transform(F.split(s, ","), text.clean))


@query("b08_list_sort", "SELECT candidate_id, segment || '|spark|sql' AS items FROM people")
def _(spark, sf):
    """The items come in reversed, so that sorting has work to do."""
    return _skills(
        spark, sf, "items",
        lambda s: lists.sorted_items(F.array_join(F.reverse(F.split(s, ",")), ",")),
    )


@query("b09_array_to_string", "SELECT candidate_id, skills_normalized FROM stg_candidates")
def _(spark, sf):
    return _skills(
        spark, sf, "skills_normalized", lambda s: F.array_join(lists.sorted_items(s), ",")
    )


@query("b10_array_length", "SELECT candidate_id, skills_count FROM stg_candidates")
def _(spark, sf):
    return _skills(
        spark, sf, "skills_count", lambda s: lists.item_count(lists.sorted_items(s))
    )


@query("b11_json_object", """
    SELECT candidate_id,
           CAST(json_object('degree', degree, 'institution', institution, 'year', year)
                AS VARCHAR) AS education
    FROM stg_candidates LEFT JOIN stg_educations USING (candidate_id)""")
def _(spark, sf):
    dim = marts.dim_candidate(
        c.staged(spark, sf, "candidates"), c.staged(spark, sf, "education"), c.NOW
    )
    return dim.select("candidate_id", "education")


@query("b12_date_diff_days", """
    SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) AS days
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(spark, sf):
    orders = c.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = c.table(spark, sf, "lineitem")
    return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber",
        days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"),
    )


@query("b13_conditional_flag", """
    SELECT candidate_id, coalesce(degree = 'PHD', FALSE) AS is_doctor
    FROM stg_candidates LEFT JOIN stg_educations USING (candidate_id)""")
def _(spark, sf):
    degrees = c.staged(spark, sf, "education").select("candidate_id", "degree")
    return (
        c.staged(spark, sf, "candidates")
        .join(degrees, "candidate_id", "left")
        .select("candidate_id", with_flag(F.col("degree") == "PHD").alias("is_doctor"))
    )


@query("b14_processing_timestamp", """
    SELECT '2024-01-04 12:00:00' AS _processed_ts, count(*) AS n FROM orders""")
def _(spark, sf):
    return (
        c.staged(spark, sf, "applications")
        .groupBy("_processed_ts")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("b15_like_predicate", """
    SELECT candidate_id, email FROM stg_candidates WHERE NOT contains(email, '@example.')""")
def _(spark, sf):
    people = c.staged(spark, sf, "candidates")
    return people.filter(~text.looks_like_email(F.col("email"))).select("candidate_id", "email")


@query("b16_predicates", """
    SELECT count(*) FILTER (department IS NULL) AS no_department,
           count(*) FILTER (status = 'OPEN') AS open,
           count(*) FILTER (posted_date < DATE '1997-01-01' AND status = 'DRAFT') AS old_drafts
    FROM stg_jobs""")
def _(spark, sf):
    old = F.col("posted_date") < F.lit("1997-01-01").cast("date")
    return c.staged(spark, sf, "jobs").agg(
        F.count_if(F.col("department").isNull()).alias("no_department"),
        F.count_if(F.col("status") == "OPEN").alias("open"),
        F.count_if(old & (F.col("status") == "DRAFT")).alias("old_drafts"),
    )


@query("b17_null_coalesce_cast", """
    SELECT job_id, coalesce(department, 'UNKNOWN') AS department,
           CAST(job_id AS BIGINT) AS number,
           CASE WHEN status = 'OPEN' THEN title END AS open_title
    FROM stg_jobs""")
def _(spark, sf):
    return c.staged(spark, sf, "jobs").select(
        "job_id", F.coalesce("department", F.lit("UNKNOWN")).alias("department"),
        F.col("job_id").cast("bigint").alias("number"),
        F.when(F.col("status") == "OPEN", F.col("title")).alias("open_title"),
    )


@query("b18_rename", "SELECT event_id, new_status AS current_status FROM stg_events")
def _(spark, sf):
    return c.staged(spark, sf, "workflow_events").select(
        "event_id", F.col("new_status").alias("current_status")
    )


# -- joins ---------------------------------------------------------------------------------------


@query("j01_inner_join", """
    SELECT application_id, job_id, title, department
    FROM stg_applications JOIN stg_jobs USING (job_id)""")
def _(spark, sf):
    jobs = c.staged(spark, sf, "jobs").select("job_id", "title", "department")
    return (
        c.staged(spark, sf, "applications")
        .join(jobs, "job_id")
        .select("application_id", "job_id", "title", "department")
    )


@query("j02_left_join", """
    SELECT event_id, application_id, CAST(apply_date AS VARCHAR) AS apply_date, is_anomaly
    FROM int_events""")
def _(spark, sf):
    return intermediate.with_apply_date(
        c.staged(spark, sf, "workflow_events"), c.staged(spark, sf, "applications")
    ).select("event_id", "application_id", "apply_date", "is_anomaly")


@query("j03_impacted_key_join", """
    SELECT event_id, application_id FROM stg_events
    WHERE application_id IN (SELECT application_id FROM stg_events
                             WHERE day = DATE '2024-01-03')""")
def _(spark, sf):
    events = c.staged(spark, sf, "workflow_events")
    keys = distinct_keys("application_id", ingested_on(events, c.DAYS[2]))
    return history_of(events, keys, "application_id").select("event_id", "application_id")


@query("j04_equi_join_inequality", """
    SELECT event_id, application_id, CAST(event_timestamp AS VARCHAR) AS event_timestamp,
           CAST(apply_date AS VARCHAR) AS apply_date
    FROM int_events WHERE is_anomaly""")
def _(spark, sf):
    return audit.hired_before_applied(
        c.staged(spark, sf, "workflow_events"), c.staged(spark, sf, "applications")
    ).select("event_id", "application_id", "event_timestamp", "apply_date")


@query("j05_anti_join", """
    SELECT candidate_id FROM stg_candidates
    WHERE candidate_id NOT IN (SELECT candidate_id FROM stg_educations)""")
def _(spark, sf):
    people = c.staged(spark, sf, "candidates").select("candidate_id")
    return orphans(people, "candidate_id", c.staged(spark, sf, "education"), "candidate_id")


# -- aggregates and sets -------------------------------------------------------------------------


@query("g01_count_rows", "SELECT status, count(*) AS n FROM stg_jobs GROUP BY status")
def _(spark, sf):
    return c.staged(spark, sf, "jobs").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("g02_count_column", "SELECT status, count(department) AS n FROM stg_jobs GROUP BY status")
def _(spark, sf):
    return c.staged(spark, sf, "jobs").groupBy("status").agg(F.count("department").alias("n"))


@query("g03_count_distinct", """
    SELECT candidate_id, count(DISTINCT job_id) AS jobs_applied
    FROM stg_applications GROUP BY candidate_id""")
def _(spark, sf):
    return analysis.jobs_per_candidate(c.staged(spark, sf, "applications"))


@query("g04_min_max_avg", """
    SELECT min(time_to_hire_days) AS lo, max(time_to_hire_days) AS hi,
           round(avg(time_to_hire_days), 6) AS mean
    FROM fct_apps""")
def _(spark, sf):
    days = F.col("time_to_hire_days")
    return c.facts(spark, sf).agg(
        F.min(days).alias("lo"), F.max(days).alias("hi"), F.round(F.avg(days), 6).alias("mean")
    )


@query("g05_conditional_sum", """
    SELECT current_status, CAST(sum(CASE WHEN is_hired THEN 1 ELSE 0 END) AS BIGINT) AS hired
    FROM fct_apps GROUP BY current_status""")
def _(spark, sf):
    return (
        c.facts(spark, sf).groupBy("current_status").agg(F.count_if("is_hired").alias("hired"))
    )


@query("g06_group_by_keys", """
    SELECT candidate_id, first_name, last_name, email, count(*) AS n
    FROM stg_applications JOIN stg_candidates USING (candidate_id) GROUP BY ALL""")
def _(spark, sf):
    people = c.staged(spark, sf, "candidates")
    per_candidate = (
        c.staged(spark, sf, "applications").groupBy("candidate_id").agg(
            F.count(F.lit(1)).alias("k"))
    )
    return (
        people.join(per_candidate, "candidate_id")
        .groupBy("candidate_id", "first_name", "last_name", "email")
        .agg(F.sum("k").alias("n"))
    )


@query("g07_having", """
    SELECT candidate_id, count(DISTINCT job_id) AS jobs_applied FROM stg_applications
    GROUP BY candidate_id HAVING count(DISTINCT job_id) > 12""")
def _(spark, sf):
    return analysis.jobs_per_candidate(c.staged(spark, sf, "applications")).filter(
        F.col("jobs_applied") > 12
    )


@query("g08_aggregate_over_aggregate", """
    SELECT jobs_applied, count(*) AS candidates
    FROM (SELECT count(DISTINCT job_id) AS jobs_applied FROM stg_applications
          GROUP BY candidate_id) GROUP BY jobs_applied""")
def _(spark, sf):
    return (
        analysis.jobs_per_candidate(c.staged(spark, sf, "applications"))
        .groupBy("jobs_applied")
        .agg(F.count(F.lit(1)).alias("candidates"))
    )


@query("g09_distinct", "SELECT DISTINCT application_id FROM stg_events")
def _(spark, sf):
    return distinct_keys("application_id", c.staged(spark, sf, "workflow_events"))


@query("g10_union_distinct", """
    SELECT application_id FROM stg_events WHERE day = DATE '2024-01-02'
    UNION
    SELECT application_id FROM stg_applications WHERE day = DATE '2024-01-02'""")
def _(spark, sf):
    return distinct_keys(
        "application_id",
        ingested_on(c.staged(spark, sf, "workflow_events"), c.DAYS[1]),
        ingested_on(c.staged(spark, sf, "applications"), c.DAYS[1]),
    )


# -- windows, order, limit -----------------------------------------------------------------------


@query("w01_dedupe_latest", """
    SELECT job_id, title, department, status, '2024-01-02' AS _ingestion_date FROM job_files""")
def _(spark, sf):
    raw = c.raw(spark, sf, "jobs")
    newest = latest_by(raw, ["job_id"], [F.col("_ingestion_ts").desc_nulls_last(),
                                         F.col("_record_hash").desc_nulls_last()])
    return newest.select("job_id", "title", "department", "status", "_ingestion_date")


_SEQUENCE = "SELECT event_id, application_id, event_sequence FROM int_events"


@query("w02_event_sequence", _SEQUENCE)
def _(spark, sf):
    return number_rows(
        c.staged(spark, sf, "workflow_events"), "application_id", intermediate.timeline(),
        "event_sequence", c.hot_applications(spark, sf),
    ).select("event_id", "application_id", "event_sequence")


@query("w02_event_sequence_spread", _SEQUENCE)
def _(spark, sf):
    return number_across_ranges(
        c.staged(spark, sf, "workflow_events").select(
            "event_id", "application_id", "event_timestamp"
        ),
        "application_id", intermediate.timeline(), "event_sequence",
    ).select("event_id", "application_id", "event_sequence")


@query("w03_latest_status", """
    SELECT application_id, current_status FROM fct_apps WHERE current_status IS NOT NULL""")
def _(spark, sf):
    newest = latest_by(
        c.enriched(spark, sf), ["application_id"],
        [F.col("event_timestamp").desc_nulls_last(), F.col("event_sequence").desc()],
    )
    return newest.select("application_id", F.col("new_status").alias("current_status"))


@query("w04_order_by_keys", """
    SELECT candidate_id, jobs_applied,
           row_number() OVER (ORDER BY jobs_applied DESC, candidate_id) AS place
    FROM (SELECT candidate_id, count(DISTINCT job_id) AS jobs_applied FROM stg_applications
          GROUP BY candidate_id)""")
def _(spark, sf):
    counted = analysis.jobs_per_candidate(c.staged(spark, sf, "applications"))
    ranked = number_across_ranges(
        counted.withColumn("_all", F.lit(0)), "_all",
        [F.col("jobs_applied").desc(), F.col("candidate_id").asc()], "place",
    )
    return ranked.select("candidate_id", "jobs_applied", "place")


@query("w05_top_k", """
    SELECT department, count(*) AS total_applications
    FROM stg_applications JOIN stg_jobs USING (job_id) GROUP BY department
    ORDER BY total_applications DESC, department NULLS LAST LIMIT 3""")
def _(spark, sf):
    return analysis.top_departments(
        c.staged(spark, sf, "applications"), c.staged(spark, sf, "jobs"), k=3
    )


# -- datasets ------------------------------------------------------------------------------------


@query("m01_stg_jobs", """
    SELECT job_id, title, department, status, CAST(posted_date AS VARCHAR) AS posted_date,
           CAST(day AS VARCHAR) AS _ingestion_date FROM stg_jobs""")
def _(spark, sf):
    return c.staged(spark, sf, "jobs").select(
        "job_id", "title", "department", "status", "posted_date", "_ingestion_date"
    )


@query("m02_stg_candidates", """
    SELECT candidate_id, first_name, last_name, email, md5(email) AS email_hash, phone,
           md5(phone) AS phone_hash, skills_normalized, skills_count,
           replace(skills_normalized, ',', '|') AS skills_array FROM stg_candidates""")
def _(spark, sf):
    return c.staged(spark, sf, "candidates").select(
        "candidate_id", "first_name", "last_name", "email", "email_hash", "phone", "phone_hash",
        "skills_normalized", "skills_count", "skills_array",
    )


@query("m03_stg_educations", "SELECT candidate_id, degree, institution, year FROM stg_educations")
def _(spark, sf):
    return c.staged(spark, sf, "education").select(
        "candidate_id", "degree", "institution", "year"
    )


@query("m04_stg_applications", """
    SELECT application_id, job_id, candidate_id, CAST(apply_date AS VARCHAR) AS apply_date,
           CAST(day AS VARCHAR) AS _ingestion_date FROM stg_applications""")
def _(spark, sf):
    return c.staged(spark, sf, "applications").select(
        "application_id", "job_id", "candidate_id", "apply_date", "_ingestion_date"
    )


@query("m05_stg_workflow_events", """
    SELECT event_id, application_id, old_status, new_status,
           CAST(event_timestamp AS VARCHAR) AS event_timestamp,
           CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date,
           CAST(day AS VARCHAR) AS _ingestion_date FROM stg_events""")
def _(spark, sf):
    return c.staged(spark, sf, "workflow_events").select(
        "event_id", "application_id", "old_status", "new_status", "event_timestamp", "event_date",
        "_ingestion_date",
    )


ENRICHED_SQL = """
    SELECT event_id, application_id, old_status, new_status,
           CAST(event_timestamp AS VARCHAR) AS event_timestamp,
           CAST(apply_date AS VARCHAR) AS apply_date, is_anomaly, event_sequence
    FROM int_events"""
ENRICHED_COLUMNS = [
    "event_id", "application_id", "old_status", "new_status", "event_timestamp", "apply_date",
    "is_anomaly", "event_sequence",
]


@query("m06_int_workflow_events_enriched", ENRICHED_SQL)
def _(spark, sf):
    return c.enriched(spark, sf).select(*ENRICHED_COLUMNS)


@query("m07_dim_job", """
    SELECT job_id, title, department, CAST(posted_date AS VARCHAR) AS posted_date, status
    FROM stg_jobs""")
def _(spark, sf):
    return marts.dim_job(c.staged(spark, sf, "jobs"), c.NOW).drop("_updated_at")


@query("m08_dim_candidate", """
    SELECT candidate_id, first_name, last_name, email, md5(email) AS email_hash, phone,
           md5(phone) AS phone_hash, replace(skills_normalized, ',', '|') AS skills,
           CAST(json_object('degree', degree, 'institution', institution, 'year', year)
                AS VARCHAR) AS education
    FROM stg_candidates LEFT JOIN stg_educations USING (candidate_id)""")
def _(spark, sf):
    return marts.dim_candidate(
        c.staged(spark, sf, "candidates"), c.staged(spark, sf, "education"), c.NOW
    ).drop("_updated_at")


FACTS_SQL = """
    SELECT application_id, job_id, candidate_id, CAST(apply_date AS VARCHAR) AS apply_date,
           CAST(hired_date AS VARCHAR) AS hired_date, current_status, is_hired,
           time_to_hire_days
    FROM fct_apps"""
FACTS_COLUMNS = [
    "application_id", "job_id", "candidate_id", "apply_date", "hired_date", "current_status",
    "is_hired", "time_to_hire_days",
]


@query("m09_fct_applications", FACTS_SQL)
def _(spark, sf):
    return c.facts(spark, sf).select(*FACTS_COLUMNS)


@query("m10_fct_workflow_events", """
    SELECT event_id, application_id, old_status, new_status,
           CAST(event_timestamp AS VARCHAR) AS event_timestamp,
           CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, event_sequence,
           is_anomaly, CAST(day AS VARCHAR) AS _ingestion_date
    FROM int_events""")
def _(spark, sf):
    return marts.fct_workflow_events(c.enriched(spark, sf), c.NOW).drop(
        "_updated_at", "_ingestion_ts", "_batch_id"
    )


TIME_TO_HIRE_SQL = """
    SELECT job_id, title, department, applications_count, hired_applications_count,
           round(avg_time_to_hire_days, 6) AS avg_time_to_hire_days, min_time_to_hire_days,
           max_time_to_hire_days
    FROM tth"""


def rounded_time_to_hire(df: DataFrame) -> DataFrame:
    return df.drop("_updated_at").withColumn(
        "avg_time_to_hire_days", F.round("avg_time_to_hire_days", 6)
    )


@query("m11_agg_time_to_hire", TIME_TO_HIRE_SQL)
def _(spark, sf):
    return rounded_time_to_hire(c.time_to_hire(spark, sf))


@query("m12_dq_hired_before_applied", """
    SELECT event_id, application_id, old_status, new_status,
           CAST(event_timestamp AS VARCHAR) AS event_timestamp,
           CAST(apply_date AS VARCHAR) AS apply_date,
           date_diff('day', event_timestamp, CAST(apply_date AS TIMESTAMP)) AS days_before_apply,
           CAST(day AS VARCHAR) AS _ingestion_date
    FROM int_events WHERE is_anomaly""")
def _(spark, sf):
    return audit.dq_hired_before_applied_anomalies(
        c.staged(spark, sf, "workflow_events"), c.staged(spark, sf, "applications"), c.NOW
    ).drop("_batch_id", "detected_at")


# -- hiring questions ----------------------------------------------------------------------------


@query("s01_open_jobs", "SELECT count(*) AS open_jobs FROM part WHERE p_size <= 17")
def _(spark, sf):
    return analysis.open_jobs(c.staged(spark, sf, "jobs"))


@query("s02_eager_candidate_count", """
    SELECT count(*) AS candidates_with_more_than_12_jobs
    FROM (SELECT candidate_id FROM stg_applications GROUP BY candidate_id
          HAVING count(DISTINCT job_id) > 12)""")
def _(spark, sf):
    return analysis.eager_candidate_count(c.staged(spark, sf, "applications"), 12)


@query("s03_eager_candidates", """
    SELECT candidate_id, first_name, last_name, email, count(DISTINCT job_id) AS jobs_applied
    FROM stg_applications JOIN stg_candidates USING (candidate_id)
    GROUP BY ALL HAVING count(DISTINCT job_id) > 3""")
def _(spark, sf):
    return analysis.eager_candidates(
        c.staged(spark, sf, "applications"), c.staged(spark, sf, "candidates")
    )


@query("s04_top_departments", """
    SELECT department, count(application_id) AS total_applications
    FROM stg_applications JOIN stg_jobs USING (job_id) GROUP BY department
    ORDER BY total_applications DESC, department NULLS LAST LIMIT 5""")
def _(spark, sf):
    return analysis.top_departments(
        c.staged(spark, sf, "applications"), c.staged(spark, sf, "jobs")
    )
