"""Queries with the SQL that must give the same rows."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL over the given tables unless SQL cannot express it."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(run(spark, sf_dir))
        if sql is not None:
            REFERENCE_SQL[name] = with_ctes(sql)
        return run

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and lists as joined text, alike in every engine."""
    columns = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, "|")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def written_row(df: DataFrame, path: str) -> DataFrame:
    """What a frame holds at this moment, whatever is written later."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The hiring sources and datasets, written in SQL straight from the given tables: values are
# taken before they are rendered as text, so cleaning and parsing are checked independently.
_CTES = {
    "job_files": """
        SELECT CAST(p_partkey AS VARCHAR) AS job_id,
               '  ' || p_name || ' ' AS title,
               CASE WHEN p_type <> 'PROMO' THEN ' ' || lower(p_type) END AS department,
               CASE p_type WHEN 'ECONOMY' THEN strftime(posted, '%Y-%m-%d')
                    WHEN 'MEDIUM' THEN strftime(posted, '%Y/%m/%d')
                    WHEN 'STANDARD' THEN strftime(posted, '%Y.%m.%d')
                    WHEN 'PROMO' THEN strftime(posted, '%d-%b-%Y')
                    WHEN 'SMALL' THEN strftime(posted, '%B %d, %Y')
                    ELSE strftime(posted, '%m/%d/%Y') END AS posted_date,
               CASE WHEN p_size <= 17 THEN 'Open' WHEN p_size <= 34 THEN ' closed '
                    ELSE 'Draft' END AS status
        FROM (SELECT *, DATE '1995-01-01' + 29 * p_size AS posted FROM part)""",
    "stg_jobs": """
        SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name AS title,
               CASE WHEN p_type <> 'PROMO' THEN upper(p_type) END AS department,
               CASE WHEN p_size <= 17 THEN 'OPEN' WHEN p_size <= 34 THEN 'CLOSED'
                    ELSE 'DRAFT' END AS status,
               DATE '1995-01-01' + 29 * p_size AS posted_date,
               DATE '2024-01-02' AS day
        FROM part""",
    "people": """
        SELECT CAST(c_custkey AS VARCHAR) AS candidate_id, c_name AS name, c_acctbal AS balance,
               c_nationkey AS nation, c_mktsegment AS segment, DATE '2024-01-01' AS day
        FROM customer
        UNION ALL
        SELECT 'S' || s_suppkey, s_name, s_acctbal, s_nationkey, NULL, DATE '2024-01-02'
        FROM supplier""",
    "candidate_files": """
        SELECT candidate_id, ' ' || split_part(name, '#', 1) AS first_name,
               split_part(name, '#', 2) || ' ' AS last_name,
               ' ' || replace(name, '#', '-')
                   || CASE WHEN balance < 0 THEN '@invalid' ELSE '@Example.COM ' END AS email,
               ' +1-' || nation || '-' || replace(candidate_id, 'S', '') AS phone,
               segment, day
        FROM people""",
    "stg_candidates": """
        SELECT candidate_id, split_part(name, '#', 1) AS first_name,
               split_part(name, '#', 2) AS last_name,
               lower(replace(name, '#', '-'))
                   || CASE WHEN balance < 0 THEN '@invalid' ELSE '@example.com' END AS email,
               '+1-' || nation || '-' || replace(candidate_id, 'S', '') AS phone,
               CASE WHEN segment IS NOT NULL THEN segment || ',spark,sql' END AS skills_normalized,
               CAST(CASE WHEN segment IS NULL THEN 0 ELSE 3 END AS BIGINT) AS skills_count,
               day
        FROM people""",
    "stg_educations": """
        SELECT CAST(c_custkey AS VARCHAR) AS candidate_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'BS' WHEN 'FURNITURE' THEN 'BS'
                    WHEN 'MACHINERY' THEN 'MS' WHEN 'AUTOMOBILE' THEN 'PHD'
                    WHEN 'HOUSEHOLD' THEN 'DIPLOMA' END AS degree,
               n_name AS institution, 1990 + c_nationkey AS year
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "application_files": """
        SELECT CAST(o_orderkey AS VARCHAR) AS application_id,
               CAST(o_orderkey * 2 // 15 AS VARCHAR) AS job_id,
               CAST(o_custkey AS VARCHAR) AS candidate_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y/%m/%d')
                    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y.%m.%d')
                    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d-%b-%Y')
                    ELSE strftime(o_orderdate, '%B %d, %Y') END AS apply_date,
               CASE o_orderstatus WHEN 'F' THEN DATE '2024-01-01' WHEN 'O' THEN DATE '2024-01-02'
                    ELSE DATE '2024-01-03' END AS day
        FROM orders""",
    "stg_applications": """
        SELECT CAST(o_orderkey AS VARCHAR) AS application_id,
               CAST(o_orderkey * 2 // 15 AS VARCHAR) AS job_id,
               CAST(o_custkey AS VARCHAR) AS candidate_id,
               CAST(o_orderdate AS DATE) AS apply_date,
               CASE o_orderstatus WHEN 'F' THEN DATE '2024-01-01' WHEN 'O' THEN DATE '2024-01-02'
                    ELSE DATE '2024-01-03' END AS day
        FROM orders""",
    "steps": """
        SELECT *, ['Applied', 'Screening', 'Interview', 'Offer', 'Withdrawn', 'Rejected',
                   'Hired'] AS names
        FROM lineitem""",
    "event_files": """
        SELECT CAST(l_orderkey AS VARCHAR) AS application_id,
               CASE WHEN l_linestatus = 'O' THEN ' ' || upper(names[l_linenumber - 1])
                    ELSE names[l_linenumber - 1] END AS old_status,
               CASE WHEN l_linestatus = 'O' THEN ' ' || upper(names[l_linenumber])
                    ELSE names[l_linenumber] END AS new_status,
               CASE WHEN l_returnflag = 'N' THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS event_timestamp,
               CASE l_returnflag WHEN 'A' THEN DATE '2024-01-01' WHEN 'R' THEN DATE '2024-01-02'
                    ELSE DATE '2024-01-03' END AS day,
               l_shipdate AS happened, upper(names[l_linenumber - 1]) AS old_name,
               upper(names[l_linenumber]) AS new_name
        FROM steps""",
    "stg_events": """
        SELECT md5(application_id || '||' || coalesce(old_status, '') || '||' || new_status
                   || '||' || event_timestamp) AS event_id,
               min(application_id) AS application_id, min(old_name) AS old_status,
               min(new_name) AS new_status, min(happened) AS event_timestamp, max(day) AS day
        FROM event_files GROUP BY 1""",
    "int_events": """
        SELECT e.*, a.apply_date,
               e.new_status = 'HIRED' AND coalesce(e.event_timestamp < a.apply_date, FALSE)
                   AS is_anomaly,
               row_number() OVER (PARTITION BY e.application_id
                                  ORDER BY e.event_timestamp, e.event_id) AS event_sequence
        FROM stg_events e LEFT JOIN stg_applications a USING (application_id)""",
    "fct_apps": """
        SELECT a.*, h.hired_date, l.current_status, h.hired_date IS NOT NULL AS is_hired,
               date_diff('day', CAST(a.apply_date AS TIMESTAMP), h.hired_date)
                   AS time_to_hire_days
        FROM stg_applications a
        LEFT JOIN (SELECT application_id, min(event_timestamp) AS hired_date FROM int_events
                   WHERE new_status = 'HIRED' AND NOT is_anomaly GROUP BY ALL) h
               USING (application_id)
        LEFT JOIN (SELECT application_id, new_status AS current_status FROM int_events
                   QUALIFY row_number() OVER (PARTITION BY application_id
                           ORDER BY event_timestamp DESC, event_sequence DESC) = 1) l
               USING (application_id)""",
    "tth": """
        SELECT j.job_id, j.title, j.department, count(*) AS applications_count,
               count(*) AS hired_applications_count,
               avg(f.time_to_hire_days) AS avg_time_to_hire_days,
               min(f.time_to_hire_days) AS min_time_to_hire_days,
               max(f.time_to_hire_days) AS max_time_to_hire_days
        FROM fct_apps f LEFT JOIN stg_jobs j USING (job_id)
        WHERE f.is_hired GROUP BY ALL""",
}


def with_ctes(sql: str) -> str:
    """Put the definitions a statement refers to, directly or not, in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in _CTES.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                todo.append(body)
    ctes = [f"{name} AS ({body})" for name, body in _CTES.items() if name in needed]
    if not ctes:
        return sql
    own = sql.strip()
    rest = own.removeprefix("WITH ")
    return f"WITH {', '.join(ctes)}{', ' if rest != own else chr(10)}{rest}"


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split()
    return name in words
