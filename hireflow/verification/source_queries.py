"""Reading, identity, ledger and raw tables, over files written from the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hireflow.functions import hashing, lists
from hireflow.functions.text import null_if_token
from hireflow.operators.profile import source_inventory
from hireflow.plans import staging
from hireflow.session import scratch_path, unsorted_writes
from hireflow.sources import checksums, readers
from hireflow.sources.ingest import RawStore, load_all_sources
from hireflow.sources.layout import compact_partitions, write_events
from hireflow.operators.keyed_table import CODEC, KeyedTable
from hireflow.sources.quarantine import event_rules, load_rules, tag_malformed, tag_rejects
from hireflow.sources.schemas import EVENTS_FILE, SOURCES
from hireflow.streaming.events import start_event_ingestion, start_status_updates
from hireflow.verification import canonical as c
from hireflow.verification.registry import query, written_row

FIRST = datetime(2024, 2, 1, 6)
SECOND = FIRST + timedelta(days=1)

_stores: dict[tuple[str, str], tuple[RawStore, list[list[dict]]]] = {}


def loaded_twice(spark: SparkSession, sf_dir: str) -> tuple[RawStore, list[list[dict]]]:
    """All files loaded on one day and replayed on the next, with the outcomes."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo not in _stores:
        store = RawStore(spark, scratch_path(spark, "raw"))
        files = c.source_files(spark, sf_dir)
        _stores[memo] = (
            store, [load_all_sources(store, files, FIRST), load_all_sources(store, files, SECOND)]
        )
    return _stores[memo]


def scan(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    spec = SOURCES[source]
    path = readers.source_path(spec.file_name, c.source_files(spark, sf_dir, source))
    return readers.read_source(spark, spec, path).select(*spec.columns.names)


def outcomes(spark: SparkSession, loads: list[dict]) -> DataFrame:
    rows = [(x["source"], x["outcome"], x["rows"], x["rejected"]) for x in loads]
    return spark.createDataFrame(
        rows, "source string, outcome string, rows bigint, rejected bigint"
    )


@query("a01_csv_scan", "SELECT application_id, job_id, candidate_id, apply_date FROM application_files")
def _(spark, sf):
    return scan(spark, sf, "applications")


@query("a01_unfit_cells", """
    SELECT CAST(c_custkey AS VARCHAR) AS candidate_id,
           CASE WHEN c_custkey % 3 = 0 THEN 'rejected' ELSE 'loaded' END AS outcome,
           CASE c_custkey % 3 WHEN 1 THEN 2010 WHEN 2 THEN 1990 + c_nationkey END AS year
    FROM customer""")
def _(spark, sf):
    """Years that are no numbers are kept aside with their line; ``2010.0`` is a whole number."""
    root = scratch_path(spark, "unfit")
    kind = F.col("c_custkey") % 3
    year = (
        F.when(kind == 0, "20x0").when(kind == 1, "2010.0").otherwise(
            (1990 + F.col("c_nationkey")).cast("string")
        )
    )
    c.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("candidate_id"), F.lit("BS").alias("degree"),
        F.col("c_name").alias("institution"), year.alias("year"),
    ).write.option("header", True).csv(f"{root}/education.csv")
    store = RawStore(spark, f"{root}/raw")
    store.load(SOURCES["education"], f"{root}/education.csv", FIRST)
    good = store.read("education").select("candidate_id", F.lit("loaded").alias("outcome"), "year")
    line = F.col(readers.CORRUPT)
    return good.unionByName(
        store.quarantined("education").select(
            F.get_json_object(line, "$.candidate_id").alias("candidate_id"),
            F.lit("rejected").alias("outcome"),
            F.lit(None).cast("int").alias("year"),
        )
    )


@query("a02_csv_null_tokens", """
    SELECT job_id, title, department, posted_date, status FROM job_files""")
def _(spark, sf):
    return scan(spark, sf, "jobs")


@query("a02_null_tokens_in_columns", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' END AS segment
    FROM customer""")
def _(spark, sf):
    tokens = {"FURNITURE": "N/A", "HOUSEHOLD": "null", "MACHINERY": "None", "AUTOMOBILE": ""}
    cell = F.col("c_mktsegment")
    for segment, token in tokens.items():
        cell = F.when(F.col("c_mktsegment") == segment, token).otherwise(cell)
    return c.table(spark, sf, "customer").select("c_custkey", null_if_token(cell).alias("segment"))


@query("a03_json_array_scan", """
    SELECT candidate_id, first_name, last_name, email, phone,
           '["' || segment || '"," spark","sql "]' AS skills FROM candidate_files""")
def _(spark, sf):
    return scan(spark, sf, "candidates")


@query("a04_jsonl_scan", """
    SELECT application_id, old_status, new_status, event_timestamp FROM event_files""")
def _(spark, sf):
    return scan(spark, sf, "workflow_events")


@query("a05_source_resolver", """
    SELECT 'jobs.csv' AS file, count(*) AS rows FROM part
    UNION ALL SELECT 'applications.csv', count(*) FROM orders
    UNION ALL SELECT 'education.csv', count(*) FROM customer
    UNION ALL SELECT 'workflow_events.jsonl', count(*) FROM lineitem
    UNION ALL SELECT 'candidates.json', count(*) FROM people""")
def _(spark, sf):
    counts = [
        scan(spark, sf, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(spec.file_name).alias("file"), "rows"
        )
        for name, spec in SOURCES.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("a06_empty_source_guard", """
    SELECT 'applications' AS source, 'empty' AS outcome, CAST(0 AS BIGINT) AS rows,
           CAST(0 AS BIGINT) AS rejected
    UNION ALL SELECT 'education', 'loaded', count(*), 0 FROM customer""")
def _(spark, sf):
    root = scratch_path(spark, "empty")
    nothing = c.file_rows(spark, sf, "applications").filter("application_id IS NULL")
    nothing.coalesce(1).drop("_ingestion_date").write.option("header", True).csv(
        f"{root}/applications.csv"
    )
    store = RawStore(spark, f"{root}/raw")
    education = SOURCES["education"]
    return outcomes(
        spark,
        [
            store.load(SOURCES["applications"], f"{root}/applications.csv", FIRST),
            store.load(
                education,
                readers.source_path(education.file_name, c.source_files(spark, sf, "education")),
                FIRST,
            ),
        ],
    )


def _sum_sql(lane: int) -> str:
    """A file's sum for one quarter of the MD5s, its powers by squaring."""
    squares = ", ".join(str(pow(checksums.BASES[lane], 1 << k, checksums.PRIME)) for k in range(32))
    power = f"""list_reduce(list_transform(range(0, 32), lambda k:
        CASE WHEN (place >> k) & 1 = 1 THEN CAST(([{squares}])[k + 1] AS BIGINT) ELSE 1 END),
        lambda a, b: a * b % {checksums.PRIME})"""
    quarter = f"CAST('0x' || substr(md5(line), {8 * lane + 1}, 8) AS BIGINT)"
    return f"CAST(sum(CAST({quarter} * {power} % {checksums.PRIME} AS HUGEINT)) % {checksums.PRIME} AS VARCHAR)"


@query("a07_file_checksum", f"""
    WITH lines AS (SELECT o_orderkey % 16 AS part, o_orderkey AS key,
                          o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS line FROM orders),
    files AS (
        SELECT 'plain' AS version, part, line, row_number() OVER (PARTITION BY part ORDER BY key) - 1 AS place
        FROM lines
        UNION ALL SELECT 'reversed', part, line, row_number() OVER (PARTITION BY part ORDER BY key DESC) - 1
        FROM lines
        UNION ALL SELECT 'crlf', part, line || chr(13), row_number() OVER (PARTITION BY part ORDER BY key) - 1
        FROM lines)
    SELECT version, part, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS length,
           md5(concat_ws('|', CAST(sum(octet_length(encode(line)) + 1) AS VARCHAR),
               CAST(count(*) AS VARCHAR), {", ".join(map(_sum_sql, range(4)))})) AS checksum
    FROM files GROUP BY version, part""")
def _(spark, sf):
    """Sixteen files in three versions: as they are, with lines reversed, and with other line ends."""
    root = scratch_path(spark, "checksums")
    orders = c.table(spark, sf, "orders").withColumn("part", F.col("o_orderkey") % 16)
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority")
    versions = {
        "plain": (line, F.col("o_orderkey").asc()),
        "reversed": (line, F.col("o_orderkey").desc()),
        "crlf": (F.concat(line, F.lit("\r")), F.col("o_orderkey").asc()),
    }
    parts = []
    for name, (text, order) in versions.items():
        orders.repartition(16, "part").sortWithinPartitions("part", order).select(
            "part", text.alias("value")
        ).write.partitionBy("part").text(f"{root}/{name}")
        parts.append(
            checksums.file_checksums(spark, f"{root}/{name}").select(
                F.lit(name).alias("version"),
                F.regexp_extract("path", "part=([0-9]+)", 1).cast("long").alias("part"),
                "length", "checksum",
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query("a08_batch_id", """
    SELECT page_id, md5('pages|' || url || '|' || md5(html)) AS batch_id FROM pages""")
def _(spark, sf):
    pages = spark.read.schema("page_id bigint, url string, html string").parquet(
        f"{sf}/pages.parquet"
    )
    return pages.select(
        "page_id",
        hashing.batch_key(F.lit("pages"), F.col("url"), F.md5("html")).alias("batch_id"),
    )


@query("a09_record_hash", """
    SELECT 'applications' AS source, application_id AS key,
           md5(application_id || '||' || job_id || '||' || candidate_id || '||' || apply_date)
               AS _record_hash
    FROM application_files
    UNION ALL
    SELECT 'education', CAST(c_custkey AS VARCHAR),
           md5(c_custkey || '||' ||
               CASE c_mktsegment WHEN 'BUILDING' THEN 'bs' WHEN 'MACHINERY' THEN ' MS'
                    WHEN 'AUTOMOBILE' THEN 'PhD ' WHEN 'FURNITURE' THEN 'BS'
                    ELSE 'Diploma' END
               || '|| ' || n_name || '||' || (1990 + c_nationkey))
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    UNION ALL
    SELECT 'jobs', job_id, md5(job_id || '||' || title || '||' || coalesce(department, '')
                               || '||' || posted_date || '||' || status)
    FROM job_files
    UNION ALL
    SELECT 'candidates', candidate_id,
           md5(candidate_id || '||' || first_name || '||' || last_name || '||' || email || '||'
               || phone || '||' || coalesce(segment || ',spark,sql', ''))
    FROM candidate_files""")
def _(spark, sf):
    keys = {"applications": "application_id", "education": "candidate_id", "jobs": "job_id",
            "candidates": "candidate_id"}
    frames = []
    for source, key in keys.items():
        raw = c.raw(spark, sf, source)
        if source == "jobs":
            raw = raw.filter(F.col("_ingestion_date") == F.lit(c.DAYS[1]))
        frames.append(
            raw.select(F.lit(source).alias("source"), F.col(key).alias("key"), "_record_hash")
        )
    return reduce(DataFrame.unionByName, frames)


@query("a10_event_id", """
    SELECT md5(application_id || '||' || coalesce(old_status, '') || '||' || new_status || '||'
               || event_timestamp) AS _event_id, application_id, new_status
    FROM event_files""")
def _(spark, sf):
    return c.raw(spark, sf, "workflow_events").select("_event_id", "application_id", "new_status")


@query("a11_lineage_columns", """
    SELECT 'application_daily_extract' AS _source_system, 'applications.csv' AS _file_name,
           CAST(day AS VARCHAR) AS _ingestion_date, CAST(day + INTERVAL 6 HOUR AS VARCHAR)
           AS _ingestion_ts, count(*) AS n FROM application_files GROUP BY ALL
    UNION ALL
    SELECT 'workflow_event_export', 'workflow_events.jsonl', CAST(day AS VARCHAR),
           CAST(day + INTERVAL 6 HOUR AS VARCHAR), count(*) FROM event_files GROUP BY ALL""")
def _(spark, sf):
    columns = ["_source_system", "_file_name", "_ingestion_date", "_ingestion_ts"]
    frames = [
        c.raw(spark, sf, s).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        for s in ("applications", "workflow_events")
    ]
    return frames[0].unionByName(frames[1])


@query("a12_raw_event_date", """
    SELECT application_id, event_timestamp, CAST(CAST(happened AS DATE) AS VARCHAR) AS _event_date
    FROM event_files""")
def _(spark, sf):
    return c.raw(spark, sf, "workflow_events").select(
        "application_id", "event_timestamp", "_event_date"
    )


@query("a13_list_to_csv", "SELECT candidate_id, segment || ', spark,sql ' AS skills FROM people")
def _(spark, sf):
    return scan(spark, sf, "candidates").select(
        "candidate_id", lists.list_to_csv(F.col("skills")).alias("skills")
    )


@query("a14_order_free_hash_input", """
    SELECT candidate_id, segment || ',spark,sql' AS hash_input,
           segment || ',spark,sql' AS reversed_input FROM people""")
def _(spark, sf):
    items = lists.list_from_json(F.col("skills"))
    return scan(spark, sf, "candidates").select(
        "candidate_id",
        lists.order_free_csv(F.col("skills")).alias("hash_input"),
        lists.order_free_csv(F.to_json(F.reverse(items))).alias("reversed_input"),
    )


@query("a15_pii_hash", """
    SELECT candidate_id, md5(lower(trim(email))) AS email_hash, md5(trim(phone)) AS phone_hash
    FROM candidate_files""")
def _(spark, sf):
    return c.raw(spark, sf, "candidates").select("candidate_id", "email_hash", "phone_hash")


@query("a16_contract_projection", """
    SELECT application_id, job_id, candidate_id, apply_date, CAST(day AS VARCHAR)
           AS _ingestion_date, md5('applications||' || day) AS _batch_id,
           CAST(day + INTERVAL 6 HOUR AS VARCHAR) AS _ingestion_ts,
           'application_daily_extract' AS _source_system, 'applications.csv' AS _file_name,
           md5('applications.csv') AS _source_file_checksum,
           md5(application_id || '||' || job_id || '||' || candidate_id || '||' || apply_date)
               AS _record_hash
    FROM application_files""")
def _(spark, sf):
    return c.raw(spark, sf, "applications")


@query("a17_append_if_new_batch", """
    SELECT 'jobs' AS source, 'skipped' AS outcome, '2024-02-01' AS _ingestion_date,
           count(*) AS rows FROM part
    UNION ALL SELECT 'candidates', 'skipped', '2024-02-01', count(*) FROM people
    UNION ALL SELECT 'applications', 'skipped', '2024-02-01', count(*) FROM orders""")
def _(spark, sf):
    return _after_replay(spark, sf, ["jobs", "candidates", "applications"])


@query("a17_changed_file", """
    SELECT kind, CAST(number AS BIGINT) AS number, outcome, CASE outcome WHEN 'loaded' THEN n ELSE 0 END AS rows,
           CASE number WHEN 0 THEN n ELSE 2 * n END AS stored,
           CASE number WHEN 0 THEN first ELSE second END AS open_now
    FROM (SELECT count(*) AS n,
                 count(*) FILTER (p_partkey % 2 = 0) AS even, count(*) FILTER (p_partkey % 2 = 1) AS odd,
                 count(*) FILTER (p_partkey % 4 IN (0, 3)) AS outer_two,
                 count(*) FILTER (p_partkey % 4 IN (1, 2)) AS inner_two FROM part) AS c,
         (VALUES (0, 'loaded'), (1, 'loaded'), (2, 'skipped')) AS l(number, outcome),
         LATERAL (VALUES ('equal length', c.even, c.odd), ('rearranged', c.outer_two, c.inner_two))
             AS k(kind, first, second)""")
def _(spark, sf):
    """A file, another of equal length in its place, and that one again.

    The second has every status exchanged; in the other kind there are only two different lines
    (but for the id), in the order A B B A and then B A A B. Folders have odd names.
    """
    spec, part = SOURCES["jobs"], c.table(spark, sf, "part")
    kinds = {
        "equal length": F.col("p_partkey") % 2 == 0,
        "rearranged": (F.col("p_partkey") % 4).isin(0, 3),
    }
    seen = []
    for kind, first in kinds.items():
        root = f"{scratch_path(spark, 'changed')}/a b%41#é"
        store = RawStore(spark, f"{root}/raw")
        for version, opened in (("first", first), ("second", ~first)):
            # for the rearranged kind ids would tell lines apart, so they are left out of the file
            key = F.lit("x") if kind == "rearranged" else F.col("p_partkey").cast("string")
            part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").select(
                key.alias("job_id"), F.lit("Cook").alias("title"), F.lit("Food").alias("department"),
                F.lit("2024-01-01").alias("posted_date"),
                F.when(opened, "Open").otherwise("Shut").alias("status"),
            ).write.option("header", True).csv(f"{root}/{version}/{spec.file_name}")
        loads = [("first", FIRST), ("second", SECOND), ("second", SECOND + timedelta(days=1))]
        for number, (version, now) in enumerate(loads):
            did = store.load(spec, f"{root}/{version}/{spec.file_name}", now)
            stored = store.read("jobs")
            counted = stored.groupBy("_ingestion_ts").agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "Open").alias("open")
            ).agg(F.sum("n").alias("stored"), F.max_by("open", "_ingestion_ts").alias("open_now"))
            seen.append(written_row(counted, f"{root}/seen-{number}").select(
                F.lit(kind).alias("kind"), F.lit(number).cast("long").alias("number"),
                F.lit(did["outcome"]).alias("outcome"), F.lit(did["rows"]).cast("long").alias("rows"),
                "stored", "open_now",
            ))
    return reduce(DataFrame.unionByName, seen)


@query("a18_batch_replace", """
    SELECT 'education' AS source, 'loaded' AS outcome, '2024-02-02' AS _ingestion_date,
           count(*) AS rows FROM customer
    UNION ALL SELECT 'workflow_events', 'loaded', '2024-02-02', count(*) FROM lineitem""")
def _(spark, sf):
    return _after_replay(spark, sf, ["education", "workflow_events"])


def _failing(*_):
    raise RuntimeError("lost")


@query("a18_failed_replay", """
    SELECT kind, candidate_id, degree, institution, year
    FROM stg_educations, (VALUES ('same day'), ('next day')) AS t(kind)""")
def _(spark, sf):
    """Education after a replay that failed, on the day of its first load and on the next."""
    spec = SOURCES["education"]
    path = readers.source_path(spec.file_name, c.source_files(spark, sf, "education"))
    seen = []
    for kind, again in (("same day", FIRST), ("next day", SECOND)):
        store = RawStore(spark, scratch_path(spark, "replay"))
        store.load(spec, path, FIRST)
        store._write = _failing
        try:
            store.load(spec, path, again)
        except RuntimeError:
            pass
        seen.append(staging.stg_educations(store.read("education"), FIRST).select(
            F.lit(kind).alias("kind"), "candidate_id", "degree", "institution", "year"))
    return reduce(DataFrame.unionByName, seen)


def _after_replay(spark: SparkSession, sf_dir: str, sources: list[str]) -> DataFrame:
    """What the second load did and the rows that are visible after it."""
    store, (_, second) = loaded_twice(spark, sf_dir)
    did = {x["source"]: x["outcome"] for x in second}
    return reduce(
        DataFrame.unionByName,
        [
            store.read(s).groupBy("_ingestion_date").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(s).alias("source"), F.lit(did[s]).alias("outcome"), "_ingestion_date", "rows"
            )
            for s in sources
        ],
    )


_LEDGER_SQL = """
    SELECT 'jobs' AS source_name, 'jobs.csv' AS file_name, 'append_snapshot' AS load_strategy,
           'SUCCEEDED' AS status, '2024-02-01 06:00:00' AS started_at, count(*) AS rows_loaded
    FROM part
    UNION ALL SELECT 'candidates', 'candidates.json', 'append_snapshot', 'SUCCEEDED',
                     '2024-02-01 06:00:00', count(*) FROM people
    UNION ALL SELECT 'applications', 'applications.csv', 'append_extract', 'SUCCEEDED',
                     '2024-02-01 06:00:00', count(*) FROM orders
    UNION ALL SELECT 'education', 'education.csv', 'batch_replace', 'SUCCEEDED',
                     '2024-02-02 06:00:00', count(*) FROM customer
    UNION ALL SELECT 'workflow_events', 'workflow_events.jsonl', 'append_batch', 'SUCCEEDED',
                     '2024-02-02 06:00:00', count(*) FROM lineitem"""


@query("a23_reset_raw", """
    SELECT source_name, 'first' AS store, rows FROM (
        SELECT 'jobs' AS source_name, count(*) AS rows FROM part
        UNION ALL SELECT 'education', count(*) FROM customer)
    UNION ALL SELECT source_name, 'new', 0 FROM (VALUES ('jobs'), ('education')) v(source_name)
    UNION ALL SELECT source_name, 'new, loaded', rows FROM (
        SELECT 'jobs' AS source_name, count(*) AS rows FROM part
        UNION ALL SELECT 'education', count(*) FROM customer)""")
def _(spark, sf):
    """A new root is an empty store with all tables, which loads what another has loaded already."""
    files, parts = c.source_files(spark, sf, "jobs", "education"), []

    def counted(store: RawStore, label: str) -> None:
        for name in ("jobs", "education"):
            now = store.read(name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("source_name"), F.lit(label).alias("store"), "rows"
            )
            parts.append(written_row(now, scratch_path(spark, "reset-seen")))

    for label in ("first", "new"):
        store = RawStore(spark, scratch_path(spark, "reset"))
        if label == "new":
            counted(store, label)
        for name in ("jobs", "education"):
            path = readers.source_path(SOURCES[name].file_name, files)
            store.load(SOURCES[name], path, FIRST)
        counted(store, label if label == "first" else "new, loaded")
    return reduce(DataFrame.unionByName, parts)


@query("a20_load_strategies", f"""
    SELECT source_name, load_strategy, rows_loaded FROM ({_LEDGER_SQL})""")
def _(spark, sf):
    store, _ = loaded_twice(spark, sf)
    return store.ledger.batches().select("source_name", "load_strategy", "rows_loaded")


@query("a19_batch_ledger", _LEDGER_SQL)
def _(spark, sf):
    store, _ = loaded_twice(spark, sf)
    return store.ledger.batches().select(
        "source_name", "file_name", "load_strategy", "status", "started_at", "rows_loaded"
    )


@query("a21_raw_table_contracts", """
    WITH audit(names) AS (VALUES ('_ingestion_ts, _ingestion_date, _batch_id, _source_system, '
        || '_file_name, _source_file_checksum, _record_hash'))
    SELECT 'jobs' AS file, count(*) AS rows, CAST(12 AS BIGINT) AS columns,
           'job_id, title, department, posted_date, status, ' || any_value(names) AS column_names
    FROM part, audit
    UNION ALL
    SELECT 'education', count(*), 11,
           'candidate_id, degree, institution, year, ' || any_value(names) FROM customer, audit
    UNION ALL
    SELECT 'applications', count(*), 11,
           'application_id, job_id, candidate_id, apply_date, ' || any_value(names)
    FROM orders, audit
    UNION ALL
    SELECT 'candidates', n1 + n2, 15,
           'candidate_id, first_name, last_name, email, email_hash, phone, phone_hash, skills, '
           || names
    FROM (SELECT count(*) AS n1 FROM customer), (SELECT count(*) AS n2 FROM supplier), audit
    UNION ALL
    SELECT 'workflow_events', count(*), 13,
           '_event_id, application_id, old_status, new_status, event_timestamp, _event_date, '
           || any_value(names) FROM lineitem, audit""")
def _(spark, sf):
    store, _ = loaded_twice(spark, sf)
    return source_inventory({name: store.read(name) for name in SOURCES})


@query("a22_load_all_sources", """
    SELECT 'jobs' AS source, 'loaded' AS outcome, count(*) AS rows, CAST(0 AS BIGINT) AS rejected
    FROM part
    UNION ALL SELECT 'candidates', 'loaded', count(*), 0 FROM people
    UNION ALL SELECT 'applications', 'loaded', count(*), 0 FROM orders
    UNION ALL SELECT 'education', 'loaded', count(*), 0 FROM customer
    UNION ALL SELECT 'workflow_events', 'loaded', count(*), 0 FROM lineitem""")
def _(spark, sf):
    _, (first, _second) = loaded_twice(spark, sf)
    return outcomes(spark, first)


# -- large scale ---------------------------------------------------------------------------------


@query("l01_quarantine_split", """
    SELECT l_returnflag = 'R' AS quarantined,
           CASE WHEN l_returnflag <> 'R' THEN application_id END AS application_id,
           CASE WHEN l_returnflag <> 'R' THEN new_status END AS new_status,
           CASE WHEN l_returnflag = 'R' THEN '{"application_id":"' || application_id
                || '","new_status":"' || new_status || '"' END AS line
    FROM (SELECT l_returnflag, CAST(l_orderkey AS VARCHAR) AS application_id,
                 l_linestatus AS new_status FROM lineitem)""")
def _(spark, sf):
    """Every line with return flag R lacks its closing brace."""
    root = scratch_path(spark, "broken")
    whole = F.to_json(
        F.struct(F.col("l_orderkey").cast("string").alias("application_id"),
                 F.col("l_linestatus").alias("new_status"))
    )
    c.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.regexp_replace(whole, r"\}$", ""))
        .otherwise(whole)
        .alias("value")
    ).write.text(root)
    return tag_malformed(readers.jsonl_scan(spark, root, EVENTS_FILE)).select(
        F.col("_quarantined").alias("quarantined"), "application_id", "new_status",
        F.col("_corrupt_record").alias("line"),
    )


@query("l01_reject_rules", """
    SELECT application_id, new_status,
           CASE WHEN l_linenumber = 1 THEN 'new_status missing|event_timestamp unreadable'
                ELSE '' END AS reasons
    FROM (SELECT l_linenumber, CAST(l_orderkey AS VARCHAR) AS application_id,
                 CASE WHEN l_linenumber > 1 THEN l_linestatus END AS new_status FROM lineitem)""")
def _(spark, sf):
    first = F.col("l_linenumber") == 1
    events = c.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("application_id"),
        F.when(~first, F.col("l_linestatus")).alias("new_status"),
        F.when(~first, F.col("l_shipdate")).alias("event_timestamp"),
    )
    return tag_rejects(events, event_rules()).select(
        "application_id", "new_status", F.col("_reject_reasons").alias("reasons")
    )


@query("l02_streaming_event_ingestion", """
    SELECT DISTINCT md5(application_id || '||' || coalesce(old_status, '') || '||' || new_status
                        || '||' || event_timestamp) AS _event_id,
           application_id, old_status, new_status, event_timestamp
    FROM event_files""")
def _(spark, sf):
    store, files = streamed(spark, sf)
    return store.read("workflow_events").select(
        "_event_id", "application_id", "old_status", "new_status", "event_timestamp"
    )


def streamed(spark: SparkSession, sf_dir: str) -> tuple[RawStore, str]:
    """A store that all event files were streamed into, in several micro-batches, and the files."""
    root = scratch_path(spark, "stream")
    files = readers.source_path(
        SOURCES["workflow_events"].file_name, c.source_files(spark, sf_dir, "workflow_events")
    )
    store = RawStore(spark, f"{root}/raw", load_rules())
    start_event_ingestion(store, files, f"{root}/state", files_per_trigger=1).awaitTermination()
    return store, files


@query("l02_newest_status", """
    SELECT application_id, new_status AS current_status,
           CAST(event_timestamp AS VARCHAR) AS last_event_at
    FROM stg_events
    QUALIFY row_number() OVER (PARTITION BY application_id
                               ORDER BY event_timestamp DESC, event_id DESC) = 1""")
def _(spark, sf):
    """Kept as the stream's state, and written to a table as it changes."""
    root = scratch_path(spark, "statuses")
    files = readers.source_path(
        SOURCES["workflow_events"].file_name, c.source_files(spark, sf, "workflow_events")
    )
    table = KeyedTable(spark, f"{root}/table", ["application_id"], buckets=4)
    start_status_updates(table, files, f"{root}/state", files_per_trigger=1).awaitTermination()
    return table.read().select("application_id", "current_status", "last_event_at")


_BROKEN_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS application_id, l_linenumber % 5 AS kind,
           names[l_linenumber] AS new_status,
           strftime(l_shipdate, '%Y-%m-%d') AS event_timestamp
    FROM steps"""


def broken_events(spark: SparkSession, sf_dir: str) -> RawStore:
    """Events of which some lack their application, their status, a readable time or their last brace."""
    root = scratch_path(spark, "broken-events")
    kind = F.col("l_linenumber") % 5
    names = F.array(*[F.lit(s) for s in c.STATUSES])
    event = c.table(spark, sf_dir, "lineitem").select(
        F.when(kind != 1, F.col("l_orderkey").cast("string")).alias("application_id"),
        F.lit(None).cast("string").alias("old_status"),
        F.when(kind == 2, "  ").otherwise(F.get(names, F.col("l_linenumber") - 1)).alias("new_status"),
        F.when(kind.isin(2, 3), "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias(
            "event_timestamp"),
        kind.alias("kind"),
    )
    line = F.to_json(F.struct("application_id", "old_status", "new_status", "event_timestamp"))
    cut = F.when(F.col("kind") == 4, F.regexp_replace(line, r"\}$", "")).otherwise(line)
    event.select(cut.alias("value")).write.text(f"{root}/events.jsonl")
    store = RawStore(spark, f"{root}/raw", load_rules())
    store.load(SOURCES["workflow_events"], f"{root}/events.jsonl", FIRST)
    return store


@query("l01_quarantine_by_rules", f"""
    SELECT CASE kind WHEN 0 THEN '' WHEN 1 THEN 'application_id missing'
                WHEN 2 THEN 'new_status missing|event_timestamp unreadable'
                WHEN 3 THEN 'event_timestamp unreadable' ELSE 'line unreadable' END AS reasons,
           count(*) AS n, count(DISTINCT application_id) FILTER (kind IN (0, 2, 3)) AS applications
    FROM ({_BROKEN_SQL}) GROUP BY ALL""")
def _(spark, sf):
    """What a load keeps, and what it keeps aside for which reasons."""
    store = broken_events(spark, sf)
    none = F.array().cast("array<string>").alias("_reject_reasons")
    sides = store.read("workflow_events").select(none, "application_id").unionByName(
        store.quarantined("workflow_events").select("_reject_reasons", "application_id")
    )
    return sides.groupBy(F.col("_reject_reasons").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("application_id").alias("applications")
    )


@query("l01_released_rows", f"""
    SELECT CASE WHEN kind IN (0, 3) THEN 'loaded' ELSE 'aside' END AS side, application_id,
           CASE WHEN kind <> 2 THEN new_status END AS new_status,
           CASE kind WHEN 3 THEN '2024-03-01' WHEN 2 THEN 'soon' ELSE event_timestamp END
               AS event_timestamp,
           CAST(CASE WHEN kind = 3 THEN DATE '2024-02-02' ELSE DATE '2024-02-01' END AS VARCHAR)
               AS _ingestion_date
    FROM (SELECT * REPLACE (CASE WHEN kind <> 1 THEN application_id END AS application_id)
          FROM ({_BROKEN_SQL}) WHERE kind <> 4)""")
def _(spark, sf):
    """Unreadable times are corrected and released twice, rows without a status stay aside."""
    store = broken_events(spark, sf)
    columns = EVENTS_FILE.names
    aside = store.quarantined("workflow_events").where("_corrupt_record is null")
    corrected = aside.where("size(_reject_reasons) = 1 and application_id is not null").select(
        "quarantine_id", *columns[:-1], F.lit("2024-03-01").alias("event_timestamp")
    )
    fixed = written_row(corrected, scratch_path(spark, "corrected"))
    for now in (SECOND, SECOND + timedelta(days=1)):
        store.release("workflow_events", fixed, now)
    seen = ["application_id", "new_status", "event_timestamp", "_ingestion_date"]
    left = store.quarantined("workflow_events").where("_corrupt_record is null")
    return store.read("workflow_events").select(F.lit("loaded").alias("side"), *seen).unionByName(
        left.select(
            F.lit("aside").alias("side"), "application_id",
            F.nullif(F.trim("new_status"), F.lit("")).alias("new_status"), *seen[2:],
        )
    )


_PER_DAY_SQL = """
    SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, count(*) AS n,
           count(DISTINCT application_id) AS applications
    FROM stg_events GROUP BY 1"""


def _per_day(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("application_id").alias("applications")
    )


def _by_year(events: DataFrame) -> DataFrame:
    """Test data spreads few rows over thousands of days, so folders are years here."""
    return events.withColumn("event_year", F.year("event_date"))


@query("l04_event_layout", _PER_DAY_SQL)
def _(spark, sf):
    target = scratch_path(spark, "layout")
    write_events(_by_year(c.staged(spark, sf, "workflow_events")), target, "event_year")
    return _per_day(spark.read.parquet(target))


def write_small_files(events: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Files by year with few rows each, written by the tasks that have the rows."""
    with unsorted_writes(events.sparkSession):
        events.write.option("maxRecordsPerFile", rows_per_file).option("compression", CODEC).partitionBy(
            "event_year"
        ).parquet(path)


@query("l09_compaction", _PER_DAY_SQL)
def _(spark, sf):
    root = scratch_path(spark, "compact")
    write_small_files(_by_year(c.staged(spark, sf, "workflow_events")), f"{root}/small")
    compact_partitions(spark, f"{root}/small", f"{root}/large", "event_year")
    return _per_day(spark.read.parquet(f"{root}/large"))
