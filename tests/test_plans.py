from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hireflow.operators.keyed_table import KeyedTable
from hireflow.operators.skew import hot_keys
from hireflow.plans import analysis, audit, intermediate, marts, metrics, sharing, staging, suite
from hireflow.plans.build import MODELS, Run, Warehouse
from hireflow.plans.run import run_all
from hireflow.session import scratch_path
from hireflow.sources.enrich import to_contract, with_identity
from hireflow.sources.schemas import SOURCES
from tests.conftest import rows
from tests.test_sources import drop  # noqa: F401

NOW = datetime(2024, 2, 1)
D = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]


def raw(spark, source, data):
    """Raw rows from (day number, *file columns)."""
    spec = SOURCES[source]
    schema = "day int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in spec.columns)
    df = spark.createDataFrame(data, schema).withColumns({
        "_ingestion_date": F.date_add(F.lit(D[0]), F.col("day")),
        "_ingestion_ts": F.date_add(F.lit(D[0]), F.col("day")).cast("timestamp_ntz"),
        "_batch_id": F.concat(F.lit(source), F.col("day")),
        "_source_system": F.lit(spec.system),
        "_file_name": F.lit(spec.file_name),
        "_source_file_checksum": F.lit("c"),
    })
    return to_contract(with_identity(df, source), source)


APPS = [(0, "a1", "j1", "c1", "2024-01-10"), (0, "a2", "j1", "c2", "10-Jan-2024"),
        (0, "a3", "j2", "c1", "January 10, 2024"), (0, "a4", "j9", "c3", "2024.01.10")]
EVENTS = [
    (0, "a1", None, "Applied", "2024-01-10"), (0, "a1", "Applied", "Hired", "2024-01-20"),
    (0, "a1", "Hired", "Hired", "2024-01-25"), (0, "a2", None, "Hired", "2024-01-05"),
    (0, "a3", None, " hired ", "2024-01-10T00:00:00"), (0, "zz", None, "Hired", "2024-01-01"),
    (0, "a1", "x", "Screening", "no date"),
]
JOBS = [(0, "j1", " Cook ", None, "2024-01-01", "Open"), (0, "j2", "Chef", "Food", "x", "closed")]
PEOPLE = [(0, "c1", "Ann", "Lee", "A@x.com ", "1", '["b"," a"]'), (0, "c2", "Bo", "Ng", "bad", "2", None)]
SCHOOL = [(0, "c1", "phd", " MIT ", 2010)]


@pytest.fixture(scope="module")
def staged(spark):
    return {
        "stg_jobs": staging.stg_jobs(raw(spark, "jobs", JOBS), NOW),
        "stg_candidates": staging.stg_candidates(raw(spark, "candidates", PEOPLE), NOW),
        "stg_educations": staging.stg_educations(raw(spark, "education", SCHOOL), NOW),
        "stg_applications": staging.stg_applications(raw(spark, "applications", APPS), NOW),
        "stg_workflow_events": staging.stg_workflow_events(
            raw(spark, "workflow_events", EVENTS), NOW),
    }


@pytest.fixture(scope="module")
def enriched(staged):
    return intermediate.int_workflow_events_enriched(
        staged["stg_workflow_events"], staged["stg_applications"])


@pytest.fixture(scope="module")
def facts(staged, enriched):
    return marts.fct_applications(staged["stg_applications"], enriched, NOW)


def test_staging_cleans(staged):
    assert rows(staged["stg_jobs"].select("title", "department", "status", "posted_date")) == [
        ("Chef", "FOOD", "CLOSED", None), ("Cook", None, "OPEN", date(2024, 1, 1))]
    assert rows(staged["stg_candidates"].select("email", "skills_normalized", "skills_count")) == [
        ("a@x.com", "a,b", 2), ("bad", None, 0)]
    assert rows(staged["stg_educations"].select("degree", "institution")) == [("PHD", "MIT")]
    assert {r[0] for r in staged["stg_applications"].select("apply_date").collect()} == {
        date(2024, 1, 10)}


def test_case_makes_another_event_with_the_same_status(spark):
    events = staging.stg_workflow_events(
        raw(spark, "workflow_events", [(0, "a", None, "Applied", "2024-01-01"),
                                       (0, "a", None, "applied", "2024-01-01"),
                                       (1, "a", None, "Applied", "2024-01-01")]), NOW)
    assert rows(events.select("new_status", "_ingestion_date")) == [
        ("APPLIED", D[0]), ("APPLIED", D[1])]


def test_anomalies_and_sequence(enriched):
    got = rows(enriched.select("application_id", "event_sequence", "new_status", "is_anomaly",
                               "apply_date"))
    day = date(2024, 1, 10)
    assert got == sorted([
        ("a1", 1, "APPLIED", False, day), ("a1", 2, "HIRED", False, day),
        ("a1", 3, "HIRED", False, day), ("a1", 4, "SCREENING", False, day),
        ("a2", 1, "HIRED", True, day), ("a3", 1, "HIRED", False, day),
        ("zz", 1, "HIRED", False, None)], key=repr)


def test_hot_application_changes_nothing(spark, staged, enriched):
    events = staged["stg_workflow_events"]
    hot = hot_keys(events, "application_id", 2)
    assert rows(hot.frame) == [("a1",)]
    spread = intermediate.int_workflow_events_enriched(events, staged["stg_applications"], hot)
    assert rows(spread) == rows(enriched)


def test_facts(facts):
    got = rows(facts.select("application_id", "hired_date", "current_status", "is_hired",
                            "time_to_hire_days"))
    assert got == [
        ("a1", datetime(2024, 1, 20), "HIRED", True, 10), ("a2", None, "HIRED", False, None),
        ("a3", datetime(2024, 1, 10), "HIRED", True, 0), ("a4", None, None, False, None)]


def test_status_of_undated_events(spark, staged):
    events = staging.stg_workflow_events(
        raw(spark, "workflow_events", [(0, "a1", None, "Offer", "?"), (0, "a2", None, "Offer", "?"),
                                       (0, "a2", None, "Applied", "2024-01-11")]), NOW)
    inside = intermediate.int_workflow_events_enriched(events, staged["stg_applications"])
    outcomes = marts.application_outcomes(inside).select("application_id", "current_status")
    assert rows(outcomes) == [("a1", "OFFER"), ("a2", "APPLIED")]


def test_time_to_hire_groups_unknown_jobs(spark, facts, staged):
    extra = facts.withColumn("is_hired", F.lit(True)).withColumn("time_to_hire_days", F.lit(4).cast("bigint"))
    got = marts.agg_time_to_hire_by_job_department(extra, staged["stg_jobs"], NOW)
    assert rows(got.select("job_id", "applications_count", "avg_time_to_hire_days")) == sorted(
        [("j1", 2, 4.0), ("j2", 1, 4.0), (None, 1, 4.0)], key=repr)


def test_incremental_aggregate_equals_rebuild(spark, facts, staged):
    jobs = staged["stg_jobs"]
    before = facts
    after = before.withColumn(
        "job_id", F.when(F.col("application_id") == "a3", "j1").otherwise(F.col("job_id"))
    ).withColumn("is_hired", F.col("is_hired") | (F.col("application_id") == "a4"))
    touched = marts.jobs_of_changed_facts(before, after)
    assert rows(touched) == [("j1",), ("j2",), ("j9",)]
    previous = marts.agg_time_to_hire_by_job_department(before, jobs, NOW)
    fresh = marts.refresh_time_to_hire(previous, after, jobs, touched, NOW)
    assert rows(fresh) == rows(marts.agg_time_to_hire_by_job_department(after, jobs, NOW))


def test_candidate_without_education(staged):
    dim = marts.dim_candidate(staged["stg_candidates"], staged["stg_educations"], NOW)
    assert rows(dim.select("candidate_id", "skills", "education")) == [
        ("c1", ["a", "b"], '{"degree":"PHD","institution":"MIT","year":2010}'),
        ("c2", None, '{"degree":null,"institution":null,"year":null}')]


def test_anomaly_audit(staged):
    got = audit.dq_hired_before_applied_anomalies(
        staged["stg_workflow_events"], staged["stg_applications"], NOW)
    assert rows(got.select("application_id", "days_before_apply", "detected_at")) == [("a2", 5, NOW)]


def test_questions(staged):
    apps, jobs = staged["stg_applications"], staged["stg_jobs"]
    assert rows(analysis.open_jobs(jobs)) == [(1,)]
    assert rows(analysis.eager_candidate_count(apps, 1)) == [(1,)]
    assert rows(analysis.eager_candidates(apps, staged["stg_candidates"], 1)) == [
        ("c1", "Ann", "Lee", "a@x.com", 2)]
    assert [tuple(r) for r in analysis.top_departments(apps, jobs).collect()] == [
        (None, 2), ("FOOD", 1)]


def test_sharing(staged):
    people = staged["stg_candidates"]
    assert rows(sharing.candidate_skill(people)) == [("c1", "a"), ("c1", "b")]
    masked = {r["candidate_id"]: r for r in sharing.masked_candidates(people, "s").collect()}
    assert masked["c1"]["first_name"] == "Xxx" and masked["c1"]["email_masked"] == "x@x.xxx"
    assert masked["c1"]["email_token"] != sharing.masked_candidates(people, "t").filter(
        "candidate_id = 'c1'").first()["email_token"]


def test_metrics(spark, staged):
    loads = spark.createDataFrame([("jobs", 8, 2), ("education", 0, 0)],
                                  "source string, rows bigint, rejected bigint")
    found = metrics.load_metrics(loads)
    assert rows(metrics.breaches(found, {"rejected_share": 0.1})) == [
        ("rejected_share", "jobs", 0.2, 0.1)]
    rate = metrics.duplicate_rate(spark.range(4).selectExpr("id % 2 k"), "k", "t")
    assert rows(rate) == [("duplicate_rate", "t", 0.5)]
    age = metrics.freshness_days(staged["stg_jobs"], "jobs", datetime(2024, 1, 2, 12))
    assert rows(age) == [("freshness_days", "jobs", 1.5)]


def test_series_and_alerts(spark):
    series = metrics.MetricSeries(spark, scratch_path(spark, "series"))
    assert series.read().count() == 0
    kind = "metric string, subject string, value double"
    for day, (rows_read, share) in enumerate([(100.0, 0.0), (110.0, 0.0), (30.0, 0.2)]):
        run = spark.createDataFrame([("rows_read", "jobs", rows_read), ("rejected_share", "jobs", share)], kind)
        newest = series.append(run, NOW + timedelta(days=day))
        found = rows(metrics.alerts(series.read(), newest))
        if day < 2:
            assert found == []
    assert newest.count() == 2 and series.read().count() == 6
    assert found == [("above limit", "rejected_share", "jobs", 0.2, 0.05),
                     ("moved", "rejected_share", "jobs", 0.2, 0.0), ("moved", "rows_read", "jobs", 30.0, 105.0)]
    assert rows(metrics.drifts(series.read(), look_back=1).select("value")) == [(0.2,), (30.0,)]


def test_tables_count_what_they_write(spark):
    t = KeyedTable(spark, scratch_path(spark, "counted"), ["k"], buckets=2)
    t.overwrite(spark.createDataFrame([(i, "a") for i in range(10)], "k int, v string"))
    t.upsert(spark.createDataFrame([(0, "a"), (1, "b"), (20, "c")], "k int, v string"))
    assert t.counts(1) == {"rows_total": 11, "rows_arrived": 3, "rows_written": 2, "rows_replaced": 1}
    assert t.counts() == {"rows_total": 11, "rows_arrived": 13, "rows_written": 12, "rows_replaced": 1}
    found = rows(metrics.table_metrics(spark, {"t": t}, {"t": 1}))
    assert ("rows_written", "t", 2.0) in found and len(found) == 4
    t.compact()
    assert t.counts(2) == {"rows_total": 11, "rows_arrived": 0, "rows_written": 0, "rows_replaced": 0}


# -- suite ---------------------------------------------------------------------------------------


def test_suite_counts_and_stores_failures(spark, staged):
    results = suite.summarize(staged)
    bad = {(r["model"], r["check_name"]): (r["failures"], r["status"])
           for r in results.filter("failures > 0").collect()}
    assert bad == {
        ("stg_jobs", "not_null_posted_date"): (1, "fail"),
        ("stg_jobs", "invalid_posted_date"): (1, "fail"),
        ("stg_candidates", "not_null_skills_normalized"): (1, "fail"),
        ("stg_candidates", "email_format"): (1, "fail"),
        ("stg_workflow_events", "not_null_event_timestamp"): (1, "fail"),
        ("stg_workflow_events", "not_null_event_date"): (1, "fail"),
        ("stg_workflow_events", "hired_before_applied"): (1, "warn"),
    }
    for model, name in bad:
        check = next(c for c in suite.checks() if (c.model, c.name) == (model, name))
        assert check.failing(staged).count() == bad[model, name][0]
    with pytest.raises(suite.ChecksFailed, match="stg_jobs.not_null_posted_date: 1"):
        suite.require_passed(results)
    suite.require_passed(results.filter("severity = 'warn'"))
    written = suite.store_failures(staged, results, scratch_path(spark, "failures"))
    assert len(written) == len(bad)
    assert spark.read.parquet(written[0]).count() == 1


def test_volume_checks(spark):
    tables = {"jobs": spark.range(10)}
    got = suite.summarize(tables, suite.volume_checks({"jobs": (1, 5), "candidates": (0, 1)}))
    assert rows(got) == [("jobs", "row_count_between", "error", 1, "fail")]


# -- incremental builds --------------------------------------------------------------------------

THREE_DAYS = {
    "jobs": JOBS + [(1, "j1", "Cook", "Food", "2024-01-01", "Closed"),
                    (2, "j9", "Host", "Bar", "2024-01-03", "Open")],
    "candidates": PEOPLE + [(2, "c3", "Cy", "Oz", "c@z.com", "3", '["x"]')],
    "education": SCHOOL + [(1, "c2", "BS", "ETH", 2011)],
    "applications": APPS + [(1, "a2", "j2", "c2", "2024-01-01"), (2, "a5", "j9", "c3", "2024-01-03")],
    "workflow_events": EVENTS + [
        (1, "a1", None, "Screening", "2024-01-12"), (1, "a4", None, "Hired", "2024-01-30"),
        (1, "a1", None, "Applied", "2024-01-10"), (2, "a5", None, "Offer", "2024-01-04")],
}
LEFT_OUT = {"_updated_at", "_processed_ts", "detected_at"}


def snapshot(warehouse):
    return {name: rows(warehouse.read(name).drop(*LEFT_OUT)) for name in MODELS}


def make(spark, name):
    return Warehouse(spark, scratch_path(spark, name),
                     lambda s: raw(spark, s, THREE_DAYS[s]), buckets=2)


@pytest.fixture(scope="module")
def by_day(spark):
    warehouse = make(spark, "days")
    for day in D:
        warehouse.build(Run(day, NOW))
    return warehouse


@pytest.fixture(scope="module")
def at_once(spark):
    warehouse = make(spark, "once")
    assert warehouse.build(Run(D[2], NOW, full_refresh=True)) == list(MODELS)
    return warehouse


def test_days_add_up_to_a_rebuild(by_day, at_once):
    assert snapshot(by_day) == snapshot(at_once)


def test_big_applications_build_the_same(spark, by_day):
    warehouse = make(spark, "big")
    for day in D:
        warehouse.build(Run(day, NOW, hot_rows=1), ["stg", "int", "fact"])
    for name in ("int_workflow_events_enriched", "fct_applications", "fct_workflow_events"):
        assert rows(warehouse.read(name).drop(*LEFT_OUT)) == rows(by_day.read(name).drop(*LEFT_OUT))


def test_late_event_moves_the_timeline(by_day):
    a1 = by_day.read("int_workflow_events_enriched").filter("application_id = 'a1'")
    assert [r["new_status"] for r in a1.orderBy("event_sequence").collect()] == [
        "APPLIED", "SCREENING", "HIRED", "HIRED", "SCREENING"]


def test_corrected_date_clears_the_anomaly(by_day):
    a2 = by_day.read("fct_applications").filter("application_id = 'a2'").first()
    assert (a2["is_hired"], a2["time_to_hire_days"]) == (True, 4)


def test_running_a_day_again_changes_nothing(by_day):
    before = snapshot(by_day)
    by_day.build(Run(D[2], NOW))
    assert snapshot(by_day) == before


def test_strict_runs_leave_stale_flags(spark):
    warehouse = make(spark, "strict")
    for day in D:
        warehouse.build(Run(day, NOW, strict=True))
    stale = warehouse.read("int_workflow_events_enriched").filter("application_id = 'a2'").first()
    assert stale["is_anomaly"]
    c2 = warehouse.read("dim_candidate").filter("candidate_id = 'c2'").first()
    assert '"degree":null' in c2["education"]
    warehouse.build(Run(D[2], NOW, full_refresh=True, strict=True), ["stg"])
    assert rows(warehouse.read("stg_jobs").select("job_id")) == [("j9",)]


# Applications of one job each; a late day touches one of them.
MANY = 40
LATE = {
    "jobs": [(0, f"j{i}", "Cook", "Food", "2024-01-01", "Open") for i in range(5)],
    "candidates": PEOPLE, "education": SCHOOL,
    "applications": [(0, f"a{i}", f"j{i % 6}", "c1", "2024-01-01") for i in range(MANY)],
    "workflow_events": [(0, f"a{i}", None, "Hired", f"2024-01-{2 + i % 9:02d}") for i in range(0, MANY, 2)]
    + [(1, "a7", None, "Hired", "2024-01-20"), (1, "a8", "x", "Hired", "2024-01-02"),
       (2, "a7", None, "Offer", "2024-01-03")],
}


def late_warehouse(spark, name, buckets=64):
    return Warehouse(spark, scratch_path(spark, name), lambda s: raw(spark, s, LATE[s]), buckets=buckets)


def test_a_day_opens_only_folders_of_applications_it_touches(spark, monkeypatch):
    """Whole rows of events, timelines and applications, from what scans are asked to open."""
    warehouse = late_warehouse(spark, "small")
    warehouse.build(Run(D[0], NOW))
    scans, whole = [], KeyedTable._read_folders

    def seen(self, folders, schema):
        scans.append((self.path.rsplit("/", 1)[1], {(f.version, f.bucket) for f in folders}))
        return whole(self, folders, schema)

    homes = spark.createDataFrame([("a7",), ("a8",)], "application_id string").select(
        F.pmod(F.xxhash64("application_id"), F.lit(64)).alias("b"))
    homes = {r[0] for r in homes.collect()}
    monkeypatch.setattr(KeyedTable, "_read_folders", seen)
    monkeypatch.setattr(KeyedTable, "read", lambda self: pytest.fail(f"{self.path} read whole")
                        if self.path.rsplit("/", 1)[1] in ("stg_workflow_events", "stg_applications",
                                                           "fct_applications") else READ(self))
    warehouse.build(Run(D[1], NOW), ["stg", "int", "dim", "fact", "metric"])
    by_application = {"stg_workflow_events", "stg_applications", "int_workflow_events_enriched",
                      "fct_applications", "fct_workflow_events"}
    opened = {b for name, folders in scans if name in by_application for _, b in folders}
    assert opened == homes
    assert len({f.bucket for f in warehouse.table("fct_applications")._state().live}) > 10
    monkeypatch.undo()
    days = rows(warehouse.read("agg_time_to_hire_by_job_department").drop("_updated_at"))
    full = late_warehouse(spark, "small-full")
    full.raw = lambda s: raw(spark, s, [r for r in LATE[s] if r[0] < 2])
    full.build(Run(D[1], NOW, full_refresh=True))
    assert days == rows(full.read("agg_time_to_hire_by_job_department").drop("_updated_at"))


READ = KeyedTable.read


def test_changes_are_counted_once_whatever_dies(spark, monkeypatch):
    warehouse = late_warehouse(spark, "dies", buckets=2)
    warehouse.build(Run(D[0], NOW))
    for day in D[1:]:
        commit = KeyedTable._commit

        def dies(self, state):
            if self.path.endswith("hire_counts"):
                raise RuntimeError("lost")
            commit(self, state)

        monkeypatch.setattr(KeyedTable, "_commit", dies)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.build(Run(day, NOW))
        monkeypatch.setattr(KeyedTable, "_commit", commit)
        warehouse.build(Run(day, NOW))
        warehouse.build(Run(day, NOW), ["metric"])
        facts = warehouse.read("fct_applications")
        want = marts.hire_counts(facts.withColumn("_change", F.lit(1)))
        assert rows(warehouse.hire_counts.read().filter("n > 0")) == rows(want)
        assert rows(warehouse.read("agg_time_to_hire_by_job_department").drop("_updated_at")) == rows(
            marts.agg_time_to_hire_by_job_department(facts, warehouse.read("dim_job"), NOW).drop(
                "_updated_at"))


def test_hire_counts_follow_rows_that_come_and_go(spark):
    changes = spark.createDataFrame(
        [("j1", True, 3, 1), ("j1", True, 3, 1), ("j1", True, 9, 1), ("j1", True, 9, -1),
         (None, True, None, 1), ("j2", False, 5, 1), ("j2", True, 0, -1)],
        "job_id string, is_hired boolean, time_to_hire_days long, _change int")
    counts = marts.hire_counts(changes)
    assert rows(counts.drop("hire_key")) == sorted(
        [("j1", 3, 2), ("j1", 9, 0), (None, None, 1), ("j2", 0, -1)], key=repr)
    assert rows(marts.hires_of_counts(counts)) == sorted(
        [("j1", 2, 2, 6, 3, 3), (None, 1, 0, None, None, None)], key=repr)


def test_layers(spark, at_once):
    assert at_once.build(Run(D[2], NOW), ["dim"]) == ["dim_job", "dim_candidate"]
    with pytest.raises(ValueError, match="unknown layers"):
        at_once.build(Run(D[2], NOW), ["gold"])


def test_run_from_files(spark, drop, monkeypatch):  # noqa: F811
    root = scratch_path(spark, "run")
    bounds = {name: (1, 2) for name in SOURCES}
    with pytest.raises(suite.ChecksFailed, match="stg_candidates.not_null_email: 1"):
        run_all(spark, str(drop), root, now=NOW, row_bounds=bounds, buckets=2, keep_failures=True)
    failures = f"{root}/check_failures/run_date={NOW.date()}/stg_candidates/not_null_email"
    assert rows(spark.read.parquet(failures).select("candidate_id")) == [("c2",)]
    # Nine days later nothing new has come for three of the sources.
    monkeypatch.setattr(Warehouse, "build", lambda self, run: [])
    with pytest.raises(RuntimeError, match="'applications', 'candidates', 'jobs'"):
        run_all(spark, str(drop), root, now=NOW + timedelta(days=9), buckets=2)
