import gzip
import hashlib
import json
import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter, functions as F, types as T

from hireflow.operators.keyed_table import KeyedTable
from hireflow.operators.profile import source_inventory
from hireflow.session import WRITERS, scratch_path, unsorted_writes
from hireflow.sources import checksums, ingest, readers
from hireflow.sources.ingest import RawStore, load_all_sources
from hireflow.sources.layout import compact_partitions, write_events
from hireflow.sources.quarantine import event_rules, load_rules, tag_rejects, write_split
from hireflow.sources.schemas import EVENTS_FILE, JOBS_FILE, RAW, SOURCES
from hireflow.streaming.events import start_event_ingestion, start_status_updates
from tests.conftest import rows

DAY1, DAY2 = datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 6)

JOBS = "job_id,title,department,posted_date,status\nj1, Cook ,N/A,2024-01-01,Open\n" \
       'j2,"Chef, head",null,"May 5, 2024",\n'
APPLICATIONS = "application_id,job_id,candidate_id,apply_date\na1,j1,c1,2024-01-05\n"
EDUCATION = "candidate_id,degree,institution,year\nc1,BS,MIT,2010\nc2,MS,,\n"
CANDIDATES = [
    {"candidate_id": "c1", "first_name": "Ann", "last_name": "Lee", "email": " A@x.com",
     "phone": "1", "skills": ["sql", " java"]},
    {"candidate_id": "c2", "first_name": "Bob", "last_name": "Ray", "email": None, "phone": None},
]
EVENTS = [
    {"application_id": "a1", "old_status": None, "new_status": "Applied",
     "event_timestamp": "2024-01-05"},
    {"application_id": "a1", "old_status": "Applied", "new_status": "Hired",
     "event_timestamp": "2024-01-09T00:00:00"},
]


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "jobs.csv").write_text(JOBS)
    (tmp_path / "applications.csv").write_text(APPLICATIONS)
    (tmp_path / "education.csv").write_text(EDUCATION)
    (tmp_path / "candidates.json").write_text(json.dumps(CANDIDATES, indent=1))
    (tmp_path / "workflow_events.jsonl").write_text("\n".join(map(json.dumps, EVENTS)) + "\n")
    return tmp_path


@pytest.fixture
def store(spark):
    return RawStore(spark, scratch_path(spark, "raw"))


def counts(store):
    return {name: store.read(name).count() for name in SOURCES}


ALL = {"applications": 1, "education": 2, "candidates": 2, "jobs": 2, "workflow_events": 2}


def test_csv_nulls_and_quotes(spark, drop):
    df = readers.csv_scan(spark, str(drop / "jobs.csv"), JOBS_FILE)
    assert rows(df.select(*JOBS_FILE.names)) == [
        ("j1", " Cook ", None, "2024-01-01", "Open"),
        ("j2", "Chef, head", None, "May 5, 2024", None),
    ]


def test_csv_takes_columns_by_name(spark, tmp_path):
    (tmp_path / "j.csv").write_text("status,extra,job_id,title,department,posted_date\nOpen,x,j1,t,d,p\n")
    df = readers.csv_scan(spark, str(tmp_path / "j.csv"), JOBS_FILE)
    assert rows(df.select(*JOBS_FILE.names)) == [("j1", "t", "d", "p", "Open")]
    (tmp_path / "k.csv").write_text("job_id,title\nj1,t\n")
    with pytest.raises(ValueError, match="lacks columns"):
        readers.csv_scan(spark, str(tmp_path / "k.csv"), JOBS_FILE)


def test_source_path(monkeypatch):
    assert readers.source_path("a.csv", "/x/") == "/x/a.csv"
    monkeypatch.setenv(readers.DATA_DIR_VARIABLE, "/y")
    assert readers.source_path("a.csv") == "/y/a.csv"
    monkeypatch.delenv(readers.DATA_DIR_VARIABLE)
    assert readers.source_path("a.csv") == "data/a.csv"


def test_checksum_sees_every_change_and_no_split_size(spark, tmp_path):
    def digest(text):
        path = tmp_path / hashlib.md5(text.encode()).hexdigest()
        path.write_bytes(text.encode())
        return checksums.drop_checksum(spark, str(path))

    long = "".join(f"line {i} of a file\n" for i in range(2000))
    lines = long.splitlines(True)
    swapped = "".join([*lines[:500], lines[1500], *lines[501:1500], lines[500], *lines[1501:]])
    texts = ["", "a\nb\n", "b\na\n", "a\r\nb\r\n", "a\nb", "a\nb\nb\nb\n", "a\nb\nc\nc\n", "a\n",
             "a\na\nb\n", long, swapped]
    found = [digest(t) for t in texts]
    assert len(set(found)) == len(texts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("300", "7000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert [digest(t) for t in texts] == found
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_checksum_sees_rearranged_lines_of_few_kinds(spark, tmp_path):
    found = set()
    for name, kinds in {"abba": "ABBA", "baab": "BAAB", "abab": "ABAB", "baba": "BABA"}.items():
        path = tmp_path / name
        path.write_text("".join(f"{k}\n" for k in kinds))
        found.add(checksums.drop_checksum(spark, str(path)))
    assert len(found) == 4


def test_checksum_of_parts_in_order_of_name(spark, tmp_path):
    def drop_of(name, *texts):
        (tmp_path / name).mkdir()
        for i, text in enumerate(texts):
            (tmp_path / name / f"part-{i:05d}-{name}.csv").write_text(text)
        return checksums.drop_checksum(spark, str(tmp_path / name))

    assert drop_of("one", "a\n", "b\n") == drop_of("same", "a\n", "b\n")
    assert len({drop_of("x", "a\n", "b\n"), drop_of("y", "b\n", "a\n"), drop_of("z", "a\nb\n")}) == 3


def test_compressed_parts_may_be_empty(spark, tmp_path):
    for name, text in (("a", b""), ("b", b"x\ny\n")):
        (tmp_path / f"{name}.txt.gz").write_bytes(gzip.compress(text))
    assert checksums.file_checksums(spark, str(tmp_path)).filter("checksum is not null").count() == 2


def test_only_the_sources_asked_for_are_written(spark, sf):
    from hireflow.verification import canonical

    root = canonical.source_files(spark, f"{sf}/", "jobs")
    assert [path.name for path in Path(root).iterdir()] == ["jobs.csv"]
    assert {path.suffix for path in Path(root).glob("jobs.csv/part-*")} == {".gz"}
    canonical.source_files(spark, f"{sf}/", "education")
    assert sorted(path.name for path in Path(root).iterdir()) == ["education.csv", "jobs.csv"]


def test_a_load_does_not_sort_its_rows_by_folder(spark, tmp_path, monkeypatch):
    """A sort holds or spills all rows of the task, one of which reads a whole compressed file."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, write = spark.conf.get(name), DataFrameWriter.parquet

    def spied(self, path, *args, **kwargs):
        if "jobs" in path:
            seen.append(int(spark.conf.get(name)))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    (tmp_path / "jobs.csv").write_text(JOBS)
    store = RawStore(spark, str(tmp_path / "raw"), load_rules())
    assert store.load(SOURCES["jobs"], str(tmp_path / "jobs.csv"), DAY1)["rows"] == 2
    assert seen == [WRITERS] and spark.conf.get(name) == before
    with pytest.raises(RuntimeError), unsorted_writes(spark), unsorted_writes(spark):
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_a_write_deletes_what_it_shuffled(spark, tmp_path):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for d in place.localDirsString() for name in map(str, Path(d).glob("*/shuffle_*"))}

    before = shuffled()
    rows = spark.range(0, 1000, 1, 4).repartition(3, "id")
    with unsorted_writes(spark):
        rows.write.parquet(str(tmp_path / "kept"))
    assert shuffled() <= before and spark.read.parquet(str(tmp_path / "kept")).count() == 1000


def test_a_build_deletes_what_it_shuffled(spark, tmp_path, monkeypatch):
    from hireflow.plans.build import Run, Warehouse

    spark.sparkContext._jvm.System.gc()
    place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for d in place.localDirsString() for name in map(str, Path(d).glob("*/shuffle_*"))}

    before, counted = shuffled(), []
    keys = spark.range(0, 1000, 1, 4).withColumn("k", F.col("id") % 7)
    monkeypatch.setattr(
        Warehouse, "_update", lambda self, name, run: counted.append(keys.groupBy("k").count().count())
    )
    Warehouse(spark, str(tmp_path), lambda s: None).build(Run(DAY1.date(), DAY1), ["stg"])
    assert counted == [7] * 5 and shuffled() <= before


def test_an_array_with_a_brace_is_not_scanned_to_see_that_it_is_not_empty(spark, tmp_path):
    spec = SOURCES["candidates"]
    path = tmp_path / spec.file_name

    class Scanned:
        def isEmpty(self):
            raise RuntimeError("scanned")

    path.write_text('[{"candidate_id": "c1"}]')
    assert not readers.is_empty(spark, spec, str(path), Scanned())
    for text in ("", " \n", "[]", "[ ]\n"):
        path.write_text(text)
        assert readers.is_empty(spark, spec, str(path), readers.read_source(spark, spec, str(path)))
    path.write_text("[ } ]")  # no object, but a row that cannot be read
    assert not readers.is_empty(spark, spec, str(path), readers.read_source(spark, spec, str(path)))


def test_small_files_are_written_by_the_tasks_that_have_the_rows(spark, tmp_path):
    from hireflow.verification.source_queries import write_small_files

    events = spark.range(0, 1000, 1, 6).selectExpr("cast(id as string) event_id", "2020 + id % 2 event_year")
    write_small_files(events, str(tmp_path / "small"), rows_per_file=20)
    assert len(list((tmp_path / "small").glob("event_year=*/*.parquet"))) >= 50
    assert len({path.name[:10] for path in (tmp_path / "small").glob("event_year=*/*.parquet")}) == 6
    compact_partitions(spark, str(tmp_path / "small"), str(tmp_path / "large"), "event_year")
    assert len(list((tmp_path / "large").glob("event_year=*/*.parquet"))) == 2
    assert spark.read.parquet(str(tmp_path / "large")).distinct().count() == 1000


@pytest.mark.parametrize("folder", ["a b", "50%", "a%20b", "x#y", "été ß", "a+b=c", "q?'&"])
def test_checksum_in_folders_with_odd_names(spark, tmp_path, folder):
    (tmp_path / folder).mkdir()
    file = tmp_path / folder / "jobs.csv"
    found = []
    for text in ("111\n", "222\n", "111\n"):
        file.write_text(text)
        path = str(file) if "?" not in folder else str(tmp_path)
        found.append(checksums.drop_checksum(spark, path))
    assert found[0] == found[2] != found[1]


def test_checksum_of_one_line_falls_into_small_records(spark, tmp_path):
    """An array in one line is read by many tasks and does not depend on where they begin."""
    rows_ = [{"id": i, "text": 'a, "b" }{', "tags": ["x", "y"]} for i in range(3000)]
    path = tmp_path / "people.json"
    path.write_text(json.dumps(rows_))
    records = spark.read.option("lineSep", ",").text(str(path))
    assert records.agg(F.max(F.length("value"))).first()[0] < 60
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = set()
    for size in ("900", "20000", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found.add(checksums.drop_checksum(spark, str(path), ","))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 1
    path.write_text(json.dumps([*rows_[:10], rows_[11], rows_[10], *rows_[12:]]))
    assert checksums.drop_checksum(spark, str(path), ",") not in found


def test_a_file_whose_records_are_not_found_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\n")

    class Nothing(type(spark.read)):
        def text(self, *args, **kw):
            return super().text(*args, **kw).filter("false")

    class Session:
        read = property(lambda self: Nothing(spark))

    with pytest.raises(Exception, match="no records read"):
        checksums.drop_checksum(Session(), str(tmp_path / "a.csv"))


def test_a_changed_file_of_equal_length_is_loaded(store, tmp_path):
    folder = tmp_path / "day 1"
    folder.mkdir()
    spec, path = SOURCES["applications"], folder / "applications.csv"
    line = "application_id,job_id,candidate_id,apply_date\n"
    for day, key in ((DAY1, "111"), (DAY2, "222")):
        path.write_text(f"{line}{key},j,c,2024-01-01\n")
        assert store.load(spec, str(path), day)["outcome"] == "loaded"
    assert rows(store.read("applications").select("application_id")) == [("111",), ("222",)]
    assert store.load(spec, str(path), DAY2)["outcome"] == "skipped"


def test_load_fills_contracts(store, drop):
    load_all_sources(store, str(drop), DAY1)
    assert counts(store) == ALL
    for name in SOURCES:
        assert store.read(name).schema == RAW[name]
    event = store.read("workflow_events").filter("new_status = 'Hired'").first()
    key = "a1||Applied||Hired||2024-01-09T00:00:00"
    assert event["_event_id"] == event["_record_hash"] == hashlib.md5(key.encode()).hexdigest()
    assert event["_event_date"] == date(2024, 1, 9)
    assert (event["_ingestion_ts"], event["_ingestion_date"]) == (DAY1, DAY1.date())
    assert event["_file_name"] == "workflow_events.jsonl"
    checksum = checksums.drop_checksum(store.spark, str(drop / "workflow_events.jsonl"))
    assert event["_source_file_checksum"] == checksum
    batch = f"workflow_events|workflow_events.jsonl|{checksum}"
    assert event["_batch_id"] == hashlib.md5(batch.encode()).hexdigest()


def test_missing_contact_and_skills_stay_missing(store, drop):
    load_all_sources(store, str(drop), DAY1)
    people = {r["candidate_id"]: r for r in store.read("candidates").collect()}
    assert people["c1"]["skills"] == "sql, java"
    assert people["c1"]["email_hash"] == hashlib.md5(b"a@x.com").hexdigest()
    assert [people["c2"][c] for c in ("email_hash", "phone_hash", "skills")] == [None] * 3


def test_order_of_skills_does_not_change_the_record_hash(store, drop):
    load_all_sources(store, str(drop), DAY1)
    CHANGED = [dict(CANDIDATES[0], skills=["java", "sql "])]
    (drop / "candidates.json").write_text(json.dumps(CHANGED))
    load_all_sources(store, str(drop), DAY2)
    c1 = store.read("candidates").filter("candidate_id = 'c1'")
    assert c1.count() == 2 and c1.select("_record_hash").distinct().count() == 1


def test_replay_adds_nothing(store, drop):
    load_all_sources(store, str(drop), DAY1)
    second = load_all_sources(store, str(drop), DAY2)
    assert {x["source"]: x["outcome"] for x in second} == {
        "applications": "skipped", "candidates": "skipped", "jobs": "skipped",
        "education": "loaded", "workflow_events": "loaded"}
    assert counts(store) == ALL
    dates = {n: {r[0] for r in store.read(n).select("_ingestion_date").collect()} for n in SOURCES}
    assert dates["jobs"] == {DAY1.date()} and dates["education"] == {DAY2.date()}
    states = rows(store.ledger.batches().select("source_name", "status", "rows_loaded"))
    assert states == sorted((n, "SUCCEEDED", k) for n, k in ALL.items())


def test_a_new_file_is_a_new_batch(store, drop):
    load_all_sources(store, str(drop), DAY1)
    (drop / "jobs.csv").write_text(JOBS + "j3,t,d,2024-01-01,Open\n")
    load_all_sources(store, str(drop), DAY2)
    assert store.read("jobs").count() == 5


def test_crash_between_data_and_ledger(store, drop, monkeypatch):
    def lost(*_):
        raise RuntimeError("driver lost")

    spec, path = SOURCES["jobs"], str(drop / "jobs.csv")
    with monkeypatch.context() as m:
        m.setattr(type(store.ledger), "succeed", lost)
        with pytest.raises(RuntimeError):
            store.load(spec, path, DAY1)
    assert store.read("jobs").count() == 0
    failed = store.ledger.batches().first()
    assert (failed["status"], failed["error_message"]) == ("FAILED", "driver lost")
    assert store.load(spec, path, DAY1)["outcome"] == "loaded"
    assert store.read("jobs").count() == 2
    assert rows(store.ledger.batches().select("status", "error_message")) == [("SUCCEEDED", None)]


@pytest.mark.parametrize("again", [DAY1, DAY2])
def test_a_failed_replay_keeps_what_was_loaded(store, drop, monkeypatch, again):
    spec, path = SOURCES["education"], str(drop / "education.csv")
    store.load(spec, path, DAY1)
    good = rows(store.read("education"))

    def lost(*_):
        raise RuntimeError("x" * 9000)

    for place in ("_write", "succeed"):
        with monkeypatch.context() as m:
            m.setattr(store if place == "_write" else type(store.ledger), place, lost)
            with pytest.raises(RuntimeError):
                store.load(spec, path, again)
        assert rows(store.read("education")) == good
    failed = store.ledger.batches().first()
    assert (failed["status"], failed["error_message"]) == ("FAILED", "x" * 9000)
    store.load(spec, path, again)
    assert store.read("education").count() == len(good)


def test_empty_source_leaves_no_batch(store, drop):
    (drop / "applications.csv").write_text(APPLICATIONS.splitlines()[0] + "\n")
    assert store.load(SOURCES["applications"], str(drop / "applications.csv"))["outcome"] == "empty"
    assert store.ledger.batches().isEmpty() and store.read("applications").isEmpty()


def test_new_folder_is_an_empty_store(spark):
    store = RawStore(spark, scratch_path(spark, "raw"))
    assert counts(store) == dict.fromkeys(SOURCES, 0)
    inventory = source_inventory({n: store.read(n) for n in SOURCES})
    assert {r["columns"] for r in inventory.collect()} == {11, 12, 13, 15}


def test_broken_lines_are_quarantined(store, drop):
    path = drop / "workflow_events.jsonl"
    path.write_text(path.read_text() + '{"application_id": "a2", "new_st\n')
    loaded = store.load(SOURCES["workflow_events"], str(path), DAY1)
    assert (loaded["rows"], loaded["rejected"]) == (2, 1)
    assert store.read("workflow_events").count() == 2
    assert store.quarantined("workflow_events").first()["_corrupt_record"] == (
        '{"application_id": "a2", "new_st')


def test_rejects_name_every_broken_rule(spark):
    df = spark.createDataFrame([("a", "X", DAY1), (None, None, DAY1), ("b", "Y", None)],
                               "application_id string, new_status string, event_timestamp timestamp_ntz")
    tagged = tag_rejects(df, event_rules())
    assert rows(tagged.select("_reject_reasons")) == sorted(
        [([],), (["application_id missing", "new_status missing"],),
         (["event_timestamp unreadable"],)], key=repr)
    path = scratch_path(spark, "split")
    write_split(tagged, path)
    assert spark.read.parquet(path).filter("_quarantined = 'true'").count() == 2


def stream_into(store, path, state, **kw):
    start_event_ingestion(store, str(path), str(state), **kw).awaitTermination()


def test_stream_loads_each_event_once(store, tmp_path):
    arrivals, state = tmp_path / "in", tmp_path / "state"
    arrivals.mkdir()
    lines = [json.dumps(e) for e in EVENTS]
    (arrivals / "1.jsonl").write_text("\n".join([*lines, lines[0], "{broken"]) + "\n")
    stream_into(store, arrivals, state)
    assert store.read("workflow_events").schema == RAW["workflow_events"]
    assert store.read("workflow_events").count() == 2
    old = {"application_id": "a0", "old_status": None, "new_status": "Applied",
           "event_timestamp": "1999-01-01"}
    (arrivals / "2.jsonl").write_text("\n".join([lines[1], json.dumps(old)]) + "\n")
    stream_into(store, arrivals, state)
    got = store.read("workflow_events")
    assert rows(got.select("application_id", "event_timestamp")) == [
        ("a0", "1999-01-01"), ("a1", "2024-01-05"), ("a1", "2024-01-09T00:00:00")]
    assert rows(store.quarantined("workflow_events").select("_corrupt_record", "_reject_reasons")) == [
        ("{broken", ["line unreadable"])]
    batches = store.ledger.batches().filter("rows_loaded > 0")
    assert {r.status for r in batches.collect()} == {"SUCCEEDED"} and batches.count() == 2


@pytest.mark.parametrize("dies", ["after", "before"])
def test_a_micro_batch_that_runs_again_loads_its_events_once(store, tmp_path, monkeypatch, dies):
    """The stream dies after a batch counts, or while its rows are being written."""
    arrivals, state, load = tmp_path / "in", tmp_path / "state", RawStore.load_rows
    arrivals.mkdir()
    for i in range(3):
        events = [dict(EVENTS[0], application_id=f"a{i}{k}") for k in range(4)]
        (arrivals / f"{i}.jsonl").write_text("\n".join(map(json.dumps, events)) + "\n")
    seen = []

    def fails_once(self, spec, scanned, origin, checksum, **kw):
        seen.append(checksum)
        if checksum == "1" and seen.count("1") == 1:
            if dies == "before":
                monkeypatch.setattr(RawStore, "_write", lambda *a: 1 / 0)
            load(self, spec, scanned, origin, checksum, **kw)
            raise RuntimeError("lost")
        return load(self, spec, scanned, origin, checksum, **kw)

    write = RawStore._write
    monkeypatch.setattr(RawStore, "load_rows", fails_once)
    with pytest.raises(Exception):
        stream_into(store, arrivals, state, files_per_trigger=1)
    monkeypatch.setattr(RawStore, "_write", write)
    stream_into(store, arrivals, state, files_per_trigger=1)
    assert seen.count("1") == 2
    found = [r[0] for r in store.read("workflow_events").select("application_id").collect()]
    assert sorted(found) == sorted(f"a{i}{k}" for i in range(3) for k in range(4))
    # a stream that starts anew numbers its batches again, but is another stream
    stream_into(store, arrivals, tmp_path / "other", files_per_trigger=1)
    assert store.read("workflow_events").count() == 24
    assert store.read("workflow_events").select("_event_id").distinct().count() == 12


def test_a_compressed_file_of_a_stream_is_worked_on_by_many_tasks(spark, tmp_path):
    """One task can read it; what follows the reading, and the state, gets its lines from many."""
    import gzip

    from hireflow.streaming.events import dealt, read_event_stream

    arrivals, tasks = tmp_path / "in", []
    arrivals.mkdir()
    with gzip.open(arrivals / "1.jsonl.gz", "wt") as f:
        for i in range(400):
            f.write(json.dumps(dict(EVENTS[0], application_id=f"a{i}")) + "\n")

    def seen(batch, number):
        tasks.extend(r["t"] for r in batch.groupBy(F.spark_partition_id().alias("t")).count().collect())
        tasks.append(batch.count())

    dealt(read_event_stream(spark, str(arrivals))).writeStream.foreachBatch(seen).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert tasks[-1] == 400 and len(tasks[:-1]) == spark.sparkContext.defaultParallelism


def test_newest_status_follows_the_stream(spark, tmp_path, monkeypatch):
    arrivals, state = tmp_path / "in", str(tmp_path / "state")
    arrivals.mkdir()
    table = KeyedTable(spark, scratch_path(spark, "statuses"), ["application_id"], buckets=2)

    def arrive(name, *events):
        lines = [json.dumps({"application_id": a, "old_status": None, "new_status": s, "event_timestamp": t})
                 for a, s, t in events]
        (arrivals / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
        start_status_updates(table, str(arrivals), state).awaitTermination()
        return {r.application_id: r.current_status for r in table.read().collect()}

    assert arrive("1", ("a", "Applied", "2024-01-01"), ("b", " offer ", "soon")) == {"a": "APPLIED", "b": "OFFER"}
    assert arrive("2", ("a", "Late", "2023-01-01"), ("c", "Hired", "2024-01-03")) == {
        "a": "APPLIED", "b": "OFFER", "c": "HIRED"}
    version = table.version()
    upsert = KeyedTable.upsert

    def dies(self, *args, **kw):
        upsert(self, *args, **kw)
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "upsert", dies)
    with pytest.raises(Exception):
        arrive("3", ("b", "Hired", "2024-02-01"))
    monkeypatch.setattr(KeyedTable, "upsert", lambda *a, **kw: pytest.fail("applied twice"))
    start_status_updates(table, str(arrivals), state).awaitTermination()
    assert table.version() == version + 1
    assert {r.application_id: r.current_status for r in table.read().collect()} == {
        "a": "APPLIED", "b": "HIRED", "c": "HIRED"}


def test_rules_keep_rows_aside_and_release_them_once(spark, drop):
    store = RawStore(spark, scratch_path(spark, "raw"), load_rules())
    path = drop / "workflow_events.jsonl"
    bad = [{"application_id": " ", "new_status": "Hired", "event_timestamp": "2024-01-01"},
           {"application_id": "a9", "new_status": None, "event_timestamp": "never"},
           {"application_id": "a8", "new_status": "Offer", "event_timestamp": "never"}]
    path.write_text("\n".join([*map(json.dumps, [*EVENTS, *bad]), "{broken"]) + "\n")
    done = store.load(SOURCES["workflow_events"], str(path), DAY1)
    assert (done["rows"], done["rejected"]) == (2, 4)
    aside = store.quarantined("workflow_events")
    assert rows(aside.select("_reject_reasons")) == sorted([
        (["application_id missing"],), (["new_status missing", "event_timestamp unreadable"],),
        (["event_timestamp unreadable"],), (["line unreadable"],)], key=repr)
    fixed = aside.filter("application_id in ('a8', 'a9')").withColumns(
        {"event_timestamp": F.lit("2024-01-03"), "old_status": F.lit(None).cast("string")})
    for _ in range(2):
        done = store.release("workflow_events", fixed, DAY2)
    assert done["outcome"] == "skipped"
    assert rows(store.read("workflow_events").select("application_id", "_ingestion_date")) == [
        ("a1", DAY1.date()), ("a1", DAY1.date()), ("a8", DAY2.date())]
    # a9 still lacks its status: it left the old batch and is aside in the new one
    left = rows(store.quarantined("workflow_events").select("application_id", "_ingestion_date"))
    assert left == sorted([(" ", DAY1.date()), ("a9", DAY2.date()), (None, DAY1.date())], key=repr)


def test_a_release_that_dies_leaves_quarantine_as_it_was(spark, drop):
    store = RawStore(spark, scratch_path(spark, "raw"), load_rules())
    (drop / "education.csv").write_text("candidate_id,degree,institution,year\n,BS,MIT,2010\n")
    store.load(SOURCES["education"], str(drop / "education.csv"), DAY1)
    aside = store.quarantined("education")
    fixed = spark.createDataFrame(
        [(aside.first()["quarantine_id"], "c1", "BS", "MIT", 2010)],
        "quarantine_id string, candidate_id string, degree string, institution string, year int")
    store.ledger.succeed, succeed = (lambda *a: 1 / 0), store.ledger.succeed
    with pytest.raises(ZeroDivisionError):
        store.release("education", fixed, DAY2)
    assert store.quarantined("education").count() == 1 and store.read("education").count() == 0
    store.ledger.succeed = succeed
    assert store.release("education", fixed, DAY2)["rows"] == 1
    assert store.quarantined("education").count() == 0 and store.read("education").count() == 1


def test_layout_and_compaction_keep_all_rows(spark, tmp_path):
    events = spark.range(1000).selectExpr(
        "date_add(date'2024-01-01', cast(id % 3 as int)) event_date",
        "cast(case when id % 3 = 0 then 7 else id end as string) application_id",
        "timestamp_ntz'2024-01-01' event_timestamp", "cast(id as string) event_id")
    path = str(tmp_path / "events")
    write_events(events, path, rows_per_file=100)
    assert rows(spark.read.parquet(path).select("event_id")) == rows(events.select("event_id"))
    compact_partitions(spark, path, str(tmp_path / "large"), "event_date")
    large = spark.read.parquet(str(tmp_path / "large"))
    assert rows(large.select("event_id")) == rows(events.select("event_id"))
    assert len(large.inputFiles()) <= len(spark.read.parquet(path).inputFiles())


BITS = ["a", "}", "{", '"', "\\", "[", "]", ",", "é", "\n", "}}", '\\"', '":{', "日"]


@pytest.mark.parametrize("size", ["200", "1000", "134217728"])
def test_one_array_file_is_read_by_many_tasks(spark, tmp_path, size):
    """Braces, quotes and backslashes in strings, nested objects and lists, split anywhere."""
    pick = random.Random(len(size))
    kind = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "list", "inner")])

    def text():
        return "".join(pick.choice(BITS) for _ in range(pick.randint(0, 8)))

    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "150"}
    before = {k: spark.conf.get(k) for k in settings}
    for indent in (None, 1):
        data = [{"id": str(i), "text": text(), "list": [text()],
                 "inner": {"x": {"y": text()}, "z": [{}]} if i % 3 else None} for i in range(150)]
        path = tmp_path / f"people-{indent}.json"
        path.write_text(json.dumps(data, indent=indent, ensure_ascii=bool(indent)))
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            got = readers.json_array_scan(spark, str(path), kind).collect()
            tasks = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
        assert tasks > 8 or size != "200"
        assert {r["_file_name"] for r in got} == {path.name} and not any(r["_corrupt_record"] for r in got)
        found = [(r.id, r.text, json.loads(r["list"]), json.loads(r.inner) if r.inner else None) for r in got]
        assert sorted(found, key=repr) == sorted(((x["id"], x["text"], x["list"], x["inner"]) for x in data), key=repr)


@pytest.mark.parametrize("text, good, bad", [
    ("", [], []), (" [ ] \n", [], []), ('{"id":"1"}', ["1"], []), ('[{"id":"1"},\n{"id":"2"}]\n', ["1", "2"], []),
    ('[{"id":"1"},{"id":', ["1"], ['{"id":']), ('[{"id":"1"} junk {"id":"2"}]', ["1"], [' junk {"id":"2"}']),
    ("not json", [], ["not json"]), ('[{"id":"1"}]x', ["1"], ["]x"]), ('[{"id" "1"},{"id":"2"}]', ["2"], ['{"id" "1"}']),
    ('{"id":"1","o":{"a":1}}\n{"id":"2"}\n', ["1", "2"], []),
])
def test_arrays_that_are_broken_keep_their_text(spark, tmp_path, text, good, bad):
    (tmp_path / "f.json").write_text(text)
    kind = T.StructType([T.StructField("id", T.StringType())])
    found = readers.json_array_scan(spark, str(tmp_path / "f.json"), kind).collect()
    assert sorted(r.id for r in found if r["_corrupt_record"] is None) == good
    assert [r["_corrupt_record"] for r in found if r["_corrupt_record"] is not None] == bad


def test_json_lines_keep_texts(spark, drop):
    df = readers.jsonl_scan(spark, str(drop / "workflow_events.jsonl"), EVENTS_FILE)
    assert df.filter(F.col("event_timestamp") == "2024-01-09T00:00:00").count() == 1


def test_now_is_utc_without_zone():
    assert ingest.utc_now().tzinfo is None
