"""Persisted datasets: which layer and key each has, and how a run updates it."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from threading import Lock
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hireflow.operators.impacted import distinct_keys, history_of, ingested_on
from hireflow.operators.keyed_table import Folder, KeyedTable
from hireflow.operators.skew import HOT_ROWS, HotKeys, hot_keys
from hireflow.plans import audit, intermediate, marts, staging
from hireflow.session import deleted_shuffles

RUN_STAMPS = ("_processed_ts", "_updated_at")

RECEIVED = "_ingestion_ts"

LAYERS = ["stg", "int", "dim", "fact", "metric", "dq"]


@dataclass(frozen=True)
class Run:
    """What a build works on.

    A run takes the rows received on ``run_date``. With ``full_refresh`` it rebuilds from all raw
    rows. ``strict`` follows two narrower rules instead: a full refresh still reads only the run
    date, and changes of applications or education alone do not reach datasets that are driven by
    events or candidates. It also stamps every row of a run anew, which rewrites their buckets, and
    a run for an older day puts its rows over newer ones.
    """

    run_date: date
    now: datetime
    full_refresh: bool = False
    strict: bool = False
    hot_rows: int = HOT_ROWS


@dataclass(frozen=True)
class Touched:
    """Keys that a run's day touches, written, and their ranges by bucket."""

    key: str
    keys: DataFrame
    ranges: list[Folder]


class Warehouse:
    """Tables below one folder. ``raw`` gives the raw tables by name."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        raw: Callable[[str], DataFrame],
        buckets: int = 64,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw = raw
        self.buckets = buckets
        self._tables: dict[str, KeyedTable] = {}
        self._hot: dict[tuple, HotKeys | None] = {}
        self._touched: dict[tuple, Touched] = {}
        self._near: dict[tuple, DataFrame] = {}
        self._lock = Lock()

    def table(self, name: str) -> KeyedTable:
        if name not in self._tables:
            model = MODELS[name]
            self._tables[name] = KeyedTable(
                self.spark,
                f"{self.root}/{model.layer}/{name}",
                [model.key],
                [model.bucket_by or model.key],
                self.buckets,
            )
        return self._tables[name]

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    @property
    def hire_counts(self) -> KeyedTable:
        """Hires by job and days to hire, kept up to date from changes of the facts."""
        if "hire_counts" not in self._tables:
            path = f"{self.root}/metric/hire_counts"
            self._tables["hire_counts"] = KeyedTable(
                self.spark, path, ["hire_key"], buckets=self.buckets
            )
        return self._tables["hire_counts"]

    def touched(self, sources: tuple[str, ...], key: str, run: Run) -> Touched:
        """Keys in what some sources received on the run's day, from that day's raw rows alone.

        Written once per run, so that who joins them reads a small table.
        """
        asked = (sources, key, run)
        with self._lock:
            if asked not in self._touched:
                days = [ingested_on(self.raw(source), run.run_date) for source in sources]
                self._touched[asked] = self._written_keys(distinct_keys(key, *days), key, run)
            return self._touched[asked]

    def _written_keys(self, keys: DataFrame, key: str, run: Run) -> Touched:
        path = f"{self.root}/touched/run_date={run.run_date}/{key}-{uuid.uuid4().hex}"
        keys.write.parquet(path)
        keys = self.spark.read.schema(keys.schema).parquet(path)
        alike = KeyedTable(self.spark, path, [key], buckets=self.buckets)
        return Touched(key, keys, alike.ranges_of(keys))

    def history(self, name: str, touched: Touched, hot: HotKeys | None = None) -> DataFrame:
        """All rows of the touched keys in a table, from folders that hold any of them."""
        return history_of(self.rows_near(name, touched), touched.keys, touched.key, hot)

    def rows_near(self, name: str, touched: Touched) -> DataFrame:
        """All rows of a table's folders that hold any touched key, looked up once per state of the table."""
        table = self.table(name)
        asked = (name, table.version(), id(touched))
        if asked not in self._near:
            self._near[asked] = table.rows_of(touched.keys, touched.key, touched.ranges)
        return self._near[asked]

    def hot_applications(self, run: Run, touched: Touched | None = None) -> HotKeys | None:
        """Applications with very many events, looked up once per state of the events.

        With ``touched`` only those are counted.
        """
        table = self.table("stg_workflow_events")
        with self._lock:
            state = (table.version(), run.hot_rows, touched and id(touched))
            if state not in self._hot:
                near = table.read() if touched is None else self.rows_near("stg_workflow_events", touched)
                hot = hot_keys(near, "application_id", run.hot_rows)
                if hot is not None and touched is not None:
                    rows = self.history("stg_workflow_events", touched)
                    hot = hot_keys(rows, "application_id", run.hot_rows)
                self._hot[state] = hot
            return self._hot[state]

    def build(
        self, run: Run, layers: list[str] | None = None, concurrent: int = 4
    ) -> list[str]:
        """Update the datasets of the given layers, in layer order.

        Datasets of one layer do not read each other, so their Spark jobs may overlap. Of each table the
        state before the build stays readable until the next; older ones are deleted.
        """
        wanted = LAYERS if layers is None else layers
        unknown = set(wanted) - set(LAYERS)
        if unknown:
            raise ValueError(f"unknown layers {sorted(unknown)}")
        built = []
        self._touched, self._hot, self._near = {}, {}, {}
        with deleted_shuffles(self.spark), ThreadPoolExecutor(concurrent) as pool:
            for layer in LAYERS:
                if layer in wanted:
                    names = [name for name, model in MODELS.items() if model.layer == layer]
                    list(pool.map(lambda name: self._update(name, run), names))
                    built += names
        return built

    def _update(self, name: str, run: Run) -> None:
        model, table = MODELS[name], self.table(name)
        first = run.full_refresh or not model.incremental or not table.exists()
        rows = model.rows(self, run, first)
        if first:
            table.overwrite(rows)
        else:
            # A row whose content stays the same keeps the time it was last updated, and a run for
            # an older day does not replace rows that were received later.
            received = RECEIVED if model.layer == "stg" and not run.strict else None
            table.upsert(rows, () if run.strict else RUN_STAMPS, received)
        # the counts of hires take the facts' changes since the version they stand for
        counted = self.hire_counts.note().get("facts") if name == "fct_applications" else None
        table.clear(counted)


@dataclass(frozen=True)
class Model:
    layer: str
    key: str
    rows: Callable[[Warehouse, Run, bool], DataFrame]  # warehouse, run, everything?
    incremental: bool = True
    bucket_by: str | None = None


def _staging(source: str, transform: Callable) -> Callable[[Warehouse, Run, bool], DataFrame]:
    def rows(w: Warehouse, run: Run, everything: bool) -> DataFrame:
        raw = w.raw(source)
        if not (run.full_refresh and not run.strict):
            raw = ingested_on(raw, run.run_date)
        return transform(raw, run.now)

    return rows


def _touched_applications(w: Warehouse, run: Run, with_applications: bool) -> Touched:
    if not run.strict:
        sources = ("workflow_events", "applications") if with_applications else ("workflow_events",)
        return w.touched(sources, "application_id", run)
    frames = [ingested_on(w.read("stg_workflow_events"), run.run_date)]
    if with_applications:
        frames.append(ingested_on(w.read("stg_applications"), run.run_date))
    return w._written_keys(distinct_keys("application_id", *frames), "application_id", run)


def _enriched(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    """Whole timelines of touched applications, so that late events fall into place."""
    if everything:
        return intermediate.int_workflow_events_enriched(
            w.read("stg_workflow_events"), w.read("stg_applications"), w.hot_applications(run)
        )
    touched = _touched_applications(w, run, with_applications=not run.strict)
    return intermediate.int_workflow_events_enriched(
        w.rows_near("stg_workflow_events", touched),
        w.rows_near("stg_applications", touched),
        w.hot_applications(run, touched),
        touched.keys,
    )


def _dim_job(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    jobs = w.read("stg_jobs")
    return marts.dim_job(jobs if everything else ingested_on(jobs, run.run_date), run.now)


def _dim_candidate(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    candidates, educations = w.read("stg_candidates"), w.read("stg_educations")
    if everything:
        return marts.dim_candidate(candidates, educations, run.now)
    key = "candidate_id"
    if run.strict:
        chosen = history_of(candidates, distinct_keys(key, ingested_on(candidates, run.run_date)), key)
        return marts.dim_candidate(chosen, educations, run.now)
    touched = w.touched(("candidates", "education"), key, run)
    return marts.dim_candidate(
        w.history("stg_candidates", touched), w.history("stg_educations", touched), run.now
    )


def _fct_applications(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    if everything:
        return marts.fct_applications(
            w.read("stg_applications"), w.read("int_workflow_events_enriched"), run.now
        )
    touched = _touched_applications(w, run, with_applications=True)
    return marts.fct_applications(
        w.history("stg_applications", touched),
        w.history("int_workflow_events_enriched", touched, w.hot_applications(run, touched)),
        run.now,
    )


def _fct_workflow_events(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    if everything:
        return marts.fct_workflow_events(w.read("int_workflow_events_enriched"), run.now)
    touched = _touched_applications(w, run, with_applications=not run.strict)
    hot = w.hot_applications(run, touched)
    return marts.fct_workflow_events(w.history("int_workflow_events_enriched", touched, hot), run.now)


def update_hire_counts(w: Warehouse) -> DataFrame:
    """Bring the counts to the state of the facts, and return them.

    The version of the facts that the counts stand for is written with them, so a change is counted
    once, whatever run dies in between. Facts are read only when they were replaced as a whole.
    """
    facts, counts = w.table("fct_applications"), w.hire_counts
    seen = counts.note().get("facts") if counts.exists() else None
    now = {"facts": facts.version()}
    if seen == facts.version():
        return counts.read()
    changes = None if seen is None else facts.changes(seen)
    if changes is None:
        counts.overwrite(marts.hire_counts(facts.read().withColumn("_change", F.lit(1))), now)
    else:
        moved = marts.hire_counts(changes).filter("n <> 0")
        path = f"{w.root}/touched/hires-{uuid.uuid4().hex}"
        moved.write.parquet(path)
        moved = w.spark.read.schema(moved.schema).parquet(path)
        stored = counts.rows_of(moved, "hire_key").select("hire_key", F.col("n").alias("_n"))
        total = (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")
        counts.upsert(
            moved.join(stored, "hire_key", "left").select(
                "hire_key", "job_id", "time_to_hire_days", total
            ),
            note=now,
        )
    counts.clear()
    return counts.read()


def _time_to_hire(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    if run.strict:
        return marts.agg_time_to_hire_by_job_department(
            w.read("fct_applications"), w.read("dim_job"), run.now
        )
    return marts.describe_hires(
        marts.hires_of_counts(update_hire_counts(w)), w.read("dim_job"), run.now
    )


def _anomalies(w: Warehouse, run: Run, everything: bool) -> DataFrame:
    if run.strict:  # the timeline may lag behind changes of applications
        return audit.dq_hired_before_applied_anomalies(
            w.read("stg_workflow_events"), w.read("stg_applications"), run.now
        )
    return audit.anomalies_of_timeline(w.read("int_workflow_events_enriched"), run.now)


# In build order. Event tables are bucketed by application: an event id is a hash over its
# application, and one application's timeline then lies in one bucket.
MODELS = {
    "stg_jobs": Model("stg", "job_id", _staging("jobs", staging.stg_jobs)),
    "stg_candidates": Model("stg", "candidate_id", _staging("candidates", staging.stg_candidates)),
    "stg_educations": Model("stg", "candidate_id", _staging("education", staging.stg_educations)),
    "stg_applications": Model(
        "stg", "application_id", _staging("applications", staging.stg_applications)
    ),
    "stg_workflow_events": Model(
        "stg", "event_id", _staging("workflow_events", staging.stg_workflow_events),
        bucket_by="application_id",
    ),
    "int_workflow_events_enriched": Model(
        "int", "event_id", _enriched, bucket_by="application_id"
    ),
    "dim_job": Model("dim", "job_id", _dim_job),
    "dim_candidate": Model("dim", "candidate_id", _dim_candidate),
    "fct_applications": Model("fact", "application_id", _fct_applications),
    "fct_workflow_events": Model(
        "fact", "event_id", _fct_workflow_events, bucket_by="application_id"
    ),
    "agg_time_to_hire_by_job_department": Model(
        "metric", "job_id", _time_to_hire, incremental=False
    ),
    "dq_hired_before_applied_anomalies": Model("dq", "event_id", _anomalies, incremental=False),
}
