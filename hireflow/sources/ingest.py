"""File drops to raw tables, safe to repeat.

Each try to load a batch writes to a folder of its own,
``_ingestion_date=…/_batch_id=…/_attempt=…`` of its raw table, and nothing is ever overwritten. What
counts is the folder of the batch's newest success in the ledger: a try that dies at any point
leaves what was loaded before, and a replay that succeeds replaces it as a whole.

Lines that cannot be read, and rows that break a rule of the store, are kept aside with their reasons
in the same pass. Corrected rows are released from there as a batch of their own.
"""

from __future__ import annotations

from datetime import datetime, timezone

from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from hireflow.functions.hashing import batch_key
from hireflow.operators.keyed_table import write_options
from hireflow.session import path_exists, unsorted_writes
from hireflow.sources.checksums import SEPARATORS, drop_checksum
from hireflow.sources.enrich import enrich
from hireflow.sources.ledger import Ledger
from hireflow.sources.quarantine import Rules, tag_for_load
from hireflow.sources.readers import CORRUPT, is_empty, read_source, source_path
from hireflow.sources.schemas import RAW, SOURCES, SourceSpec

LOADED, SKIPPED, EMPTY = "loaded", "skipped", "empty"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


#: Columns that rows are stored with besides those of their contract.
_ASIDE = [
    T.StructField(CORRUPT, T.StringType()),
    T.StructField("_reject_reasons", T.ArrayType(T.StringType())),
    T.StructField("_attempt", T.LongType()),
    T.StructField("_quarantined", T.BooleanType()),
]
_PLACE = ["_batch_id", "_ingestion_date", "_attempt"]


class RawStore:
    """The raw tables and their ledger below one folder; a new folder is an empty store.

    ``rules`` say by source which rows are kept aside; without them only unreadable lines are.
    """

    def __init__(self, spark: SparkSession, root: str, rules: Rules | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rules = rules or {}
        self.ledger = Ledger(spark, f"{self.root}/ingestion_batches")

    def table_path(self, source: str) -> str:
        return f"{self.root}/{source}"

    def read(self, source: str) -> DataFrame:
        """Good rows of the visible batches. The ledger join prunes partitions."""
        schema = RAW[source]
        return self._visible(source).filter(~F.col("_quarantined")).select(*schema.names)

    def quarantined(self, source: str) -> DataFrame:
        """Rows of the visible batches that are kept aside and not released, with their reasons.

        ``quarantine_id`` stands for what a row holds in its batch; equal rows share it. Lines that
        could not be read have their text in ``_corrupt_record``.
        """
        aside = self._visible(source).filter("_quarantined").withColumn("quarantine_id", _aside_id())
        path = self._released_path(source)
        if path_exists(self.spark, path):
            place = T.StructType([f for f in aside.schema if f.name in _PLACE])
            ids = T.StructType([T.StructField("quarantine_id", T.StringType()), *place.fields])
            released = self.spark.read.schema(ids).parquet(path)
            batches = self.ledger.visible().filter(F.col("source_name") == source)
            released = released.join(batches, _PLACE, "left_semi").select("quarantine_id")
            aside = aside.join(released, "quarantine_id", "left_anti")
        return aside.select("quarantine_id", "_reject_reasons", CORRUPT, *RAW[source].names)

    def _released_path(self, source: str) -> str:
        return f"{self.root}/released/{source}"

    def _visible(self, source: str) -> DataFrame:
        schema = T.StructType([*RAW[source].fields, *_ASIDE])
        path = self.table_path(source)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        batches = self.ledger.visible().filter(F.col("source_name") == source)
        return self.spark.read.schema(schema).parquet(path).join(batches, _PLACE, "left_semi")

    def load(self, spec: SourceSpec, path: str, now: datetime | None = None) -> dict:
        """Load one drop. Returns the batch, what happened and the row counts."""
        scanned = read_source(self.spark, spec, path)
        if is_empty(self.spark, spec, path, scanned):
            return _outcome(spec, EMPTY, None)
        checksum = drop_checksum(self.spark, path, SEPARATORS.get(spec.layout, "\n"))
        return self.load_rows(spec, scanned, spec.file_name, checksum, now)

    def load_rows(
        self,
        spec: SourceSpec,
        scanned: DataFrame,
        origin: str,
        checksum: str,
        now: datetime | None = None,
        replay: str | None = None,
        also: Callable[[str], None] | None = None,
    ) -> dict:
        """Load scanned rows as the batch of ``origin`` and ``checksum``.

        A batch that is loaded already is left alone or replaced, as ``replay`` (or the source) says.
        ``also`` writes what must count together with the batch, given the end of its path.
        """
        now = now or utc_now()
        batch_id = self._batch_id(spec, origin, checksum)
        if (replay or spec.replay) == "skip" and self.ledger.has_succeeded(batch_id):
            return _outcome(spec, SKIPPED, batch_id)

        started = self.ledger.start(spec, batch_id, checksum, now, origin)
        place = f"_ingestion_date={now.date()}/_batch_id={batch_id}/_attempt={started['attempt']}"
        rules = self.rules.get(spec.name, dict)()
        try:
            rows, rejected = self._write(
                enrich(
                    tag_for_load(scanned, rules), spec, batch_id, checksum, now, CORRUPT,
                    "_reject_reasons", "_quarantined",
                ),
                f"{self.table_path(spec.name)}/{place}",
            )
            if also is not None:
                also(place)
            self.ledger.succeed(started, utc_now(), rows)
        except Exception as error:
            self.ledger.fail(started, utc_now(), str(error))
            raise
        return _outcome(spec, LOADED, batch_id, rows, rejected)

    def release(self, source: str, corrected: DataFrame, now: datetime | None = None) -> dict:
        """Load corrected rows out of quarantine, as a batch of their own.

        ``corrected`` has the columns of the source's file and the ``quarantine_id`` of the row that
        each stands for. The rules look at them again. Ids count as released from the moment the
        batch counts; releasing the same rows again does nothing.
        """
        spec = SOURCES[source]
        names = ["quarantine_id", *spec.columns.names]
        content = F.xxhash64(*names, *[F.col(n).isNull() for n in names]).cast("decimal(20,0)")
        total = corrected.agg(F.concat_ws("|", F.count(F.lit(1)), F.sum(content))).first()[0]

        def also(place: str) -> None:
            corrected.select("quarantine_id").distinct().write.mode("overwrite").parquet(
                f"{self._released_path(source)}/{place}"
            )

        rows = corrected.select(
            *spec.columns.names, F.lit(None).cast("string").alias(CORRUPT),
            F.lit("quarantine").alias("_file_name"),
        )
        return self.load_rows(spec, rows, "quarantine", total, now, "skip", also)

    def _batch_id(self, spec: SourceSpec, origin: str, checksum: str) -> str:
        key = batch_key(F.lit(spec.name), F.lit(origin), F.lit(checksum))
        return self.spark.range(1).select(key.alias("k")).first()["k"]

    def _write(self, tagged: DataFrame, path: str) -> tuple[int, int]:
        """Write one new folder; good and unreadable rows are counted in the same pass."""
        counted = Observation()
        observed = tagged.drop("_ingestion_date", "_batch_id").observe(
            counted,
            F.count_if(~F.col("_quarantined")).alias("rows"),
            F.count_if("_quarantined").alias("rejected"),
        )
        with unsorted_writes(tagged.sparkSession):
            observed.write.partitionBy("_quarantined").options(
                **write_options("_record_hash", "_event_id")
            ).parquet(path)
        return counted.get["rows"], counted.get["rejected"]


def _outcome(
    spec: SourceSpec, outcome: str, batch_id: str | None, rows: int = 0, rejected: int = 0
) -> dict:
    return {"source": spec.name, "outcome": outcome, "batch_id": batch_id, "rows": rows,
            "rejected": rejected}


def _aside_id() -> Column:
    """What a row that is kept aside holds, within its batch."""
    line = F.coalesce(CORRUPT, F.lit(""))
    return F.md5(F.concat_ws("|", "_batch_id", "_file_name", "_record_hash", line))


def load_all_sources(
    store: RawStore, data_dir: str | None = None, now: datetime | None = None
) -> list[dict]:
    """All sources in load order; the first failure stops the run."""
    now = now or utc_now()
    return [
        store.load(spec, source_path(spec.file_name, data_dir), now) for spec in SOURCES.values()
    ]
