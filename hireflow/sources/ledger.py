"""Batch ledger: append-only state rows.

The newest row of a batch is its state; its newest success says which folder holds its rows. So a
replay that is running or has failed leaves what was loaded before in place.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hireflow.operators.latest import latest_by
from hireflow.session import path_exists, small_frame
from hireflow.sources.schemas import LEDGER, SourceSpec

_STORED = T.StructType(
    [
        *LEDGER.fields,
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("recorded_at", T.LongType()),
        T.StructField("attempt", T.LongType()),  # names the folder of one try to load a batch
    ]
)

STARTED, SUCCEEDED, FAILED = "STARTED", "SUCCEEDED", "FAILED"


class Ledger:
    """One small row per state change; rows never change once written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _append(self, row: dict) -> None:
        values = [tuple(row.get(name) for name in _STORED.names)]
        small_frame(self.spark, values, _STORED).write.mode("append").parquet(self.path)

    def _states(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _STORED)
        return self.spark.read.schema(_STORED).parquet(self.path)

    def _newest(self, states: DataFrame) -> DataFrame:
        return latest_by(states, ["batch_id"], [F.col("recorded_at").desc()])

    def _succeeded(self) -> DataFrame:
        return self._newest(self._states().filter(F.col("status") == SUCCEEDED))

    def batches(self) -> DataFrame:
        """One row per batch in its current state."""
        return self._newest(self._states()).select(*LEDGER.names)

    def visible(self) -> DataFrame:
        """The folder of each batch that counts: that of its newest success."""
        return self._succeeded().select(
            "source_name",
            F.col("batch_id").alias("_batch_id"),
            F.col("ingestion_date").alias("_ingestion_date"),
            F.col("attempt").alias("_attempt"),
        )

    def has_succeeded(self, batch_id: str) -> bool:
        return not self._succeeded().filter(F.col("batch_id") == batch_id).isEmpty()

    def received(self, source: str) -> DataFrame:
        """When each visible batch of a source was received, as ``_ingestion_ts`` of its rows."""
        batches = self._succeeded().filter(F.col("source_name") == source)
        return batches.select(F.col("started_at").alias("_ingestion_ts"))

    def start(
        self, spec: SourceSpec, batch_id: str, checksum: str, now: datetime, origin: str | None = None
    ) -> dict:
        recorded = time.time_ns()
        row = {
            "batch_id": batch_id,
            "source_name": spec.name,
            "source_system": spec.system,
            "file_name": origin or spec.file_name,
            "file_checksum": checksum,
            "load_strategy": spec.strategy,
            "status": STARTED,
            "started_at": now,
            "ingestion_date": now.date(),
            "recorded_at": recorded,
            "attempt": recorded,
        }
        self._append(row)
        return row

    def succeed(self, started: dict, completed_at: datetime, rows: int) -> None:
        self._append(
            started
            | {
                "status": SUCCEEDED,
                "completed_at": completed_at,
                "rows_loaded": rows,
                "recorded_at": time.time_ns(),
            }
        )

    def fail(self, started: dict, completed_at: datetime, message: str) -> None:
        self._append(
            started
            | {
                "status": FAILED,
                "completed_at": completed_at,
                "error_message": message,
                "recorded_at": time.time_ns(),
            }
        )
