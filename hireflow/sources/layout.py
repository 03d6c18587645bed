"""File layout of large event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hireflow.operators.keyed_table import CODEC
from hireflow.session import unsorted_writes

# Target size of a data file.
FILE_BYTES = 200 * 1024 * 1024


def write_events(df: DataFrame, path: str, partition: str = "event_date",
                 rows_per_file: int = 2_000_000) -> None:
    """Events by day, each day's files sorted by application and time.

    Rows are ranged by day, application and id, so a busy day or application is cut into as many
    files as it needs, and a reader can skip files by their statistics.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(ranges, partition, "application_id", "event_timestamp", "event_id")
        .sortWithinPartitions(partition, "application_id", "event_timestamp", "event_id")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy(partition)
        .mode("overwrite")
        .parquet(path)
    )


def compact_partitions(
    spark: SparkSession, source: str, target: str, partition: str, file_bytes: int = FILE_BYTES
) -> None:
    """Rewrite a partitioned table with files near the target size into a new folder.

    Rebalancing joins small pieces and cuts big ones by their size, so one huge partition is
    written by many tasks.
    """
    own = spark.newSession()  # other jobs of the caller's session keep their setting
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
    with unsorted_writes(own):
        own.read.parquet(source).hint("rebalance", partition).write.partitionBy(partition).mode(
            "overwrite"
        ).option("compression", CODEC).parquet(target)
