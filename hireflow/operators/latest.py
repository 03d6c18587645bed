"""Top row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    The planner keeps one row per key and input partition before the shuffle, so a key with very
    many copies does not travel. The order must be total or the choice is arbitrary.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def newest_snapshot(df: DataFrame, *keys: str) -> DataFrame:
    """Newest ingested row per key; rows of one batch are told apart by their hash."""
    return latest_by(
        df,
        list(keys),
        [F.col("_ingestion_ts").desc_nulls_last(), F.col("_record_hash").desc_nulls_last()],
    )
