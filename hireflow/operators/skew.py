"""Numbering rows per key when single keys may be far too big for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from hireflow.session import ensure_checkpoint_dir

# Rows of one key a single task may sort. A key above it takes the spread path.
HOT_ROWS = 5_000_000

# Offset rows (one per key and range) that may be broadcast.
BROADCAST_ROWS = 500_000


# Counters that rows are counted in before single keys are, and how many of them a filter may list.
COUNTERS, FEW_COUNTERS = 1 << 14, 1000


@dataclass(frozen=True)
class HotKeys:
    """Keys too big for one task, as column ``_hot``. NULL can be one of them."""

    frame: DataFrame
    count: int

    def few(self, df: DataFrame) -> DataFrame:
        """Broadcast a frame that holds at most one row per hot key, if its count allows."""
        return F.broadcast(df) if self.count <= BROADCAST_ROWS else df


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> HotKeys | None:
    """Keys with more than ``hot_rows`` rows, or None.

    Rows are first counted by hash of the key, in a bounded number of counters: a key can only be hot if
    its counter is. Keys are counted one by one only where some may be; counts are combined before the
    shuffle and only the key column is read. At most ``rows / hot_rows`` keys can come back; they are
    written out once, not recomputed.
    """
    full = _full_counters(df, key, hot_rows)
    if not full:
        return None
    hot = (
        df.filter(_counter(key).isin(full) if len(full) <= FEW_COUNTERS else F.lit(True))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(F.col(key).alias("_hot"))
    )
    found = hot.count()
    if found == 0:
        return None
    ensure_checkpoint_dir(df.sparkSession)
    return HotKeys(hot.checkpoint(), found)


def _counter(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(COUNTERS)).cast("int")


def _full_counters(df: DataFrame, key: str, hot_rows: int) -> list[int]:
    """Counters with more than ``hot_rows`` rows."""
    counted = df.groupBy(_counter(key).alias("_counter")).agg(F.count(F.lit(1)).alias("_rows"))
    return [r["_counter"] for r in counted.filter(F.col("_rows") > hot_rows).select("_counter").collect()]


def split_hot(df: DataFrame, key: str, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    keys = hot.few(hot.frame)
    matches = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(keys, matches, "left_anti"), df.join(keys, matches, "left_semi")


def number_rows(
    df: DataFrame, key: str, order: list[Column], out: str, hot: HotKeys | None = None
) -> DataFrame:
    """Row number of each row within its key. ``order`` must be total."""
    if hot is None:
        return _number_in_tasks(df, key, order, out)
    ordinary, big = split_hot(df, key, hot)
    return _number_in_tasks(ordinary, key, order, out).unionByName(
        number_across_ranges(big, key, order, out)
    )


def _number_in_tasks(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window).cast("bigint"))


def number_across_ranges(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """Same numbers without ever putting one key into one task.

    Rows are range partitioned by key and order, so a big key covers many neighbouring
    partitions. A row's number is its place in its partition plus the rows its key has in the
    partitions before. The sorted rows are checkpointed: places and counts must come from one
    and the same run of the shuffle, also when executors are lost.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(ranges, F.col(key).asc(), *order)
        .sortWithinPartitions(F.col(key).asc(), *order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", 33))
        .checkpoint()
    )
    spans = placed.groupBy(key, "_range").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(key)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    offsets = spans.select(
        F.col(key).alias("_key"),
        F.col("_range").alias("_in"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return (
        placed.join(
            offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_in"))
        )
        .withColumn(out, (F.col("_place") + F.col("_shift")).cast("bigint"))
        .drop("_place", "_range", "_shift", "_key", "_in")
    )
