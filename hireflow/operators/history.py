"""History of changing rows (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hireflow.operators.impacted import distinct_keys, history_of
from hireflow.operators.keyed_table import KeyedTable
from hireflow.operators.skew import HotKeys, number_across_ranges, split_hot


def scd2(snapshots: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """One row per state of a key with ``valid_from``, ``valid_to`` (open: NULL), ``is_current``.

    Snapshots that repeat the state before them by ``_record_hash`` add nothing. Keys listed in
    ``hot`` are compared by joins on their position instead of inside one task.
    """
    if hot is None:
        return _validity(_changes(snapshots, key), key)
    ordinary, big = split_hot(snapshots, key, hot)
    changed = _linked(big, key, -1, "_record_hash", "_before").filter(
        F.col("_before").isNull() | (F.col("_before") != F.col("_record_hash"))
    )
    ranged = _linked(changed.drop("_before"), key, 1, "_ingestion_ts", "valid_to")
    return _validity(_changes(ordinary, key), key).unionByName(_flags(ranged))


def _order() -> list:
    return [F.col("_ingestion_ts").asc(), F.col("_record_hash").asc()]


def _changes(df: DataFrame, key: str) -> DataFrame:
    before = F.lag("_record_hash").over(Window.partitionBy(key).orderBy(*_order()))
    return (
        df.withColumn("_before", before)
        .filter(F.col("_before").isNull() | (F.col("_before") != F.col("_record_hash")))
        .drop("_before")
    )


def _validity(df: DataFrame, key: str) -> DataFrame:
    after = F.lead("_ingestion_ts").over(Window.partitionBy(key).orderBy(*_order()))
    return _flags(df.withColumn("valid_to", after))


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumn("valid_from", F.col("_ingestion_ts")).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def _linked(df: DataFrame, key: str, step: int, column: str, out: str) -> DataFrame:
    """Value of a column in the row ``step`` places further on within the key."""
    numbered = number_across_ranges(df, key, _order(), "_n").checkpoint()
    other = numbered.select(
        F.col(key).alias("_key"), (F.col("_n") - step).alias("_at"), F.col(column).alias(out)
    )
    return numbered.join(
        other, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_n") == F.col("_at")), "left"
    ).drop("_key", "_at", "_n")


class StoredHistory:
    """History kept up to date snapshot by snapshot, in whatever order they arrive.

    A row for each key holds its states one after the other, each with the times at which it was seen.
    So a late snapshot can close, open, split or join states as if all had been known before, and one
    that is merged again adds nothing. Only folders that hold keys of the snapshot are read. Rows
    without a key are left out; a key has at most one time for each of its snapshots. Columns that
    ``_record_hash`` does not cover are those of the earliest row that was merged for the state.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.key = key
        self.table = KeyedTable(spark, path, [key], buckets=buckets)

    def merge(self, snapshot: DataFrame) -> None:
        """Add rows with ``_ingestion_ts`` and ``_record_hash``; several times may come at once."""
        key = self.key
        columns = [c for c in snapshot.columns if c not in (key, "_ingestion_ts")]
        seen = snapshot.filter(F.col(key).isNotNull()).select(
            key, F.col("_ingestion_ts").alias("at"), F.col("_record_hash").alias("hash"),
            F.struct(*columns).alias("row"),
        )
        if self.table.exists():
            keys = distinct_keys(key, seen)
            stored = history_of(self.table.rows_of(keys, key), keys, key)
            states = stored.select(key, F.inline("states"))
            seen = seen.unionByName(states.select(key, F.explode("seen").alias("at"), "hash", "row"))
        once = seen.groupBy(key, "at", "hash").agg(F.min("row").alias("row"))
        order = Window.partitionBy(key).orderBy("at", "hash")
        fresh = F.lag("hash").over(order).eqNullSafe(F.col("hash"))
        runs = (
            once.withColumn("fresh", (~fresh).cast("int"))
            .withColumn("run", F.sum("fresh").over(order))
            .groupBy(key, "run", "hash")
            .agg(
                F.sort_array(F.collect_list("at")).alias("seen"),
                F.min_by("row", "at").alias("row"),
            )
        )
        state = F.struct("run", "hash", "seen", "row")
        ordered = F.array_sort(F.collect_list(state))
        self.table.upsert(
            runs.groupBy(key).agg(
                F.transform(ordered, lambda s: F.struct(s["hash"].alias("hash"), s["seen"].alias("seen"),
                                                        s["row"].alias("row"))).alias("states")
            )
        )

    def read(self) -> DataFrame:
        """The states as :func:`scd2` gives them."""
        rows = self.table.read().select(self.key, "states", F.posexplode("states").alias("at", "state"))
        after = F.get(F.col("states"), F.col("at") + 1)
        first = F.get(F.col("state.seen"), F.lit(0))
        return rows.select(
            self.key, "state.row.*", first.alias("_ingestion_ts"),
            F.get(after["seen"], F.lit(0)).alias("valid_to"), first.alias("valid_from"),
            after.isNull().alias("is_current"),
        )
