"""Keys touched by a run, and the whole history behind them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.operators.skew import HotKeys, split_hot


def ingested_on(df: DataFrame, run_date) -> DataFrame:
    """Rows received on one day; a partition filter on raw tables."""
    return df.filter(F.col("_ingestion_date") == F.lit(run_date).cast("date"))


def distinct_keys(key: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys over all frames."""
    return reduce(DataFrame.union, [f.select(key) for f in frames]).distinct()


def history_of(
    df: DataFrame, keys: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """All rows of the given keys; a key listed twice does not double its rows.

    Rows of hot keys are taken out before the shuffle and matched by a small side of their own.
    """
    if hot is None:
        return df.join(keys, key, "left_semi")
    ordinary, big = split_hot(df, key, hot)
    few = split_hot(keys, key, hot)[1].distinct()
    return ordinary.join(keys, key, "left_semi").unionByName(
        big.join(hot.few(few), key, "left_semi")
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that name a parent which does not exist. NULL names nothing."""
    parents = parent.select(F.col(key).alias(foreign_key))
    return child.filter(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def with_flag(condition: Column) -> Column:
    """TRUE or FALSE; an undecided condition is FALSE."""
    return F.coalesce(condition, F.lit(False))
