"""Profiles of source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hireflow.functions.dates import date_class, parse_mixed_date
from hireflow.operators.impacted import orphans


def source_inventory(sources: dict[str, DataFrame]) -> DataFrame:
    """(file, rows, columns, column_names) per source."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("file"),
                "rows",
                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                F.lit(", ".join(df.columns)).alias("column_names"),
            )
            for name, df in sources.items()
        ],
    )


def _as_text(field: T.StructField) -> Column:
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(field.name) if nested else F.col(field.name).cast("string")


def _identity(field: T.StructField) -> Column:
    """A value to compare by; texts by their digest, so that long ones do not get shuffled."""
    text = _as_text(field)
    if not isinstance(field.dataType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        return text
    return F.sha2(text, 256)


def column_profile(df: DataFrame, file: str) -> DataFrame:
    """(file, column, dtype, null_count, distinct_count) per column; NULL is one distinct value.

    One scan: cells are counted per (column, value) before the shuffle, so a value that fills a
    third of a column travels once per task.
    """
    fields = df.schema.fields
    cells = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("position"), _identity(f).alias("value"))
                for i, f in enumerate(fields)
            ]
        )
    )
    values = df.select(cells).groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = values.groupBy("position").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )
    return _describe(counted, df, file)


def column_profile_approx(df: DataFrame, file: str, rsd: float = 0.02) -> DataFrame:
    """The same with estimated distinct counts: nothing but sketches is shuffled."""
    fields = df.schema.fields
    figures = df.agg(
        *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)],
        *[F.approx_count_distinct(_as_text(f), rsd).alias(f"d{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.col(f"n{i}").alias("null_count"),
                (F.col(f"d{i}") + (F.col(f"n{i}") > 0).cast("bigint")).alias("distinct_count"),
            )
            for i in range(len(fields))
        ]
    )
    return _describe(figures.select(F.inline(rows)), df, file)


#: Sizes of the sketches: 2^14 registers give a standard error of 0.8 % of the distinct count, and a
#: quantile is off by at most about 0.7 % of the rows.
HLL_LG, KLL_K = 14, 400


class ColumnSketches:
    """Sketches of a table's columns, one small row for each column and batch.

    A batch is read once, when it arrives; the profile of any set of batches merges their rows. A batch
    that is added again replaces its rows.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, df: DataFrame, batch: str) -> None:
        """Sketch all columns of a batch in one scan; nothing but sketches is shuffled."""
        fields = df.schema.fields
        aggregates = []
        for i, f in enumerate(fields):
            number = (F.col(f.name) if isinstance(f.dataType, T.NumericType) else F.lit(None)).cast("double")
            aggregates += [
                F.count_if(F.col(f.name).isNull()).alias(f"n{i}"),
                F.hll_sketch_agg(_as_text(f), HLL_LG).alias(f"d{i}"),
                F.kll_sketch_agg_double(number, KLL_K).alias(f"q{i}"),
            ]
        rows = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("dtype"),
                    F.col("n").alias("rows"),
                    F.col(f"n{i}").alias("null_count"),
                    F.col(f"d{i}").alias("distinct"),
                    F.col(f"q{i}").alias("quantiles"),
                )
                for i, f in enumerate(fields)
            ]
        )
        figures = df.agg(F.count(F.lit(1)).alias("n"), *aggregates).select(F.inline(rows))
        figures.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def profile(self, file: str, batches: list[str] | None = None) -> DataFrame:
        """(file, column, dtype, rows, null_count, distinct_count, median) of some batches, or of all.

        NULL is one distinct value; ``median`` is null for columns that are no numbers.
        """
        stored = self.spark.read.parquet(self.path)
        if batches is not None:
            stored = stored.filter(F.col("batch").cast("string").isin(batches))
        merged = stored.groupBy("column", "dtype").agg(
            F.sum("rows").alias("rows"),
            F.sum("null_count").alias("null_count"),
            F.hll_union_agg("distinct").alias("distinct"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
        )
        some = F.kll_sketch_get_n_double("quantiles") > 0
        return merged.select(
            F.lit(file).alias("file"), "column", "dtype", "rows", "null_count",
            (F.hll_sketch_estimate("distinct") + (F.col("null_count") > 0).cast("bigint")).alias(
                "distinct_count"
            ),
            F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median"),
        )


def _describe(counted: DataFrame, df: DataFrame, file: str) -> DataFrame:
    fields = df.schema.fields
    names = F.array(*[F.lit(f.name) for f in fields])
    kinds = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    return counted.select(
        F.lit(file).alias("file"),
        F.element_at(names, F.col("position") + 1).alias("column"),
        F.element_at(kinds, F.col("position") + 1).alias("dtype"),
        "null_count",
        "distinct_count",
    )


def _row_digest(df: DataFrame) -> Column:
    """16 bytes that stand for a whole row; cells carry their length, so no two rows run together."""
    cells = [
        F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))
        for text in map(_as_text, df.schema)
    ]
    return F.substring(F.unhex(F.sha2(F.concat_ws("|", *cells), 256)), 1, 16)


def full_duplicate_rows(df: DataFrame, file: str) -> DataFrame:
    """Rows beyond the first of each set of identical rows; NULL equals NULL."""
    copies = df.select(_row_digest(df).alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("full_duplicate_rows")
    ).select(F.lit(file).alias("file"), "full_duplicate_rows")


def date_pattern_profile(columns: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(file, column, format, count) over raw date texts, missing ones left out."""
    return reduce(
        DataFrame.unionByName,
        [
            df.filter(F.col(column).isNotNull())
            .groupBy(date_class(F.col(column)).alias("format"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.lit(file).alias("file"), F.lit(column).alias("column"), "format", "count")
            for (file, column), df in columns.items()
        ],
    ).orderBy("file", F.col("count").desc(), "format")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(column).asc_nulls_last())
    )


def list_stats(df: DataFrame, column: str) -> DataFrame:
    """Smallest, largest and mean list length; a missing list has length 0."""
    size = F.coalesce(F.size(column), F.lit(0))
    return df.agg(
        F.min(size).cast("bigint").alias("min_size"),
        F.max(size).cast("bigint").alias("max_size"),
        F.round(F.sum(size) / F.count(F.lit(1)), 2).alias("avg_size"),
    )


def top_elements(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Commonest list elements."""
    return (
        df.select(F.explode(column).alias("element"))
        .groupBy("element")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("element").asc())
        .limit(k)
    )


def anomaly_probe(events: DataFrame, applications: DataFrame) -> DataFrame:
    """Raw events marked Hired that are dated before their application's raw date."""
    applied = applications.select(
        "application_id", "apply_date", parse_mixed_date(F.col("apply_date")).alias("applied_on")
    )
    hired = events.filter(F.col("new_status") == "Hired").withColumn(
        "hired_on", parse_mixed_date(F.col("event_timestamp"))
    )
    return (
        hired.join(applied, "application_id", "left")
        .filter(F.col("hired_on") < F.col("applied_on"))
        .select("application_id", "old_status", "new_status", "event_timestamp", "apply_date")
    )


def relationship_profile(
    child: DataFrame, foreign_key: str, parent: DataFrame, key: str, name: str
) -> DataFrame:
    """Distinct keys used, keys without parent, and parents never used.

    Keys are made distinct first, so a key that fills a third of the child joins as one row.
    """
    used = child.filter(F.col(foreign_key).isNotNull()).select(foreign_key).distinct()
    known = parent.filter(F.col(key).isNotNull()).select(key).distinct()
    total = F.count(F.lit(1))
    parts = {
        "distinct_used": used,
        "orphans": orphans(used, foreign_key, known, key),
        "never_used": orphans(known, key, used, foreign_key),
    }
    counted = [
        df.agg(total.alias("keys")).select(
            F.lit(name).alias("relationship"), F.lit(measure).alias("measure"), "keys"
        )
        for measure, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted)
