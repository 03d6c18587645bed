"""Scans of source files with a given schema, never an inferred one."""

from __future__ import annotations

import os
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from hireflow.functions.text import null_if_token
from hireflow.sources.schemas import SourceSpec

DATA_DIR_VARIABLE = "HIREFLOW_DATA_DIR"
CORRUPT = "_corrupt_record"


def source_path(file_name: str, data_dir: str | None = None) -> str:
    """Place of a source below the given folder, ``$HIREFLOW_DATA_DIR`` or ``data``.

    The name may stand for one file or a folder of part files.
    """
    base = data_dir or os.environ.get(DATA_DIR_VARIABLE, "data")
    return f"{base.rstrip('/')}/{file_name}"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def csv_scan(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header row, columns taken by name. Cells that mean "missing" become NULL.

    Only the header line is looked at beforehand; parts with another header are refused. Files
    split into tasks; ``multiline`` allows line breaks in quoted cells at the price of one task
    per file.
    """
    header = spark.read.option("header", True).csv(path).columns
    if not header:
        return spark.createDataFrame([], _with_corrupt(schema)).withColumn(
            "_file_name", F.lit(None).cast("string")
        )
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    df = (
        spark.read.schema(_with_corrupt(texts))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .csv(path)
    )
    cells = [_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema]
    unfit = [
        null_if_token(F.col(f.name)).isNotNull() & _typed(F.col(f.name), f.dataType).isNull()
        for f in schema
        if f.dataType != T.StringType()
    ]
    # a line with a cell that does not fit its type counts as unreadable and keeps its text
    line = F.to_json(F.struct(*schema.names))
    corrupt = F.coalesce(CORRUPT, F.when(reduce(or_, unfit, F.lit(False)), line))
    return df.select(
        *cells, corrupt.alias(CORRUPT), F.col("_metadata.file_name").alias("_file_name")
    )


def _typed(cell: Column, kind: T.DataType) -> Column:
    """A cell as its type; whole numbers may have zeros behind the point. NULL if it does not fit."""
    text = null_if_token(cell)
    if isinstance(kind, T.IntegralType):
        text = F.regexp_replace(text, "^(\\s*[+-]?[0-9]+)\\.0*\\s*$", "$1")
    return text.try_cast(kind)


def jsonl_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines; texts stay texts."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("_file_name", F.col("_metadata.file_name"))
    )


def _count(text: Column, signs: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{signs}]", ""))


def _placed_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of files that end at closing braces, with what they mean at their place in the file.

    A brace may lie in a string, and how deep a piece lies depends on all before it. Quotes that no
    backslash escapes flip between text and string, so that state is the parity of their number, which
    splits add up. Depth is summed for both states a split may begin in, and the splits before it say
    which one it is. So a file of any size is read by as many tasks as it has splits.
    """
    row = F.monotonically_increasing_id()
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"),
        row.alias("row"),
        "value",
    )
    plain = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    outside = [
        F.array_join(F.filter(plain, lambda _, i: i % 2 == 0), ""),
        F.array_join(F.filter(plain, lambda _, i: i % 2 == 1), ""),
    ]
    pieces = pieces.withColumns(
        {"flips": (F.size(plain) - 1) % 2}
        | {f"in{s}": _count(text, r"{\[") - _count(text, r"\]") for s, text in enumerate(outside)}
    )
    in_split = Window.partitionBy("file", "split").orderBy("row")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    pieces = pieces.withColumn("odd", odd)
    for state in (0, 1):  # the state the split begins in
        begins = (F.col("odd") + state) % 2
        closes = (begins + F.col("flips")) % 2 == 0
        depth = F.when(begins == 0, F.col("in0")).otherwise(F.col("in1")) - closes.cast("int")
        pieces = pieces.withColumns(
            {f"closes{state}": closes, f"depth{state}": F.sum(depth).over(in_split)}
        )
    totals = pieces.groupBy("file", "split").agg(
        (F.sum("flips") % 2).alias("flips"),
        *[F.max_by(f"depth{s}", "row").alias(f"depth{s}") for s in (0, 1)],
        F.min_by(F.substring(F.ltrim("value"), 1, 1), "row").alias("first"),
        F.max("row").alias("last"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.first("size").alias("size"),
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2
    splits = totals.withColumn("state", state)
    moved = F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    whole = Window.partitionBy("file")
    # the last piece of a file ends without a brace if the pieces and a brace each are longer than it
    is_open = (F.max("split").over(whole) == F.col("split")) & (F.sum("bytes").over(whole) > F.col("size"))
    splits = splits.select(
        "file", "split", "state", F.when(is_open, F.col("last")).alias("open"),
        F.coalesce(F.sum(moved).over(earlier), F.lit(0)).alias("depth_before"),
        F.first("first").over(Window.partitionBy("file").orderBy("split")).alias("first"),
    )
    own = {
        name: F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
        for name in ("closes", "depth")
    }
    base = F.when(F.col("first") == "[", 1).otherwise(0)
    ends = own["closes"] & (F.col("depth_before") + own["depth"] == base)
    closed = ~F.coalesce(F.col("row") == F.col("open"), F.lit(False))
    return pieces.join(splits, ["file", "split"]).select(
        "file", "_file_name", "split", "row", "value", (closed & ends).alias("ends")
    )


def json_array_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array of objects each (or objects one after the other).

    Files of any size split into tasks: see :func:`_placed_pieces`. An object whose text lies in one
    piece is read from it; others, which have objects or braces within, are put together by a shuffle of
    their pieces. An object that cannot be read keeps its text, and so does what lies between or after
    objects and does not belong there.
    """
    pieces = _placed_pieces(spark, path)
    by_split = Window.partitionBy("file", "split").orderBy("row")
    done = F.coalesce(
        F.sum(F.col("ends").cast("int")).over(by_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    numbered = pieces.withColumns(
        # whether the piece before it in the split ends an object, so that this one begins one
        {"number": done, "begins": F.coalesce(F.lag("ends").over(by_split), F.col("split") == 0)}
    )
    single = F.col("begins") & F.col("ends")
    one = numbered.where(single).select("_file_name", F.concat("value", F.lit("}")).alias("text"))
    # an object that goes on in the next split has number 0 there; the splits before say which one it is
    rest = numbered.where(~single)
    totals = pieces.groupBy("file", "split").agg(F.sum(F.col("ends").cast("int")).alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ordered = F.array_sort(F.collect_list(F.struct("split", "row", "value")))
    joined = F.array_join(F.transform(ordered, lambda piece: piece["value"]), "}")
    several = (
        rest.join(offsets, ["file", "split"])
        .groupBy("file", "_file_name", (F.col("first") + F.col("number")).alias("number"))
        .agg(joined.alias("text"), F.max("ends").alias("whole"))
        .select("_file_name", F.when(F.col("whole"), F.concat("text", F.lit("}"))).otherwise(F.col("text")).alias("text"))
    )
    texts = one.unionByName(several)
    lead = F.regexp_extract("text", r"(?s)^[^{]*", 0)
    fits = lead.rlike(r"^\s*[\[,]?\s*$")
    body = F.substr("text", F.char_length(lead) + 1)
    parsed = F.from_json(
        body, _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    )
    empty = texts["text"].rlike(r"^\s*(\[\s*)?\]?\s*$")
    read = texts.where(~empty).select(
        F.when(fits, parsed).alias("parsed"), "text", "_file_name"
    )
    corrupt = F.when(F.col("parsed").isNull(), F.col("text")).otherwise(F.col(f"parsed.{CORRUPT}"))
    good = corrupt.isNull()
    return read.select(
        *[F.when(good, F.col(f"parsed.{f.name}")).alias(f.name) for f in schema],
        corrupt.alias(CORRUPT),
        "_file_name",
    )


def is_empty(spark: SparkSession, spec: SourceSpec, path: str, scanned: DataFrame) -> bool:
    """Whether a source that was scanned has no rows.

    The first row of an array is known only when all its pieces have been placed; but whatever holds an
    opening brace becomes a row, so the first one settles it.
    """
    if spec.layout == "json_array":
        pieces = spark.read.option("lineSep", "}").text(path)
        if not pieces.where(F.contains("value", F.lit("{"))).isEmpty():
            return False
    return scanned.isEmpty()


def read_source(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    scan = {"csv": csv_scan, "json_array": json_array_scan, "jsonl": jsonl_scan}[spec.layout]
    return scan(spark, path, spec.columns)
