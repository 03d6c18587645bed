"""Content fingerprints of source drops."""

from __future__ import annotations

from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Bits of a monotonically increasing id that count rows within a task.
_ROW_BITS = 33

#: Sums are taken modulo this prime; a product of two numbers below it fits a long.
PRIME = (1 << 31) - 1

#: One base for each quarter of a line's MD5.
BASES = [int(md5(f"lane {i}".encode()).hexdigest()[:7], 16) for i in range(4)]

#: Bytes of a gzip file without content; one with a byte in it is longer.
EMPTY_GZIP = 20

_DIGITS = 5  # of exponents, one byte each

#: What ends a record, so that files of the layout fall into many small ones.
SEPARATORS = {"json_array": ","}


def _quarter(text: Column, lane: int) -> Column:
    return F.conv(F.substring(F.md5(text), 8 * lane + 1, 8), 16, 10).cast("long")


def _power(base: int, exponent: Column) -> Column:
    """``base`` to the exponent, from its powers to every byte of the exponent."""
    powers = []
    for digit in range(_DIGITS):
        step = pow(base, 1 << (8 * digit), PRIME)
        table = F.expr(f"array({', '.join(f'{pow(step, i, PRIME)}L' for i in range(256))})")
        byte = F.shiftright(exponent, 8 * digit).bitwiseAND(F.lit(255)).cast("int")
        powers.append(F.get(table, byte))
    return reduce(lambda a, b: a * b % PRIME, powers)


def _digest(*columns: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def file_checksums(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """(path, length, checksum) per file, by the file's length and its records in order.

    Records end at ``separator``. Each has four numbers from its MD5; a file's four sums weigh them
    with the powers of a base, the record's place being the exponent, modulo a prime. Such sums of
    two stretches make that of both: the second's is shifted by the records of the first. So splits
    are summed up where they are read, in parallel whatever the size of a file, and shifted by the
    records before them. Neither split sizes nor the order of tasks matter, and any two orders of
    the same records differ, but for a chance of about 2^-124.

    A file that is listed but gave no records fails the query.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # both sides name a file the same way, whatever signs its path holds
    files = listed.select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length")
    )
    records = spark.read.option("recursiveFileLookup", True).option("lineSep", separator).text(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    lanes = range(len(BASES))
    splits = (
        records.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            row.alias("row"),
            "value",
        )
        .groupBy("file", "split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("row").alias("first"),
            *[
                F.sum(_quarter(F.col("value"), i) * _power(BASES[i], F.col("row")) % PRIME).alias(f"s{i}")
                for i in lanes
            ],
        )
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))

    def placed(lane: int) -> Column:
        """The split's sum as if its first row were the ``earlier``-th of the file."""
        inverse = pow(BASES[lane], PRIME - 2, PRIME)
        local = F.col(f"s{lane}") % PRIME * _power(inverse, F.col("first")) % PRIME
        return local * _power(BASES[lane], F.col("earlier")) % PRIME

    sums = (
        splits.withColumn("earlier", earlier)
        .groupBy("file")
        .agg(
            F.sum("n").alias("n"),
            *[(F.sum(placed(i)) % PRIME).alias(f"s{i}") for i in lanes],
        )
    )
    lost = F.raise_error(F.concat(F.lit("no records read from "), "path")).cast("long")
    empty = F.when(F.col("path").endswith(".gz"), EMPTY_GZIP).otherwise(0)
    found = F.when(F.col("n").isNull() & (F.col("length") > empty), lost).otherwise(F.col("n"))
    return (
        files.join(sums, "file", "left")
        .withColumn("n", found)
        .select("path", "length", _digest("length", "n", *[f"s{i}" for i in lanes]).alias("checksum"))
    )


def drop_checksum(spark: SparkSession, path: str, separator: str = "\n") -> str:
    """One fingerprint for a drop: the file's own checksum, or one over its parts in order of name.

    The parts are numbered in one task, one narrow row for each file of the drop.
    """
    place = F.row_number().over(Window.orderBy("path")).cast("long") - 1
    sums = [
        (F.sum(_quarter(F.col("checksum"), i) * _power(base, F.col("place")) % PRIME) % PRIME).alias(f"s{i}")
        for i, base in enumerate(BASES)
    ]
    row = (
        file_checksums(spark, path, separator)
        .withColumn("place", place)
        .agg(F.count(F.lit(1)).alias("n"), *sums, F.min("checksum").alias("only"))
        .select(
            F.when(F.col("n") == 1, F.col("only"))
            .otherwise(_digest("n", *[f"s{i}" for i in range(len(BASES))]))
            .alias("checksum")
        )
        .first()
    )
    return row["checksum"]
