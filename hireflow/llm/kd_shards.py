"""Shards of near equal bytes by a K-d tree over metadata.

A node of the tree holds rows and the number of shards they make up. It is split along the
dimension in which its rows spread widest, at the point that divides its bytes as its shards
divide, until a node is one shard; the target size is all bytes over the number of shards. Points
come from sums of bytes per bin, which are refined within the bin that holds the point until it
holds one value; so a pass moves a bounded number of sums, and no rows are sorted or shuffled to
find it. All nodes of a level are split together.

Each dimension is a whole number from 0 to ``SPAN``; rows that agree in it are told apart by a
hash, so a dimension with few values can still be cut anywhere.

The law of these shards is ``bytes``. Copies of a text are separate rows and may fall into
different shards, as else a large group could not be divided.

* Null texts count as empty, null dimensions as the least value; extra columns stay where they are.
* Repeated rows are told apart by the place where they were read, which is written first.
* An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from hireflow.llm.shared import bounded, whole_text, written
from hireflow.session import small_frame

#: Largest value of a dimension, and the bits of the hash that tells equal values apart.
SPAN, TIE_BITS = (1 << 30) - 1, 32

#: Bits of a key by which one pass narrows the search.
STEP_BITS = 12

#: Rows that are numbered together.
SLOT_ROWS = 200_000

#: Bytes that a row counts besides its text.
ROW_BYTES = 16


def size_of(text: Column) -> Column:
    return F.octet_length(whole_text(text)).cast("long") + ROW_BYTES


def category(col: Column) -> Column:
    """A place for each value of a category."""
    return F.pmod(F.xxhash64(F.coalesce(col.cast("string"), F.lit(""))), F.lit(SPAN + 1))


def magnitude(col: Column) -> Column:
    """Places by order of magnitude, up to 2^40."""
    log = F.log2(F.greatest(F.coalesce(col, F.lit(0)), F.lit(0)) + 1)
    return F.least((log / 40 * SPAN).cast("long"), F.lit(SPAN))


def documents_dimensions(text: str = "text") -> dict[str, Column]:
    return {
        "dim_lang": category(F.col("lang")),
        "dim_source": category(F.col("source")),
        "dim_size": magnitude(F.octet_length(whole_text(text))),
    }


def shards(
    rows: DataFrame, size: str, dims: list[str], n_shards: int
) -> DataFrame:
    """``rows`` with shard and slot; ``size`` and ``dims`` name columns of whole numbers."""
    keys = [f"key_{i}" for i in range(len(dims))]
    tie = F.pmod(F.xxhash64(F.lit(1), "row_"), F.lit(1 << TIE_BITS))
    keyed = written(
        rows.select(
            "*",
            F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size_"),
            F.monotonically_increasing_id().alias("row_"),
        ).select(
            "*",
            *[
                (F.coalesce(F.col(d).cast("long"), F.lit(0)) * (1 << TIE_BITS) + tie).alias(k)
                for d, k in zip(dims, keys)
            ],
        ),
        "shard-keys",
    )
    small = keyed.select("size_", *keys)
    cuts: dict[tuple[int, int], tuple[str, int]] = {}
    level = [(0, n_shards)]  # a node: its first shard and its number of shards
    while level := [node for node in level if node[1] > 1]:
        cuts |= _cuts(small.withColumn("node", _leaf((0, n_shards), cuts)), level, keys)
        level = [half for node in level if node in cuts for half in _halves(node)]
    placed = keyed.withColumn("shard", _leaf((0, n_shards), cuts).cast("int"))
    return _numbered(placed, rows.columns)


def _halves(node: tuple[int, int]) -> list[tuple[int, int]]:
    first, n = node
    return [(first, n // 2), (first + n // 2, n - n // 2)]


def _leaf(node: tuple[int, int], cuts: dict[tuple[int, int], tuple[str, int]]) -> Column:
    """First shard of the deepest node that a row is in."""
    if node not in cuts:
        return F.lit(node[0])
    key, point = cuts[node]
    low, high = _halves(node)
    return F.when(F.col(key) >= F.lit(point), _leaf(high, cuts)).otherwise(_leaf(low, cuts))


def _cuts(
    small: DataFrame, level: list[tuple[int, int]], keys: list[str]
) -> dict[tuple[int, int], tuple[str, int]]:
    """Widest key of each node of a level and the least value that goes to its second half."""
    parts = dict(level)
    rows = small.where(F.col("node").isin(list(parts)))
    spread = rows.groupBy("node").agg(
        F.sum("size_").alias("bytes"),
        *[F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(k) for k in keys],
    )
    chosen, low, high, before, goal = {}, {}, {}, {}, {}
    for r in spread.collect():  # one row per node
        node = r["node"]
        key = max(keys, key=lambda k: ((r[k]["high"] - r[k]["low"]) >> TIE_BITS, -keys.index(k)))
        chosen[node], low[node], high[node], before[node] = key, r[key]["low"], r[key]["high"], 0
        goal[node] = r["bytes"] * (parts[node] // 2) // parts[node]

    while open_ := [n for n in chosen if low[n] < high[n]]:
        width = {n: -(-(high[n] - low[n] + 1) >> STEP_BITS) for n in open_}
        search = small_frame(
            small.sparkSession,
            [(n, keys.index(chosen[n]) + 1, low[n], high[n], width[n]) for n in open_],
            _SEARCH,
        )
        bins = (
            rows.join(F.broadcast(search), "node")
            .withColumn("value", F.element_at(F.array(*keys), F.col("dimension")))
            .where("value between low and high")
            .groupBy("node", F.expr("(value - low) div width").alias("bin"))
            .agg(F.sum("size_").alias("bytes"))
        )
        found: dict[int, list] = {}
        for r in bins.collect():  # at most 2^STEP_BITS per node
            found.setdefault(r["node"], []).append((r["bin"], r["bytes"]))
        for node, each in found.items():
            for number, size in sorted(each):
                if before[node] + size > goal[node]:
                    break
                before[node] += size
            low[node] += number * width[node]
            high[node] = min(high[node], low[node] + width[node] - 1)
    return {(n, parts[n]): (chosen[n], low[n]) for n in chosen}


_SEARCH = T.StructType(
    [T.StructField("node", T.IntegerType()), T.StructField("dimension", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("low", "high", "width")]
)


def _numbered(placed: DataFrame, columns: list[str]) -> DataFrame:
    """Adds slots without gaps: a row's number in its group plus the rows in the groups before."""
    groups = max(1, -(-placed.count() // SLOT_ROWS))
    placed = placed.withColumn("group_", F.pmod(F.xxhash64("row_"), F.lit(groups)))
    counts = placed.groupBy("shard", "group_").agg(F.count("*").alias("rows_"))
    earlier = Window.partitionBy("shard").orderBy("group_").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "shard", "group_", F.coalesce(F.sum("rows_").over(earlier), F.lit(0)).alias("first_")
    )
    order = Window.partitionBy("shard", "group_").orderBy("row_")
    return (
        placed.withColumn("number_", F.row_number().over(order))
        .join(bounded(written(first, "shard-groups"), 24), ["shard", "group_"])
        .select(*columns, "shard", (F.col("first_") + F.col("number_") - 1).cast("long").alias("slot"))
    )
