"""Benchmark passages in documents, by a prefix-filtered join on shingles.

A benchmark item falls into windows of ``WINDOW`` consecutive words (an item of fewer words is one
window), a window into shingles. A document that contains a window contains all its shingles, so
the overlap that is asked for is the whole window and the necessary prefix of its shingles, ordered
by rarity, is the rarest one. Documents' shingles are joined to these prefixes only. The place of
the shingle in its window gives the only place where the window can start; it must lie inside the
document (length and position bounds), and then its words are compared one by one.

Documents are read twice, once to count how often each shingle of the benchmark occurs, once to
find the windows; no text is shuffled. The benchmark's prefixes are broadcast in parts of bounded
size, so a large benchmark takes more passes, never a larger broadcast.

* Null texts have no words, and a document or item without words is in no window.
* Repeated documents are judged one by one; repeated items count once. Items without an id are
  looked for like others, so their words are hit, but they are not listed among the items.
* Very long texts are read whole.
* Extra columns are ignored. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.llm.shared import BROADCAST_BYTES, ascii_lower, let, whole_text, words_of, written

#: Words in a window.
WINDOW = 10

#: Words in a shingle; a shorter window is one shingle.
SHINGLE = 3

#: Separators: all of ASCII but digits and small letters (after lower-casing).
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Bytes that one window is taken to need in a broadcast.
WINDOW_BYTES = 512


def benchmark_words(text: str = "text") -> Column:
    return words_of(ascii_lower(whole_text(text)), SEPARATORS)


def _shingles(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, by place."""

    def hashes(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))),
            lambda i: F.xxhash64(F.lit(size), *[F.get(w, i + j) for j in range(size)]),
        )
        return F.when(F.size(w) < size, F.array().cast("array<bigint>")).otherwise(each)

    return let(words, hashes)


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of every item with the shingles in them."""
    words = F.col("words")
    items = benchmark.select(
        F.col(item).cast("string").alias("item_id"), benchmark_words(text).alias("words")
    ).where(F.size(words) > 0)
    length = F.least(F.size(words), F.lit(WINDOW))
    start = F.explode(F.sequence(F.lit(1), F.size(words) - length + 1))
    cut = items.select("item_id", "words", length.alias("length"), start.alias("start")).select(
        "item_id", "length", F.slice("words", F.col("start"), F.col("length")).alias("window")
    )
    shingles = reduce(
        lambda rest, size: F.when(F.col("length") == size, _shingles(F.col("window"), size))
        .otherwise(rest),
        range(1, SHINGLE),
        _shingles(F.col("window"), SHINGLE),
    )
    return cut.distinct().withColumn("shingles", shingles)


def _document_shingles(words: Column, sizes: list[int]) -> Column:
    """(place, hash) of all shingles of the sizes, after one mark that every document has."""
    mark = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).cast("long").alias("hash")))
    parts = [
        F.transform(
            _shingles(words, size), lambda h, i: F.struct(i.alias("place"), h.alias("hash"))
        )
        for size in sizes
    ]
    return F.concat(mark, *parts)


def rarest(found: DataFrame, seen: DataFrame) -> DataFrame:
    """The windows with the hash and the place of their rarest shingle."""
    each = found.select(
        "item_id", "length", "window", F.posexplode("shingles").alias("shift", "hash")
    )
    order = F.struct(F.coalesce("n", F.lit(0)), "hash", "shift")
    return (
        each.join(seen, "hash", "left")
        .groupBy("item_id", "length", "window")
        .agg(F.min_by(F.struct("hash", "shift"), order).alias("first"))
        .select("item_id", "length", "window", "first.hash", "first.shift")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``keep`` and n_words, n_hit, items (sorted) and spans (of words) of every document."""
    found = written(windows(benchmark, item, item_text), "benchmark-windows")
    sizes = [r[0] for r in found.select(F.least("length", F.lit(SHINGLE))).distinct().collect()]
    read = docs.select(
        *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        F.monotonically_increasing_id().alias("row"),
        benchmark_words(text).alias("words"),
    )
    read = read.withColumn("shingles", _document_shingles(F.col("words"), sorted(sizes)))

    wanted = found.select(F.explode("shingles").alias("hash")).distinct()
    parts = _parts(written(wanted, "benchmark-shingles"), 64)
    shingle = read.select(F.explode("shingles").alias("at")).select("at.hash")
    counts = [shingle.join(F.broadcast(p), "hash").groupBy("hash").count() for p in parts]
    seen = reduce(DataFrame.unionByName, counts).select("hash", F.col("count").alias("n"))

    prefixes = written(rarest(found, seen), "benchmark-prefixes")
    matches = [_matches(read, p) for p in _parts(prefixes, WINDOW_BYTES)]
    kept = [f"keep_{i}" for i in range(len(keep))]
    span = F.when(F.col("end") > 0, F.struct("begin", "end"))
    rows = (
        reduce(DataFrame.unionByName, matches)
        .groupBy("row", *kept, "n_words")
        .agg(
            F.sort_array(F.collect_set(span)).alias("spans"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
    )
    return rows.select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep)],
        "n_words",
        _covered(F.col("spans")).alias("n_hit"),
        "items",
        "spans",
    )


def _matches(read: DataFrame, prefixes: DataFrame) -> DataFrame:
    """A row for every document, and one for each window found in it.

    Exploding, joining and comparing run in one stage, so only matches leave it.
    """
    mark = prefixes.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("item_id"),
        F.lit(0).alias("length"),
        F.array().cast("array<string>").alias("window"),
        F.lit(0).cast("long").alias("hash"),
        F.lit(-1).alias("shift"),
    )
    windows = prefixes.select(*mark.columns).unionByName(mark)
    kept = [c for c in read.columns if c not in ("words", "shingles")]
    places = read.select(
        *kept, "words", F.size("words").alias("n_words"), F.explode("shingles").alias("at")
    )
    begin = places.at.place - windows.shift
    inside = (begin >= 0) & (begin + windows.length <= places.n_words)
    equal = F.array_join(
        F.slice(places.words, F.when(inside, begin).otherwise(0) + 1, windows.length), " "
    ) == F.array_join(windows.window, " ")
    is_mark = (places.at.place == -1) == (windows.length == 0)
    return places.join(
        F.broadcast(windows), (places.at.hash == windows.hash) & is_mark & inside & equal
    ).select(*kept, F.col("n_words").cast("long").alias("n_words"),
             begin.alias("begin"), (begin + windows.length).alias("end"), "item_id")


def _parts(df: DataFrame, row_bytes: int) -> list[DataFrame]:
    """``df`` in parts small enough to broadcast."""
    n = max(1, -(-df.count() * row_bytes // BROADCAST_BYTES))
    part = F.pmod(F.xxhash64("hash"), F.lit(n))
    return [df.where(part == i) for i in range(n)] if n > 1 else [df]


def _covered(spans: Column) -> Column:
    """Words in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans,
        start,
        lambda have, s: F.struct(
            (have.words + F.greatest(s.end - F.greatest(s.begin, have.upto), F.lit(0)))
            .cast("long")
            .alias("words"),
            F.greatest(s.end, have.upto).alias("upto"),
        ),
        lambda have: have.words,
    )
