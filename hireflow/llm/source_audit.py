"""How far the sources of a language differ in the words they use.

Terms are runs of letters (signs beyond ASCII count as letters), A to Z lower-cased. A language keeps
the terms that enough of its documents hold.

1. Tasks count in how many documents a term occurs, sum up what they have seen, and shuffle the sums.
2. The kept terms are sorted by language and term; each task turns its range into minimal acyclic
   transducers of at most ``BLOCK_TERMS`` terms. A term's ordinal is its place in its transducer
   plus the terms of its language in earlier ones.
3. The text runs through the transducers once more and is counted by ordinal, so no term that is
   not kept is shuffled, and no kept one as a string.
4. Shares of counts give, per group, its distance to the other groups of its language and the terms
   that set it apart. Ordinals settle ties, as they ascend with the terms' UTF-8.

Transducers reach the tasks in parts of at most ``PART_BYTES`` (one block at least), one pass over
the documents of a part's languages for each part; a block is bounded by its number of terms.
Distances are summed per block of ordinals and pair of tiles of sources, so that a group of rows is
bounded by ``TILE`` and ``COLUMNS`` whatever the size of the corpus.

* Null text, language or source are read as empty. Documents without terms still make their group.
* Repeated rows count as often as they occur. Extra columns are ignored. An empty table gives no rows.
* A language without kept terms has distances of 0 and no terms of its own.
* Very long texts are read whole; a term may be as long as its text.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from hireflow.llm.byte_words import LETTERS, LOWER, SLICE_CHARS, Partial, joined, words_of
from hireflow.llm.shared import bounded, whole_text, written
from hireflow.llm.tokens import slices
from hireflow.llm.transducer import Transducer

#: Documents of its language that must hold a term.
MIN_DOCUMENTS = 10

#: Terms reported for a group.
TOP = 10

#: A share of one.
SCALE = 1_000_000_000

#: Added to every count.
PRIOR = 2

#: Terms of a transducer.
BLOCK_TERMS = 50_000

#: Bytes of transducers that tasks hold at a time.
PART_BYTES = 32 << 20

#: Ordinals and sources compared in one task.
COLUMNS = 4096
TILE = 128


def read_as_empty(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(
        whole_text(F.col(lang).cast("string")).alias("lang"),
        whole_text(F.col(source).cast("string")).alias("source"),
        whole_text(text).alias("text"),
    )


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = pc.dictionary_encode(values)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _terms(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per term its document in the batch and its number, and the distinct terms."""
    words, firsts = words_of(part.column("text"), LETTERS, LOWER)
    index, distinct = _coded(words)
    return np.repeat(np.arange(part.num_rows), np.diff(firsts)), index, distinct


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, n_docs): sums of tasks, not yet of all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Partial(["lang", "term"], "n_docs")
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                doc, term, terms = _terms(part)
                if not len(terms):
                    continue
                lang, langs = _coded(part.column("lang"))
                once = np.unique(doc * len(terms) + term)
                key, n = np.unique(
                    lang[once // len(terms)] * len(terms) + once % len(terms), return_counts=True
                )
                yield from sums.add(
                    {
                        "lang": langs.take(pa.array(key // len(terms))),
                        "term": terms.take(pa.array(key % len(terms))).cast(pa.string()),
                        "n_docs": pa.array(n, pa.int64()),
                    }
                )
        yield from sums.rest()

    return docs.select("lang", "text").mapInArrow(count, "lang string, term string, n_docs long")


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms that enough documents hold."""
    return (
        document_frequencies(docs)
        .groupBy("lang", "term")
        .agg(F.sum("n_docs").alias("n_docs"))
        .where(F.col("n_docs") >= least)
        .select("lang", "term")
    )


def transducers(terms: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per transducer: lang, first_term, base (ordinal of its first term), n_terms, terms
    and the transducer itself."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        of: str | None = None

        def block() -> pa.RecordBatch:
            raw = Transducer.build([t.encode() for t in held]).to_bytes()
            return pa.record_batch(
                [
                    pa.array([of]), pa.array([held[0]]), pa.array([len(held)], pa.int64()),
                    pa.array([held], pa.list_(pa.string())), pa.array([raw], pa.binary()),
                ],
                names=["lang", "first_term", "n_terms", "terms", "transducer"],
            )

        for batch in batches:
            for lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if held and (lang != of or len(held) == block_terms):
                    yield block()
                    held = []
                of = lang
                held.append(term)
        if held:
            yield block()

    rows = (
        terms.repartitionByRange("lang", "term")
        .sortWithinPartitions("lang", "term")
        .mapInArrow(
            build,
            "lang string, first_term string, n_terms long, terms array<string>, transducer binary",
        )
    )
    earlier = (
        Window.partitionBy("lang").orderBy("first_term").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = written(rows, "audit-transducers")
    bases = blocks.select(
        "lang", "first_term", F.coalesce(F.sum("n_terms").over(earlier), F.lit(0)).alias("base")
    )
    return blocks.join(bases, ["lang", "first_term"])


def parts_of(blocks: DataFrame, part_bytes: int = PART_BYTES) -> list[tuple[str, str]]:
    """First and last (lang, first_term) of each part, in order; only sizes reach the driver."""
    sizes = blocks.select(
        "lang", "first_term", F.octet_length("transducer").alias("size")
    ).orderBy("lang", "first_term")
    parts: list[list] = []
    total = 0
    for lang, first, size in sizes.toLocalIterator():
        if not parts or total + size > part_bytes:
            parts.append([(lang, first), (lang, first)])
            total = 0
        parts[-1][1] = (lang, first)
        total += size
    return [tuple(p) for p in parts]


class Forest:
    """The transducers of a part, by language and first term."""

    def __init__(self, rows: list[tuple[str, str, int, bytes]]) -> None:
        self.blocks: dict[str, list[tuple[bytes, int, Transducer]]] = {}
        for lang, first, base, raw in sorted(rows, key=lambda r: (r[0], r[1].encode())):
            held = self.blocks.setdefault(lang, [])
            held.append((first.encode(), base, Transducer.from_bytes(raw)))

    def ordinals(self, lang: str, terms: pa.Array) -> np.ndarray:
        """Ordinal of each term in the language, -1 for those it does not hold here."""
        out = np.full(len(terms), -1, dtype=np.int64)
        blocks = self.blocks.get(lang, [])
        if not blocks or not len(terms):
            return out
        data, edges = joined(terms)
        starts, lengths = edges[:-1], np.diff(edges)
        which = np.zeros(len(terms), dtype=np.int64)
        if len(blocks) > 1:
            fences = np.array([b[0] for b in blocks], dtype=object)
            values = np.array(terms.to_pylist(), dtype=object)
            which = np.searchsorted(fences, values, side="right") - 1
        for i, (_, base, transducer) in enumerate(blocks):
            mine = np.flatnonzero(which == i)
            places = transducer.places(data, starts[mine], lengths[mine])
            out[mine] = np.where(places < 0, -1, places + base)
        return out


def recounted(docs: DataFrame, rows: list[tuple[str, str, int, bytes]]) -> DataFrame:
    """(lang, source, ordinal, n) of the terms in one part's transducers: sums of tasks."""
    held = docs.sparkSession.sparkContext.broadcast(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(held.value)
        sums = Partial(["lang", "source", "ordinal"], "n")
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                doc, term, terms = _terms(part)
                if not len(terms):
                    continue
                lang, langs = _coded(part.column("lang"))
                source, sources = _coded(part.column("source"))
                group = lang * len(sources) + source
                key, n = np.unique(group[doc] * len(terms) + term, return_counts=True)
                group, term = key // len(terms), key % len(terms)
                lang, source = group // len(sources), group % len(sources)
                ordinal = np.full(len(key), -1, dtype=np.int64)
                for i, name in enumerate(langs.to_pylist()):
                    mine = np.flatnonzero(lang == i)
                    distinct, back = np.unique(term[mine], return_inverse=True)
                    ordinal[mine] = forest.ordinals(name, terms.take(pa.array(distinct)))[back]
                hit = np.flatnonzero(ordinal >= 0)
                yield from sums.add(
                    {
                        "lang": langs.take(pa.array(lang[hit])),
                        "source": sources.take(pa.array(source[hit])),
                        "ordinal": pa.array(ordinal[hit]),
                        "n": pa.array(n[hit], pa.int64()),
                    }
                )
        yield from sums.rest()

    return docs.mapInArrow(count, "lang string, source string, ordinal long, n long")


def term_counts(docs: DataFrame, blocks: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(lang, source, ordinal, n) of all kept terms that occur in a group."""
    place = F.struct("lang", "first_term")
    found: DataFrame | None = None
    for first, last in parts_of(blocks, part_bytes):
        low, high = (F.struct(F.lit(x).alias("lang"), F.lit(y).alias("first_term")) for x, y in (first, last))
        rows = (
            blocks.where((place >= low) & (place <= high))
            .select("lang", "first_term", "base", "transducer")
            .collect()
        )
        mine = docs.where(F.col("lang").between(first[0], last[0]))
        some = recounted(mine, [(r.lang, r.first_term, r.base, bytes(r.transducer)) for r in rows])
        found = some if found is None else found.unionByName(some)
    if found is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """``SCALE`` times the count's share, at least 1; exact at any size."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(20,0)")
    below = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language that keeps terms.

    ``shares`` (lang, source, ordinal, p) has the terms a group holds; ``groups`` (lang, source,
    n_terms, p0, tiles) the share of those it does not.
    """
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    blocks = F.sequence(F.lit(0), F.expr(f"(n_terms - 1) div {COLUMNS}"))
    marks = groups.select(
        "lang", "source", F.explode(blocks).alias("block"), F.lit(-1).cast("long").alias("ordinal"),
        F.col("p0").alias("p"), "n_terms", "tiles", tile.alias("tile"),
    )
    held = shares.select(
        "lang", "source", F.expr(f"ordinal div {COLUMNS}").alias("block"), "ordinal", "p", "n_terms",
        "tiles", tile.alias("tile"),
    )
    rows = held.unionByName(marks).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    ).select(
        "lang", "source", "block", "ordinal", "p", "n_terms", "tile",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
    )

    def compare(table: pa.Table) -> pa.Table:
        lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        width = min(COLUMNS, table.column("n_terms")[0].as_py() - block * COLUMNS)
        coded = pc.dictionary_encode(table.column("source").combine_chunks())
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        source, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        ordinal, p = (table.column(c).to_numpy() for c in ("ordinal", "p"))
        matrix = np.empty((len(names), width), dtype=np.int64)
        mark = ordinal < 0
        base = np.zeros(len(names), dtype=np.int64)
        base[source[mark]] = p[mark]
        matrix[:] = base[:, None]
        matrix[source[~mark], ordinal[~mark] - block * COLUMNS] = p[~mark]
        of = np.zeros(len(names), dtype=np.int64)
        of[source] = table.column("tile").to_numpy()
        rows_a, rows_b = np.flatnonzero(of == low), np.flatnonzero(of == high)
        left, right, value = [], [], []
        for i in rows_a:
            others = rows_b[rows_b != i]
            gap = matrix[others] - matrix[i]
            sums = (gap * gap // (matrix[others] + matrix[i])).sum(axis=1)
            left += [i] * len(others)
            right += others.tolist()
            value += sums.tolist()
        if low != high:
            left, right, value = left + right, right + left, value + value
        return pa.table(
            {
                "lang": pa.array([lang] * len(left), pa.string()),
                "source": names.take(pa.array(left, pa.int64())),
                "item": names.take(pa.array(right, pa.int64())),
                "value": pa.array(value, pa.int64()),
            }
        )

    parts = rows.groupBy("lang", "block", "low", "high").applyInArrow(
        compare, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = MIN_DOCUMENTS,
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module's docstring."""
    docs = read_as_empty(docs, text, lang, source)
    blocks = written(transducers(kept_terms(docs, least), block_terms), "audit-blocks")
    counts = written(term_counts(docs, blocks, part_bytes), "audit-counts")
    n_terms = blocks.groupBy("lang").agg(F.sum("n_terms").alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        docs.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(bounded(written(n_terms, "audit-terms"), 64), "lang", "left")
        .select(
            "lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        )
    )
    groups = written(groups, "audit-groups")
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.ceil(F.count("*") / TILE).alias("tiles")
    )
    groups = written(groups.join(langs, "lang"), "audit-totals")
    known = bounded(
        groups.where("n_terms > 0").withColumn(
            "p0", share(F.lit(0), F.col("total"), F.col("n_terms"))
        ),
        192,
    )
    shares = written(
        counts.join(known, ["lang", "source"]).withColumn(
            "p", share(F.col("n"), F.col("total"), F.col("n_terms"))
        ),
        "audit-shares",
    )

    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    usual = shares.join(of_lang, ["lang", "ordinal"]).withColumn(
        "q", share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    marked = (
        usual.where("p > q")
        .select("lang", "source", "ordinal", apart(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )
    names = blocks.select("lang", "base", F.posexplode("terms").alias("at", "item")).select(
        "lang", (F.col("base") + F.col("at")).alias("ordinal"), "item"
    )
    terms = names.join(bounded(written(marked, "audit-marked"), 128), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )

    plain = groups.where("n_terms = 0").select("lang", "source")
    equal = (
        plain.join(plain.withColumnRenamed("source", "item"), "lang")
        .where("source <> item")
        .select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    )
    nearest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(shares, known).unionByName(equal).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(nearest).alias("rank"),
    )
    return pairs.unionByName(terms)
