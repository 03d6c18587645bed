"""Documents whose sets of word shingles are alike, by token-combination prefixes.

Tokens (hashed shingles) are put in one global order, rare ones first. Documents that are alike
share tokens early in that order. From each document a prefix is taken that is long enough for
this: its rare tokens count one each; its frequent tokens are dealt into groups, and of each group
all but one count. It is extended until the count exceeds the tokens that the document may differ
in. Two documents that are alike then share a rare token or two frequent tokens of one group, so
single rare tokens and pairs of frequent ones are what is indexed; frequent tokens alone are not.

How frequent a token is comes from a table of ``BUCKETS`` counters over all documents, whose size
does not depend on the input. Sets are indexed by size class, so group counts fit the size and
sets of very different size never meet.

Copies of a text are one node. Each node is first compared with one centre only, a popular node of its
posting lists. Nodes that are found alike are one component, and after that only pairs across
components are compared: nodes near to one centre by what they differ in from it, others if nothing
settles them. So a large group of copies or near copies costs about one comparison per node. Every
comparison is the exact one of whole sets, but for pairs that a bitmap rules out: each token of a set
flips one of its bits, so sets differ in at least as many tokens as their bitmaps differ in bits.

* Null and empty texts have no shingles and are alike to nothing, not even to each other.
* Texts of fewer words than ``WORDS`` have one shingle, the whole.
* Repeated rows are copies. Ties cannot arise: links are exact and a component has one least id.
* Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hireflow.llm.components import components
from hireflow.llm.shared import bounded, whole_text, written
from hireflow.llm.tokens import slices

#: Words in a shingle.
WORDS = 5

#: Percentage of the union that alike sets share.
ALIKE = 80

#: Counters for frequencies, dealt into rows of ``CHUNK``.
BUCKETS, CHUNK = 1 << 20, 1 << 12

#: A token is frequent if its counter is above this many times the mean counter.
FREQUENT = 2.0

#: Sets below this size index single tokens only; above, tokens in a group of frequent ones.
SMALL = GROUP = 16

#: A bitmap has as many bits as a power of two from twice the size of its set on, these at least.
LEAST_BITS = 512

#: Characters of a batch that are handled at once.
SLICE_CHARS = 3 << 20

#: Counter rows that one task adds up.
FAN_IN = 256

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values, one for each value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of the texts in order, with repeats, and the number of each text."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = words.flatten()
    edges = words.offsets.to_numpy() - words.offsets[0].as_py()
    coded = pc.dictionary_encode(flat)
    keys = np.array(coded.dictionary.to_pylist(), dtype=object)
    hashes = pd.util.hash_array(keys, categorize=False) if keys.size else np.zeros(0, np.uint64)
    index = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter(map(bool, keys), dtype=bool, count=keys.size)[index]
    counts = np.diff(np.concatenate([[0], np.cumsum(real)])[edges])
    value = hashes[index[real]].astype(np.uint64)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = mixed(value) if value.size else value
    width = np.minimum(counts, WORDS)
    room = np.repeat(ends, counts) - np.arange(value.size)  # words from here to the text's end
    with np.errstate(over="ignore"):
        for step in range(1, WORDS):
            more = room > step
            at = np.flatnonzero(more)
            out[at] = mixed(out[at] * _MIX[0] + value[at + step] + np.uint64(step))
    first = np.zeros(value.size, dtype=bool)
    first[starts[counts > 0]] = True
    full = (room >= WORDS) | (first & (np.repeat(width, counts) < WORDS))
    sums = np.concatenate([[0], np.cumsum(full)])
    return out[full], sums[ends] - sums[starts]


def node_of(text: Column) -> Column:
    """Key of a text: 64 bits of its content."""
    return F.xxhash64(F.octet_length(text), text)


def frequencies(docs: DataFrame) -> np.ndarray:
    """Counters of all shingles of ``docs`` (text); a token's counter is its top bits."""
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                tokens, _ = shingles(part.column("text"))
                counts += np.bincount((tokens >> shift).astype(np.int64), minlength=BUCKETS)
        yield rows(TaskContext.get().partitionId(), counts)

    def rows(group: int, counts: np.ndarray) -> pa.RecordBatch:
        chunks = counts.reshape(-1, CHUNK)
        return pa.record_batch(
            [
                pa.array(np.full(len(chunks), group), pa.int32()),
                pa.array(np.arange(len(chunks)), pa.int32()),
                pa.array([c.tobytes() for c in chunks], pa.binary()),
            ],
            names=["task", "chunk", "counts"],
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=np.int64) for c in frame["counts"])
        return frame.head(1).assign(counts=[total.tobytes()])

    schema = "task int, chunk int, counts binary"
    table = written(docs.mapInArrow(count, schema), "shingle-counts")
    while table.select("task").distinct().count() > 1:
        table = written(
            table.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
            .groupBy("task", "chunk")
            .applyInPandas(add, schema),
            "shingle-counts",
        )
    totals = np.zeros(BUCKETS, dtype=np.int64)
    for row in table.collect():  # BUCKETS counters, whatever the input
        totals[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(
            row["counts"], dtype=np.int64
        )
    return totals


def signatures(tokens: np.ndarray, counters: np.ndarray, frequent: float) -> np.ndarray:
    """What is indexed of a set (sorted, distinct), in each size class where it can meet others."""
    n = tokens.size
    if n == 0:
        return tokens
    counts = counters[tokens >> np.uint64(64 - (counters.size.bit_length() - 1))]
    order = np.argsort(counts, kind="stable")
    ranked, often = tokens[order], counts[order] > frequent
    may_differ = n - -(-n * ALIKE // 100)
    out = []
    for level in sorted({size_class(n), size_class(n * 100 // ALIKE)}):
        salt = mixed(np.array([level + 1], dtype=np.uint64))
        if level == 0:
            out.append(mixed(ranked[: may_differ + 1] + salt))
            continue
        group = (ranked % np.uint64((SMALL << (level - 1)) // GROUP)).astype(np.int64)
        counted = np.ones(n, dtype=bool)
        places = np.flatnonzero(often)
        counted[places[np.unique(group[places], return_index=True)[1]]] = False
        length = int(np.searchsorted(np.cumsum(counted), may_differ + 1)) + 1
        prefix, rare = ranked[:length], ~often[:length]
        out.append(mixed(prefix[rare] + salt))
        if not rare.all():
            out.append(mixed(pairs(prefix[~rare], group[:length][~rare]) + salt))
    return np.unique(np.concatenate(out))


def size_class(n: int) -> int:
    """0 below ``SMALL``, then one class for each doubling."""
    return max(0, int(n).bit_length() - SMALL.bit_length() + 1)


def pairs(tokens: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A value for each two tokens of one group."""
    order = np.lexsort((tokens, group))
    tokens, group = tokens[order], group[order]
    found = []
    for step in range(1, tokens.size):
        same = group[:-step] == group[step:]
        if not same.any():
            break
        found.append(mixed(tokens[:-step][same] * _MIX[1]) + tokens[step:][same])
    return np.concatenate(found) if found else tokens[:0]


def indexed(docs: DataFrame, counters: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, node, text) as doc_id, node, n and the signatures."""
    shared = docs.sparkSession.sparkContext.broadcast(counters.astype(np.int64))
    frequent = FREQUENT * float(counters.mean())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                tokens, counts = shingles(part.column("text"))
                sets = [np.unique(t) for t in np.split(tokens, np.cumsum(counts)[:-1])]
                found = [signatures(s, shared.value, frequent) for s in sets]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("node"),
                        pa.array([s.size for s in sets], pa.int64()),
                        ragged_array(found),
                        ragged_array([bitmap(s) for s in sets]),
                    ],
                    names=["doc_id", "node", "n", "signatures", "bitmap"],
                )

    return docs.mapInArrow(
        index, "doc_id long, node long, n long, signatures array<long>, bitmap array<long>"
    )


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bits as 64-bit numbers, each set if an odd number of the distinct tokens falls on it."""
    bits = max(LEAST_BITS, 1 << (2 * tokens.size - 1).bit_length())
    counts = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.uint64)


def ragged_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([p.size for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def token_sets(docs: DataFrame) -> DataFrame:
    """``docs`` (text and other columns) with the distinct tokens in place of the text."""
    schema = T.StructType(
        [f for f in docs.schema if f.name != "text"]
        + [T.StructField("tokens", T.ArrayType(T.LongType()))]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                tokens, counts = shingles(part.column("text"))
                sets = [np.unique(t) for t in np.split(tokens, np.cumsum(counts)[:-1])]
                yield pa.record_batch(
                    [part.column(n) for n in schema.names[:-1]] + [ragged_array(sets)],
                    names=schema.names,
                )

    return docs.mapInArrow(build, schema)


class Sets:
    """Whole sets of nodes, built from the texts when they are needed."""

    def __init__(self, read: DataFrame, rows: DataFrame) -> None:
        self.read = read
        self.firsts = rows.groupBy("node").agg(F.min("doc_id").alias("first"))

    def joined(self, keyed: DataFrame) -> DataFrame:
        """``keyed`` (node and other columns) with the tokens of its nodes.

        One document of a node is read. Few rows are sent to the texts; many meet them by a shuffle.
        """
        wanted = written(keyed.join(self.firsts, "node"), "wanted").withColumnRenamed("node", "of")
        wanted = bounded(wanted, 40)
        same = (self.read["node"] == wanted["of"]) & self.read["doc_id"].eqNullSafe(wanted["first"])
        return token_sets(
            self.read.join(wanted, same).select(*[c for c in wanted.columns if c != "first"], "text")
        ).withColumnRenamed("of", "node")


class Bitmaps:
    """Sizes and bitmaps of all nodes."""

    def __init__(self, rows: DataFrame) -> None:
        each = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap"))
        self.of_nodes = written(each, "bitmaps")

    def _joined(self, pairs: DataFrame, side: str) -> DataFrame:
        """The pairs with size and bitmap of one side; few pairs are sent to the bitmaps."""
        wanted = bounded(written(pairs, "bitmap-pairs"), 256)
        own = self.of_nodes.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bits_{side}")
        )
        return own.join(wanted, side)

    def able(self, pairs: DataFrame, alike: int) -> DataFrame:
        """The pairs (a, b) and whether they may share ``alike`` percent of their union (``able``).

        Sizes of those that may are so close that one bitmap has at most twice the bits of the other;
        its halves laid over each other are the bitmap of its set with half as many bits.
        """
        both = self._joined(self._joined(pairs.select("a", "b"), "a"), "b")
        sizes = [F.size("bits_a"), F.size("bits_b")]

        def folded(bits: str, own: Column, other: Column) -> Column:
            half = F.floor(own / 2).cast("int")
            upper, lower = F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half)
            laid = F.zip_with(upper, lower, lambda x, y: x.bitwiseXOR(y))
            return F.when(own > other, laid).otherwise(F.col(bits))

        apart = F.aggregate(
            F.zip_with(
                folded("bits_a", sizes[0], sizes[1]), folded("bits_b", sizes[1], sizes[0]),
                lambda x, y: F.bit_count(x.bitwiseXOR(y)),
            ),
            F.lit(0),
            lambda total, n: total + n,
        )
        close = 100 * F.least("n_a", "n_b") >= alike * F.greatest("n_a", "n_b")
        within = apart * (100 + alike) <= (F.col("n_a") + F.col("n_b")) * (100 - alike)
        able = close & F.coalesce(within, F.lit(True))
        return both.select("a", "b", F.col("n_a").alias("n"), able.alias("able"))


def with_sets(pairs: DataFrame, sets: Sets) -> DataFrame:
    """The pairs (a, b) with both whole sets and the number of tokens in both."""
    a = sets.joined(pairs.select(F.col("a").alias("node"), "b"))
    b = sets.joined(pairs.select(F.col("b").alias("node")).distinct())
    return (
        a.withColumnsRenamed({"node": "a", "tokens": "tokens_a"})
        .join(b.withColumnsRenamed({"node": "b", "tokens": "tokens_b"}), "b")
        .withColumn("shared", F.size(F.array_intersect("tokens_a", "tokens_b")))
        .withColumn("either", F.size("tokens_a") + F.size("tokens_b") - F.col("shared"))
    )


def alike(pairs: DataFrame, sets: Sets) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    return with_sets(pairs, sets).where(LINKED).select("a", "b").distinct()


#: Whether the sets of a pair are alike, and whether one may be alike to something alike to the
#: other: distances of sets obey the triangle inequality, so twice the distance is allowed.
NEARLY = 2 * ALIKE - 100
LINKED = f"100 * shared >= {ALIKE} * either"
NEAR = f"100 * shared >= {NEARLY} * either"


def fits(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can be alike."""
    return 100 * F.least(n, m) >= ALIKE * F.greatest(n, m)


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, node (the text's key) and component of every document."""
    whole = whole_text(text)
    read = docs.select(F.col(key).cast("long").alias("doc_id"), node_of(whole).alias("node"), whole.alias("text"))
    counters = frequencies(read.select("text"))
    rows = written(indexed(read, counters), "signatures")

    posted = rows.select(F.explode("signatures").alias("signature"), "node", "n")
    # written before they are joined, so that the lists of one signature can be split
    several = posted.groupBy("signature").agg(F.count("*").alias("length")).where("length > 1")
    several = written(several, "signatures-of-several")
    members = written(posted.join(several, "signature").distinct(), "postings")

    sets, bitmaps = Sets(read, rows.select("doc_id", "node")), Bitmaps(rows)
    stars_ = written(stars(members), "star-pairs")
    # sets of very different sizes are not near, nor are those that their bitmaps rule out
    comparable = 100 * F.least("n", "n_b") >= NEARLY * F.greatest("n", "n_b")
    tried = stars_.select("a", "b")
    judged = written(bitmaps.able(stars_.where(comparable), NEARLY), "star-bitmaps")
    apart = stars_.where(~comparable).select("a", "b", "n").unionByName(
        judged.where("not able").select("a", "b", "n")
    )
    measured = written(
        differences(judged.where("able").select("a", "b"), sets).unionByName(
            apart.select(
                "a", "b", "n", F.lit(False).alias("linked"), F.lit(False).alias("near"),
                F.lit(None).cast("array<long>").alias("only"),
            )
        ),
        "differences",
    )
    links = measured.where("linked").select("a", "b")
    labels = components(links)
    for more in (
        lambda found: same_star(measured, found),
        lambda found: across(members, measured, found),
    ):
        found = labelled(members, labels)
        step = written(more(found).join(tried, ["a", "b"], "left_anti"), "pairs")
        able = written(bitmaps.able(step, ALIKE).where("able").select("a", "b"), "able-pairs")
        fresh = written(alike(able, sets), "links")
        tried = tried.unionByName(step)
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            labels = components(links)
    return with_components(rows, labels)


def stars(members: DataFrame) -> DataFrame:
    """(a, b, n, n_b): each node with the centre that it shares the most posting lists with.

    The centre of a list is its most popular node, the one with the longest lists: of many near
    copies, the text that the others were made from.
    """
    popular = members.groupBy("node").agg(F.sum("length").alias("popular"))
    popular = bounded(written(popular, "popular"), 24)
    ranked = members.join(popular, "node").select(
        "signature", F.struct("popular", "node", "n").alias("rank")
    )
    centres = ranked.groupBy("signature").agg(F.max("rank").alias("centre"))
    return (
        ranked.join(written(centres, "centres"), "signature")
        .where("rank <> centre")
        .groupBy(
            F.col("rank.node").alias("a"), F.col("centre.node").alias("b"),
            F.col("rank.n").alias("n"), F.col("centre.n").alias("n_b"),
        )
        .agg(F.count("*").alias("shared"))
        .groupBy("a")
        .agg(F.max_by(F.struct("b", "n", "n_b"), F.struct("shared", "b")).alias("best"))
        .select("a", "best.*")
    )


def differences(pairs: DataFrame, sets: Sets) -> DataFrame:
    """The pairs with whether they are linked or near, and for these the tokens in one set only,
    those of ``a`` first."""
    only = F.concat(
        F.array_except("tokens_a", "tokens_b"), F.array_except("tokens_b", "tokens_a")
    )
    return with_sets(pairs, sets).select(
        "a",
        "b",
        F.size("tokens_a").alias("n"),
        F.expr(LINKED).alias("linked"),
        F.expr(NEAR).alias("near"),
        F.when(F.expr(NEAR), only).alias("only"),
    )


def same_star(measured: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of nodes near to one centre, in different components, that can be alike.

    What two nodes differ in is what they differ in from the centre, without what they share of
    that. A node that is not linked to the centre differs from it in many tokens, so one that is
    alike to it must share most of its own. ``spare`` is how many it need not share; so one of its
    first ``spare + 1`` is among the tokens of the other. Tokens the centre lacks come first; they
    are rare.
    """
    near = measured.where("near").join(found.withColumnRenamed("node", "a"), "a")
    size = F.size("only")
    far_out = near.where("not linked").select(
        F.col("b").alias("star"), F.explode("only").alias("token"),
        F.col("a").alias("u"), F.col("n").alias("n_u"), size.alias("d_u"), F.col("component").alias("c_u"),
    )
    each = near.select(
        F.col("b").alias("star"), F.posexplode("only").alias("rank", "token"),
        F.col("a").alias("s"), F.col("n").alias("n_s"), size.alias("d_s"), F.col("component").alias("c_s"),
    )
    # alike sets differ in at most this share of their sizes' sum
    spare = F.expr(f"(n_u + n_s) * {100 - ALIKE} div {100 + ALIKE} + d_s - d_u")
    met = far_out.join(each, ["star", "token"]).where(
        (F.col("c_u") != F.col("c_s")) & (2 * F.col("rank") <= spare)
    )
    return ordered(met, "u", "s")


def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct pairs as (a, b)."""
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component) of all nodes, those without links being their own component."""
    found = members.select("node").distinct().join(labels, "node", "left")
    return written(found.select("node", F.coalesce("component", "node").alias("component")), "labels")


def across(members: DataFrame, measured: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs in a posting list that can be alike, are in different components and are not settled.

    Settled are two nodes near to one centre (:func:`same_star`), and two of which one is linked to
    the centre and the other not near to it. Nodes of a list's largest component meet the others of
    the list, never one another.
    """
    place = found.join(
        measured.select(F.col("a").alias("node"), F.col("b").alias("star"), "linked", "near"),
        "node",
        "left",
    ).select(
        "node",
        "component",
        F.coalesce("star", "node").alias("star"),
        # a node without a centre is one itself
        F.coalesce("linked", F.lit(True)).alias("linked"),
        F.coalesce("near", F.lit(True)).alias("near"),
    )
    rows = written(members.join(written(place, "places"), "node"), "placed-postings")
    sizes = rows.groupBy("signature", "component").agg(F.count("*").alias("size"))
    largest = (
        sizes.groupBy("signature")
        .agg(F.max(F.struct("size", "component")).alias("largest"), F.count("*").alias("components"))
        .where("components > 1")
        .select("signature", F.col("largest.component").alias("largest"))
    )
    rows = written(rows.join(written(largest, "largest"), "signature"), "mixed-postings")
    x, y = rows.where("component <> largest").alias("x"), rows.alias("y")
    settled = F.expr(
        "x.star = y.star and "
        "(x.near and y.near or x.linked and not y.near or y.linked and not x.near)"
    )
    met = x.join(y, F.expr("x.signature = y.signature")).where(
        F.expr("x.component <> y.component and (y.component = y.largest or x.node < y.node)")
        & fits(F.col("x.n"), F.col("y.n"))
        & ~settled
    )
    return ordered(met, "x.node", "y.node")


def with_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Least document id of every document's component, and the component's own key (null for
    documents without shingles), as ids may be repeated or null."""
    placed = written(
        rows.select("doc_id", "node", "n")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "placed",
    )
    first = placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("first"))
    return placed.join(first, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"),
        "node",
        F.when(F.col("n") > 0, F.col("component")).alias("component"),
    )
