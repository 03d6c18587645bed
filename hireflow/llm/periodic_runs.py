"""Runs of words that repeat with a period, and texts without the repetitions.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``LEAST_WORDS`` and ``LEAST_PERIODS`` periods long, which no neighbouring word extends. In terms of
the places i whose word equals the word q further on, it is a gapless stretch of such places.

Periods are taken octave by octave, and a document falls into tiles per octave:

* An octave of periods q in [P, 2P) has a boundary at every multiple of P. A run has at least 2P
  matching places, so two boundaries lie among them and all P places from one to the next match.
  Rolling hashes find the boundaries and periods for which that may hold, for all at once.
* A tile holds ``TILE_WORDS`` words of boundaries (one at least) and the words around them that its
  periods reach. It is solved alone: neighbouring boundaries of one period form a chain; Z-functions
  at the chain's first boundary (backwards) and last one (forwards) say exactly how far it goes, up
  to a boundary further on either side, and check the hashes. Periods whose window repeats with a
  smaller one are left out: no run with that smallest period can hold such a window.
* What a tile finds is an interval of matching places. Intervals that end inside the tile and are too
  short are dropped; the rest are fragments, shuffled by document and period, where those that touch
  are stitched. So a run may cross any number of tiles.

Documents are told apart by key and text; what a document gives depends on nothing else. Documents
with fragments are written with their words, so the runs meet only them again.

* Null and empty texts have no words and no run. Null keys and keys that repeat with other texts are
  kept apart by the text; repeated rows each get their row.
* Extra columns are ignored. An empty table gives no rows. Ties are settled by start, then period.
* A very long text is read by one task; its tiles bound the work in between, and fragments of a chain
  are one row per tile.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from hireflow.llm.byte_words import SLICE_CHARS, SPACED, words_of
from hireflow.llm.shared import whole_text, written
from hireflow.llm.tokens import slices

#: Words of a run, and periods it holds.
LEAST_WORDS = 24
LEAST_PERIODS = 3

#: Boundaries of the first octave lie this far apart; it has all periods below.
FIRST = 8

#: Words whose boundaries make a tile.
TILE_WORDS = 1 << 16

_ODD = np.uint64(0x9E3779B97F4A7C15)


def z_function(word: np.ndarray) -> list[int]:
    """For each place, how many symbols from there equal those from the start."""
    s, n = word.tolist(), len(word)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _repeats_sooner(z: list[int], q: int) -> bool:
    """Whether the first q symbols repeat with a proper divisor of q (z of the same start)."""
    rest, d = q, 2
    while rest > 1:
        if d * d > rest:
            d = rest
        if rest % d == 0:
            if z[q // d] >= q - q // d:
                return True
            while rest % d == 0:
                rest //= d
        d += 1
    return False


class Tile:
    """Boundaries ``low`` <= b < ``high`` of a document for one octave, with the words around."""

    def __init__(self, codes: np.ndarray, step: int, low: int, high: int) -> None:
        self.step, self.low, self.high = step, low, high
        self.begin = max(0, low - step)
        self.end = min(len(codes), high + 4 * step)
        self.words = codes[self.begin : self.end]
        self.top = self.end == len(codes)

    def fragments(self, pairs: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(period, first, end) of matching places, from sorted (period, boundary) rows."""
        if not len(pairs):
            return
        step = self.step
        fresh = np.ones(len(pairs), dtype=bool)
        fresh[1:] = (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 1] != pairs[:-1, 1] + step)
        heads = np.flatnonzero(fresh)
        tails = np.append(heads[1:], len(pairs)) - 1
        chains = sorted(zip(pairs[heads, 1].tolist(), pairs[heads, 0].tolist(), pairs[tails, 1].tolist()))
        at, ahead, sooner = -1, [], {}
        back_at, back = -1, []
        for first, q, last in chains:
            if first != at:
                at, sooner = first, {}
                ahead = self._ahead(first)
            if ahead[q] < step:  # hashes only nominate
                yield from self._plain(first, last, q)
                continue
            if _repeats_sooner(ahead, q):
                continue
            if first != back_at:
                back_at, back = first, self._back(first)
            begin = first - back[q]
            end = first + ahead[q]
            if last > first:
                more = self._ahead(last)[q]
                if more < step or not self._equal(first, last, q):
                    yield from self._plain(first, last, q)
                    continue
                end = last + more
            inside = begin > self.low - step and end < last + 2 * step
            if inside and end - begin < max(LEAST_WORDS - q, (LEAST_PERIODS - 1) * q):
                continue
            yield q, begin, end

    def _ahead(self, b: int) -> list[int]:
        """How far words from b on equal those from b + q on, for each q, over two steps."""
        a = b - self.begin
        window = self.words[a : a + 4 * self.step]
        z = z_function(window)
        return [min(x, 2 * self.step) for x in z] + [0] * (2 * self.step + 1 - len(z))

    def _back(self, b: int) -> list[int]:
        """How far words before b equal those before b + q, for each q, over one step."""
        a, step = b - self.begin, self.step
        before = self.words[max(0, a - step) : a][::-1]
        around = self.words[max(0, a - step) : a + 2 * step][::-1]
        z = z_function(np.concatenate([before, [-1], around]))
        n = len(before) + 1 + len(around)
        # the words before b + q begin, reversed, where q of them follow b
        over = len(self.words[a : a + 2 * step])
        out = [0] * (2 * step + 1)
        for q in range(1, min(over, 2 * step) + 1):
            place = len(before) + 1 + over - q
            out[q] = min(z[place], len(before)) if place < n else 0
        return out

    def _equal(self, first: int, last: int, q: int) -> bool:
        a, b = first - self.begin, last - self.begin
        return bool((self.words[a:b] == self.words[a + q : b + q]).all())

    def _plain(self, first: int, last: int, q: int) -> Iterator[tuple[int, int, int]]:
        """Stretches of a chain that a hash joined wrongly."""
        low, high = max(self.begin, first - self.step), min(self.end - q, last + 2 * self.step)
        a, b = low - self.begin, high - self.begin
        equal = np.concatenate([[False], self.words[a:b] == self.words[a + q : b + q], [False]])
        edges = np.flatnonzero(np.diff(equal.astype(np.int8))).reshape(-1, 2)
        for x, y in edges.tolist():
            if y - x >= self.step and not _repeats_sooner(z_function(self.words[a + x : a + x + q]), q):
                yield q, low + x, low + y


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide; mixed in between, so that no sums cancel."""
    h = h[:-width] * _ODD + h[width:]
    h ^= h >> np.uint64(31)
    return h * np.uint64(0x94D049BB133111EB)


def nominated(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per octave, (period, boundary) rows for which all words up to the next boundary may match.

    The first octave takes every period below ``FIRST`` at boundaries ``FIRST`` apart: its runs are
    ``LEAST_WORDS`` long and so have two of them as well.
    """
    n, step = len(codes), FIRST
    if n < LEAST_WORDS:
        return
    with np.errstate(over="ignore"):
        h = codes.astype(np.uint64)
        h = (h + np.uint64(1)) * _ODD
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        width = 1
        while width < step:
            h, width = _doubled(h, width), 2 * width
        bounds = np.arange(0, len(h), step)
        rows = []
        for q in range(1, step):
            here = bounds[bounds + q < len(h)]
            here = here[h[here] == h[here + q]]
            rows.append(np.stack([np.full(len(here), q), here], axis=1))
        yield 0, np.concatenate(rows)
        while LEAST_PERIODS * step <= n:
            x = np.arange(step, len(h))
            bound = (x // step - 1) * step
            hit = np.flatnonzero(h[step:] == h[bound])
            rows = np.stack([x[hit] - bound[hit], bound[hit]], axis=1)
            yield step, rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            if len(h) <= step:
                return
            h, step = _doubled(h, step), 2 * step


def fragments(codes: np.ndarray, tile_words: int = TILE_WORDS) -> list[tuple[int, int, int]]:
    """(period, first, end) of matching places in a document's words, tile by tile."""
    out: list[tuple[int, int, int]] = []
    for octave, pairs in nominated(codes):
        if not len(pairs):
            continue
        step = octave or FIRST
        tile = max(1, tile_words // step) * step
        which = pairs[:, 1] // tile
        for t in np.unique(which).tolist():
            mine = Tile(codes, step, t * tile, (t + 1) * tile)
            out += mine.fragments(pairs[which == t])
    return out


FOUND = "key {kind}, digest binary, n_words long, plain_sha256 string, words string, found array<struct<period:long,first:long,end:long>>"


def found_fragments(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: its words joined by blanks if it has fragments, and those."""
    source = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    found = pa.list_(
        pa.struct([("period", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                words, firsts = words_of(part.column("text"), SPACED)
                coded = pc.dictionary_encode(words)
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                text = words.cast(pa.string())
                lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), text)
                joint = pc.binary_join(lists, " ")
                plain = joint.to_pylist()
                each = [fragments(codes[a:b]) for a, b in zip(firsts[:-1], firsts[1:])]
                raw = [p.encode() for p in plain]
                yield pa.record_batch(
                    [
                        part.column("key"),
                        pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                        pa.array(np.diff(firsts), pa.int64()),
                        pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                        pa.array([p if e else None for p, e in zip(plain, each)], pa.string()),
                        pa.array(
                            [[dict(zip(("period", "first", "end"), f)) for f in e] for e in each], found
                        ),
                    ],
                    names=["key", "digest", "n_words", "plain_sha256", "words", "found"],
                )

    return source.mapInArrow(find, FOUND.format(kind=kind))


def stitched(pieces: DataFrame) -> DataFrame:
    """(key, digest, start, length, period) of runs, from fragments (key, digest, period, first, end)."""
    by = ["key", "digest", "period"]
    order = Window.partitionBy(*by).orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") <= F.col("before"), 0).otherwise(1)
    islands = (
        pieces.distinct()
        .withColumn("before", before)
        .withColumn("island", F.sum(fresh).over(order))
        .groupBy(*by, "island")
        .agg(F.min("first").alias("start"), F.max("end").alias("end"))
    )
    length = F.col("end") - F.col("start") + F.col("period")
    return islands.select("key", "digest", "start", length.alias("length"), "period").where(
        (F.col("length") >= LEAST_WORDS) & (F.col("length") >= LEAST_PERIODS * F.col("period"))
    )


def collapsed(words: DataFrame) -> DataFrame:
    """``kept``: the words (joined by blanks) that no run holds after its first period."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("words")[i].as_py().split(" ")
                kept = np.ones(len(text), dtype=bool)
                for run in batch.column("runs")[i].as_py():
                    kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
                left = " ".join(w for w, k in zip(text, kept) if k)
                yield pa.record_batch(
                    [*(batch.column(c)[i : i + 1] for c in ("key", "digest", "runs")), pa.array([left])],
                    names=["key", "digest", "runs", "kept"],
                )

    kind = words.schema["key"].dataType.simpleString()
    return words.select("key", "digest", "words", "runs").mapInArrow(
        drop,
        f"key {kind}, digest binary, runs array<struct<start:long,period:long,length:long>>, kept string",
    )


def periodic(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words, runs (start, period, length; by start, then period), best (the run of most
    periods, null without runs), kept (words that stay, null without runs) and kept_sha256."""
    base = written(found_fragments(docs, key, text), "runs-found")
    # rows that are alike find the same, once is enough
    with_some = base.where("size(found) > 0").dropDuplicates(["key", "digest"])
    with_some = written(with_some.select("key", "digest", "words", "found"), "runs-suspects")
    pieces = with_some.select("key", "digest", F.inline("found"))
    runs = (
        stitched(pieces)
        .groupBy("key", "digest")
        .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )
    runs = written(runs, "runs-stitched").withColumnsRenamed({"key": "run_key", "digest": "run_digest"})
    same = F.col("key").eqNullSafe(F.col("run_key")) & (F.col("digest") == F.col("run_digest"))
    left = written(collapsed(with_some.join(runs, same)), "runs-collapsed").select(
        F.col("key").alias("run_key"), F.col("digest").alias("run_digest"), "runs", "kept",
        F.sha2(F.col("kept").cast("binary"), 256).alias("run_sha256"),
    )
    rows = base.select("key", "digest", "n_words", "plain_sha256").join(left, same, "left")
    none = F.array().cast("array<struct<start:long,period:long,length:long>>")
    return rows.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("runs", none).alias("runs"),
        best(F.col("runs")).alias("best"),
        "kept",
        F.coalesce("run_sha256", "plain_sha256").alias("kept_sha256"),
    )


def best(runs: Column) -> Column:
    """The run of the greatest length / period, compared by cross products; first by start, then period."""

    def more(run: Column, than: Column) -> Column:
        left = run["length"].cast("decimal(19,0)") * than["period"].cast("decimal(19,0)")
        right = than["length"].cast("decimal(19,0)") * run["period"].cast("decimal(19,0)")
        return left > right

    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda held, run: F.when(more(run, held), run).otherwise(held))
