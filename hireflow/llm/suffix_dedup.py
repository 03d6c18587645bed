"""Removal of passages that occur earlier, byte by byte, over all documents.

Every string of ``LENGTH`` bytes that starts anywhere is a suffix cut to that length; a byte goes
if a suffix that covers it also starts earlier. Suffixes are sorted in buckets, and a cover sample
bounds the memory:

* The cover sample has one position in every string of ``LENGTH`` bytes, and the same one in equal
  strings: the first of the least hashed ``KEY``-byte strings inside. So equal suffixes fall into
  the bucket of one sampled key, at one distance from it, and neighbouring suffixes of a bucket
  are kept as one piece of text. About one position in forty is sampled.
* Keys that occur once hold no repeats; only the buckets of the others are built.
* Whole pieces are the ranks of the sample: of equal pieces all but the first are repeats
  throughout, which settles the inside of long passages without comparing suffixes. What is left
  is one piece of each kind, whose suffixes are named and compared bucket by bucket.

Texts are shuffled once, to the sampled positions that belong to them; buckets get one piece for
each kind and task. A kind includes the text around a passage, so a passage that many documents
share in different surroundings has many kinds: keys sampled at more than ``MANY`` positions are not
read as buckets. Their starts are named one by one, and the first of each name is found by an
aggregation that combines before its shuffle, so no key is one group in Python.

* Null and empty texts have no suffixes. Texts shorter than ``LENGTH`` keep all their bytes.
* Order is by document id (null last), then start; rows of one id count as one document.
* Suffixes are judged on the input, so what is removed does not depend on what else is.
* Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hireflow.llm.shared import BROADCAST_BYTES, bounded, whole_text, written

#: Bytes of a string that counts as repeated, and of the keys that sample it.
LENGTH, KEY = 100, 32

#: Bits for a place in a text when keys are compared.
PLACE_BITS = 28

#: Pieces that are compared together, at least.
PIECES = 20_000

#: Bytes of a key in a broadcast.
KEY_BYTES = 32

#: Most positions of a key whose pieces are compared as one bucket.
MANY = 20_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)

#: Place of documents without an id.
LAST = (1 << 63) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the string of ``length`` bytes at every position, from hashes of doubling length."""
    if data.size < length:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        part, power, size = data.astype(np.uint64) + np.uint64(1), _MIX[0], 1
        whole, covered = None, 0
        while True:
            if length & size:
                if whole is None:
                    whole = part
                else:
                    n = whole.size - size
                    whole = whole[:n] * power + part[covered : covered + n]
                covered += size
            if 2 * size > length:
                return mixed(whole)
            part = part[:-size] * power + part[size:]
            power, size = power * power, 2 * size


def sampled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions, their keys, and the first and last start that they stand for.

    Keys are compared by their upper bits and then by place, packed into one number.
    """
    keys = string_hashes(data, KEY)
    width = LENGTH - KEY + 1
    if keys.size < width:
        none = np.zeros(0, dtype=np.int64)
        return none, keys[:0], none, none
    bits = np.uint64(PLACE_BITS if keys.size < 1 << PLACE_BITS else keys.size.bit_length())
    least = (keys >> bits << bits) | np.arange(keys.size, dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if rest := width - size:
        least = np.minimum(least[:-rest], least[rest:])
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], change])
    at = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return at, keys[at], first, np.concatenate([change, [least.size]]) - 1


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint8)


def _read(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = whole_text(text).cast("binary")
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(whole).alias("content"),
        whole.alias("bytes"),
    )


def sample_keys(read: DataFrame) -> DataFrame:
    """(key, doc, at) of all sampled positions."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, places = [], [], []
            for doc, value in zip(batch.column("doc").to_numpy(), batch.column("bytes")):
                at, key, _, _ = sampled(_bytes(value))
                keys.append(key)
                docs.append(np.full(at.size, doc, dtype=np.int64))
                places.append(at)
            if keys:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.concatenate(docs)),
                        pa.array(np.concatenate(places), pa.int64()),
                    ],
                    names=["key", "doc", "at"],
                )

    return read.select("doc", "bytes").mapInArrow(sample, "key long, doc long, at long")


_PIECE = (
    "key long, kind long, before long, piece binary, doc long, content long, at long, "
    "runs array<long>"
)


def pieces(marked: DataFrame) -> DataFrame:
    """Pieces of text of the marked positions, one row per kind and batch with its first place,
    and a row per document with the places and starts that its positions stand for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, texts, runs = [], [], []
            for doc, content, value, places in zip(
                batch.column("doc").to_numpy(),
                batch.column("content").to_numpy(),
                batch.column("bytes"),
                batch.column("places"),
            ):
                data = _bytes(value)
                at, key, first, last = sampled(data)
                wanted = np.flatnonzero(np.isin(at, places.values.to_numpy()))
                at, key, first, last = at[wanted], key[wanted], first[wanted], last[wanted]
                hashes = string_hashes(data, LENGTH)
                # the first and the last string cover the piece
                kind = mixed(hashes[first] * _MIX[0] + (at - first).astype(np.uint64))
                kind = mixed(kind + hashes[last] * _MIX[1] + (last - first).astype(np.uint64))
                block = np.empty((at.size, 6), dtype=np.int64)
                block[:, 0], block[:, 1] = key.view(np.int64), kind.view(np.int64)
                block[:, 2], block[:, 3], block[:, 4] = at - first, doc, at
                block[:, 5] = content
                parts.append(block)
                raw = data.tobytes()
                texts += [raw[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())]
                runs.append(np.column_stack([at, first, last]).ravel())
            if not parts:
                continue
            rows = np.concatenate(parts)
            order = np.lexsort((rows[:, 5], rows[:, 4], rows[:, 3], rows[:, 1], rows[:, 0]))
            same = (rows[order][1:, :2] == rows[order][:-1, :2]).all(axis=1)
            once = order[np.concatenate([[True], ~same])] if order.size else order
            n, m = once.size, batch.num_rows
            nothing = pa.nulls(m, pa.int64())
            yield pa.record_batch(
                [
                    pa.array(rows[once, 0]),
                    pa.array(rows[once, 1]),
                    pa.array(rows[once, 2]),
                    pa.array([texts[i] for i in once], pa.binary()),
                    pa.array(rows[once, 3]),
                    pa.array(rows[once, 5]),
                    pa.array(rows[once, 4]),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                names=_NAMES,
            )
            yield pa.record_batch(
                [
                    nothing, nothing, nothing, pa.nulls(m, pa.binary()),
                    batch.column("doc"), batch.column("content"), nothing,
                    pa.array(runs, pa.list_(pa.int64())),
                ],
                names=_NAMES,
            )

    return marked.mapInArrow(cut, _PIECE)


_NAMES = ["key", "kind", "before", "piece", "doc", "content", "at", "runs"]


def first_places(buckets: DataFrame) -> DataFrame:
    """For the first piece of each kind, the starts in it that also occur earlier.

    Rows come sorted by key, so a bucket is read once and as a whole; only one piece of each kind
    is kept. Keys of more than ``MANY`` positions go to ``first_places_of_many``. ``repeats`` lists
    the first and last start of each run.
    """

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks()
            if rows.num_rows < PIECES:
                continue
            rows, held = _whole_buckets(rows)
            if rows.num_rows:
                yield _resolved(rows)
        if held:
            yield _resolved(pa.Table.from_batches(held).combine_chunks())

    return buckets.mapInArrow(resolve, "doc long, content long, at long, repeats array<long>")


def _whole_buckets(rows: pa.Table) -> tuple[pa.Table, list[pa.RecordBatch]]:
    """The rows of all buckets but the last, and the last one's, one of each kind."""
    key = rows.column("key").to_numpy()
    edge = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
    tail = _first_of_kind(rows.slice(edge))
    return rows.slice(0, edge), tail.to_batches()


def _first_of_kind(rows: pa.Table) -> pa.Table:
    names = ("key", "kind", "doc", "at", "content")
    key, kind, doc, at, content = (rows.column(c).to_numpy() for c in names)
    order = np.lexsort((content, at, doc, kind, key))
    again = (kind[order][1:] == kind[order][:-1]) & (key[order][1:] == key[order][:-1])
    once = order[np.concatenate([[True], ~again])] if order.size else order
    return rows.take(pa.array(np.sort(once))).combine_chunks()


def _named(rows: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The number columns, and of every start of every piece its row, its step and its name."""
    column = {c: rows.column(c).to_numpy() for c in ("key", "before", "doc", "content", "at")}
    piece = rows.column("piece").combine_chunks()
    piece = piece.chunk(0) if isinstance(piece, pa.ChunkedArray) else piece
    edges = np.frombuffer(piece.buffers()[1], np.int32)[piece.offset : piece.offset + len(piece) + 1]
    edges = edges.astype(np.int64)
    data = np.frombuffer(piece.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    names = string_hashes(data, LENGTH)
    starts, counts = edges[:-1] - edges[0], np.diff(edges) - LENGTH + 1
    row = np.repeat(np.arange(counts.size), counts)
    step = np.arange(row.size) - np.repeat(np.cumsum(counts) - counts, counts)
    distance = column["before"][row] - step  # of the start from the key
    with np.errstate(over="ignore"):
        name = mixed(names[starts[row] + step] + column["key"].view(np.uint64)[row] * _MIX[0])
        name = mixed(name + (distance + LENGTH).astype(np.uint64) * _MIX[1])
    return column, row, step, name


def first_places_of_many(found: DataFrame) -> DataFrame:
    """The same for the pieces of keys that have many.

    One row per start, with its name, instead of one group per key. The first place of a name and
    of a kind comes from a minimum, and names of several pieces are joined to written rows, so
    that names that are in many pieces can be split.
    """
    each = found.groupBy("key", "kind").agg(
        F.min(F.struct("doc", "at", "content", "before", "piece")).alias("first")
    )

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column, row, step, names = _named(pa.Table.from_batches([batch]))
            origin = column["at"] - column["before"]
            yield pa.record_batch(
                [
                    pa.array(names.view(np.int64)),
                    *[pa.array(column[c][row]) for c in ("doc", "content", "at")],
                    pa.array(origin[row] + step),
                ],
                names=["name", "doc", "content", "at", "start"],
            )

    starts = each.select("key", "first.*").mapInArrow(
        name, "name long, doc long, content long, at long, start long"
    )
    starts = written(starts, "suffix-starts")
    place = F.struct("doc", "at")
    earliest = (
        starts.groupBy("name")
        .agg(F.min(place).alias("earliest"), F.max(place).alias("latest"))
        .where("earliest != latest")
        .select("name", "earliest")
    )
    judged = starts.join(written(earliest, "suffix-earliest"), "name", "left")
    later = F.col("earliest").isNotNull() & (F.col("earliest") != place)
    return judged.groupBy("doc", "content", "at").agg(
        F.flatten(
            F.collect_list(F.when(later, F.array("start", "start")))
        ).alias("repeats")
    )


def _resolved(rows: pa.Table) -> pa.RecordBatch:
    rows = _first_of_kind(rows)
    column, row, step, name = _named(rows)
    counts = np.bincount(row, minlength=rows.num_rows)
    place = np.lexsort((column["at"], column["doc"]))
    rank = np.empty(place.size, dtype=np.int64)
    rank[place] = np.arange(place.size)  # pieces in the order of documents
    order = np.lexsort((rank[row], name))
    new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    earliest = order[new][np.cumsum(new) - 1]
    later = np.zeros(row.size, dtype=bool)
    earlier_row = row[earliest]
    # two pieces at one place are of rows with one id and are not earlier than one another
    same_place = (column["doc"][earlier_row] == column["doc"][row[order]]) & (
        column["at"][earlier_row] == column["at"][row[order]]
    )
    later[order] = ~same_place
    begin = later & ~np.concatenate([[False], later[:-1] & (row[1:] == row[:-1])])
    end = later & ~np.concatenate([later[1:] & (row[1:] == row[:-1]), [False]])
    origin = column["at"][row] - column["before"][row] + step
    runs = np.column_stack([origin[begin], origin[end]]).ravel()
    per_row = np.bincount(row[begin], minlength=counts.size) * 2
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.record_batch(
        [
            pa.array(column["doc"]),
            pa.array(column["content"]),
            pa.array(column["at"]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(runs, pa.int64())),
        ],
        names=["doc", "content", "at", "repeats"],
    )


def removed_spans(read: DataFrame) -> DataFrame:
    """(doc, content, spans): begin and end of every maximal run of bytes to be removed."""
    several = sample_keys(read).select("key").groupBy("key").count().where("count > 1")
    several = written(several.select("key", (F.col("count") > MANY).alias("many")), "suffix-keys")
    marks = (
        sample_keys(read)
        .join(several.select("key"), "key")
        .groupBy("doc")
        .agg(F.collect_list("at").alias("places"))
    )
    cut = written(pieces(read.join(marks, "doc")), "suffix-pieces")
    found = cut.where("piece is not null").select(
        "key", "kind", "before", "piece", "doc", "content", "at"
    )
    many = several.where("many").select("key")
    n_many = many.count()
    if n_many:
        many = bounded(many, KEY_BYTES, n_many)
        rest = first_places_of_many(found.join(many, "key", "left_semi"))
        found = found.join(many, "key", "left_anti")
    firsts = first_places(found.repartition("key").sortWithinPartitions("key"))
    if n_many:
        firsts = firsts.unionByName(rest)
    firsts = firsts.groupBy("doc", "content").agg(
        F.collect_list(F.struct("at", "repeats")).alias("firsts")
    )
    runs = cut.where("runs is not null").select("doc", "content", "runs").distinct()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for runs, firsts in zip(batch.column("runs"), batch.column("firsts").to_pylist()):
                at, first, last = runs.values.to_numpy().reshape(-1, 3).T
                own = {f["at"]: f["repeats"] for f in firsts or []}
                whole = ~np.isin(at, list(own))
                pairs = [np.column_stack([first[whole], last[whole]])]
                seen = set(at.tolist())
                pairs += [
                    np.array(r, dtype=np.int64).reshape(-1, 2) for a, r in own.items() if a in seen and r
                ]
                spans.append(united(np.concatenate(pairs)))
            yield pa.record_batch(
                [batch.column("doc"), batch.column("content"), pa.array(spans, pa.list_(pa.int64()))],
                names=["doc", "content", "spans"],
            )

    found = runs.join(firsts, ["doc", "content"], "left").mapInArrow(
        unite, "doc long, content long, spans array<long>"
    )
    return written(found.where(F.size("spans") > 0), "suffix-spans")


def united(starts: np.ndarray) -> np.ndarray:
    """Bytes covered by strings from all starts in the ranges, as begin and end of each run."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    starts = starts[np.argsort(starts[:, 0], kind="stable")]
    begin, end = starts[:, 0], np.maximum.accumulate(starts[:, 1] + LENGTH)
    fresh = np.concatenate([[True], begin[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(starts) - 1]])
    return np.column_stack([begin[fresh], end[last]]).ravel()


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256."""
    read = _read(docs, key, text)
    spans = removed_spans(read)
    total = spans.agg(F.coalesce(F.sum(F.size("spans") * 8 + 32), F.lit(0))).first()[0]
    spans = F.broadcast(spans) if total <= BROADCAST_BYTES else spans

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for value, spans in zip(batch.column("bytes"), batch.column("spans")):
                raw = value.as_py()
                if spans.is_valid:
                    edges = [0, *spans.values.to_pylist(), len(raw)]
                    raw = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(raw)
            yield pa.record_batch(
                [
                    batch.column("doc"),
                    pa.array([len(v.as_buffer()) for v in batch.column("bytes")], pa.int64()),
                    pa.array(
                        [len(s.values) // 2 if s.is_valid else 0 for s in batch.column("spans")],
                        pa.int64(),
                    ),
                    pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["doc", "n_bytes", "n_spans", "kept", "kept_sha256"],
            )

    rows = read.join(spans, ["doc", "content"], "left").select("doc", "bytes", "spans")
    rows = rows.mapInArrow(
        keep, "doc long, n_bytes long, n_spans long, kept binary, kept_sha256 string"
    )
    return rows.select(
        F.nullif("doc", F.lit(LAST)).alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        "n_spans",
        "kept",
        "kept_sha256",
    )
