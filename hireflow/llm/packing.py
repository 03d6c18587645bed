"""Concatenate and cut: documents one after the other, cut into windows of equal length.

Pass one encodes every document and writes its ids with its offset within the task that read it.
The tasks' totals give each task's first global offset; pass two adds it and cuts every document
where a window ends. A document that crosses window ends yields one record per window; only the
last window is not full.

* Null texts are empty; every document ends with ``END_ID``, so an empty one is that id alone.
* Repeated rows are packed one by one; extra columns are ignored; an empty table gives no rows.
* The order of documents is that of the files. What a task wrote is read again, never recomputed,
  so offsets hold when executors are lost.
* Tasks' totals are one row per task, whatever the number of documents.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from hireflow.llm.shared import bounded, whole_text, written
from hireflow.llm.tokens import WordEnds, encoder, slices

#: Ids in a window.
WINDOW = 2048

#: Id that closes every document.
END_ID = 1

#: Ids are kept as two bytes, which hold all of a vocabulary of up to 65,536.
STORED = "<u2"


def encoded(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every document with the task that read it and the ids before it in that task."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordEnds, tokenizer)
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch):
                flat, lengths = words.ids(part.column("text"))
                ends = np.cumsum(lengths + 1)
                ids = np.full(int(ends[-1]) if ends.size else 0, END_ID, dtype=STORED)
                within = np.ones(ids.size, dtype=bool)
                within[ends - 1] = False
                ids[within] = flat
                edges = pa.array(np.concatenate([[0], ends * 2]), pa.int32())
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(np.full(len(lengths), task), pa.int32()),
                        pa.array(before + ends - lengths - 1, pa.int64()),
                        pa.array(lengths + 1, pa.int64()),
                        pa.Array.from_buffers(
                            pa.binary(), len(lengths), [None, edges.buffers()[1], pa.py_buffer(ids)]
                        ),
                    ],
                    names=["doc_id", "task", "before", "n_ids", "ids"],
                )
                before += int(ends[-1]) if ends.size else 0
            # a worker that waits for its next task holds what its allocator kept
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(encode, "doc_id long, task int, before long, n_ids long, ids binary")


def packed(ids: DataFrame, window: int = WINDOW) -> DataFrame:
    """One record per document and window, with the ids it holds.

    ``ids`` must be a written table, as its tasks' numbers are what offsets rest on.
    """
    totals = ids.groupBy("task").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("task", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("first"))
    placed = ids.join(bounded(written(first, "pack-totals"), 16), "task").select(
        "doc_id", (F.col("first") + F.col("before")).alias("at"), "n_ids", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                yield pieces(part, window)

    return placed.mapInArrow(
        cut,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids binary",
    )


_PIECE = pa.schema(
    [
        (name, pa.int64())
        for name in (
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        )
    ]
    + [("ids", pa.binary())]
)


def pieces(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Records of some documents (doc_id, at, n_ids, ids), cut where windows end."""
    rows: list[tuple] = []
    for doc, at, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
        begin = 0
        while begin < n:
            sequence, offset = divmod(at + begin, window)
            length = min(window - offset, n - begin)
            piece = ids[2 * begin : 2 * (begin + length)]
            crc = zlib.crc32(np.frombuffer(piece, STORED).astype("<u4").tobytes())
            rows.append((doc, begin, length, crc, n, sequence, offset, piece))
            begin += length
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, _PIECE.types)],
        schema=_PIECE,
    )


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Records of all documents, each with its ids; see :func:`sequences` for whole windows."""
    return packed(written(encoded(docs, tokenizer, key, text), "pack-ids"))


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows as bytes (two for each id), with the ids missing in the last one as padding.

    A window has at most ``window`` records, so its group is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(
        ordered, F.lit("").cast("binary"), lambda all_ids, piece: F.concat(all_ids, piece.ids)
    )
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_ids"), ids.alias("ids"))
        .withColumn("padding", F.lit(window) - F.col("n_ids"))
    )
