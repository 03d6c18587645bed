"""Words of many texts at once, by classes of UTF-8 bytes.

All separators in use are ASCII, so a byte alone says whether it belongs to a word.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

#: Characters of a batch that are handled at once; several arrays of this length are held at a time.
SLICE_CHARS = 3 << 20

#: Rows a task sums up before it hands them on.
PARTIAL_ROWS = 400_000


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, set for the bytes in the ranges (ends included)."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))

#: ASCII letters, and all letters and signs beyond ASCII.
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

#: Lower-cases A to Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins and the last ends."""
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or len(texts) == 0 or edges[-1] == edges[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges.astype(np.int64) - edges[0]


def words_of(
    texts: pa.Array, inside: np.ndarray, fold: np.ndarray | None = None
) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of non-null texts one after the other, and the place of each text's first word.

    ``inside`` flags the bytes of words; ``fold`` replaces bytes before.
    """
    data, edges = joined(texts)
    if fold is not None:
        data = fold[data]
    keep = inside[data]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    begins = edges[:-1][edges[:-1] < len(data)]
    first[begins] = keep[begins]
    starts = np.flatnonzero(first)
    rank = np.cumsum(keep, dtype=np.int32)
    offsets = np.empty(len(starts) + 1, dtype=np.int32)
    offsets[:-1] = rank[starts] - 1
    offsets[-1] = rank[-1] if len(rank) else 0
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[keep])]
    )
    return words, np.searchsorted(starts, edges)


class Partial:
    """Sums per key of what a task has seen, handed on when they grow beyond ``limit`` rows."""

    def __init__(self, keys: list[str], value: str, limit: int = PARTIAL_ROWS) -> None:
        self.keys, self.value, self.limit = keys, value, limit
        self.tables: list[pa.Table] = []
        self.rows = 0

    def add(self, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
        self.tables.append(pa.table(columns))
        self.rows += self.tables[-1].num_rows
        if self.rows > 2 * self.limit:
            table = self._summed()
            if table.num_rows > self.limit:
                yield from self._cut(table)
            else:
                self.tables, self.rows = [table], table.num_rows

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.tables:
            yield from self._cut(self._summed())

    def _summed(self) -> pa.Table:
        table = pa.concat_tables(self.tables)
        sums = table.group_by(self.keys, use_threads=False).aggregate([(self.value, "sum")])
        return sums.rename_columns(
            [self.value if n == f"{self.value}_sum" else n for n in sums.column_names]
        ).select([*self.keys, self.value])

    def _cut(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.tables, self.rows = [], 0
        yield from table.combine_chunks().to_batches(max_chunksize=50_000)
