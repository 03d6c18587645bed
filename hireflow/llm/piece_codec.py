"""Merge-type pieces of whole texts, and back, as the ``sentencepiece`` library gives them.

A merge-type model joins the two neighbours with the best score, leftmost first, until none are
left. The same pieces are found without queues, by backtracking:

* Aho-Corasick over the reversed text gives the longest piece that starts at every place.
* The longest piece is taken if it may follow the one before: merging the two pieces' text anew must
  give exactly these two. Otherwise the longest piece that begins it is tried, and so on.
* Where none fits, the place is marked in a bitfield of failed places and the last piece is given
  back. A marked place is never reached again, so the work stays linear.

A sequence whose neighbours are all compatible is the one that merging yields, so the first one that
reaches the end is right.

Two neighbouring characters that no piece holds are never merged, and all texts are cut between
them; pieces of the whole are those of the segments one after the other. Segments repeat far more
often than texts, so a worker keeps the ids of those it has seen (``MEMO_BYTES``, then it starts anew).

* Null texts are empty; an empty text has no ids. Blanks become U+2581, one stands before the text.
* Characters without a piece become the pieces of their bytes. NUL and control characters are text,
  and so are the strings of special pieces.
* A very long text without any cut is one segment; it is encoded whole and not kept.
* Repeated rows are encoded one by one; extra columns are ignored; an empty table gives no rows.
* Decoding: bytes that are no UTF-8 become U+FFFD one by one, control pieces give nothing, the blank
  before the first piece goes.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from hireflow.llm.byte_words import SLICE_CHARS, joined
from hireflow.llm.shared import whole_text
from hireflow.llm.tokens import ragged, slices

#: Stands for a blank in pieces.
BLANK = "▁"

#: Bytes a worker spends on segments, and on pairs of pieces it has compared (an estimate).
MEMO_BYTES = 48 << 20

#: Longer segments are not kept.
MEMO_LENGTH = 64


class PieceModel:
    """Pieces, scores and ids of a model file. Raises for models this module does not cover."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, schema.ModelProto.SentencePiece.Type
        plain = (
            model.trainer_spec.model_type == schema.TrainerSpec.ModelType.Value("BPE")
            and model.trainer_spec.byte_fallback
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not spec.precompiled_charsmap
            and not model.trainer_spec.treat_whitespace_as_suffix
        )
        normal, byte = kinds.Value("NORMAL"), kinds.Value("BYTE")
        control, unknown = kinds.Value("CONTROL"), kinds.Value("UNKNOWN")
        if not plain or any(p.type not in (normal, byte, control, unknown) for p in model.pieces):
            raise ValueError("only plain merge-type models with byte pieces and no charsmap")
        self.size = len(model.pieces)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == normal}
        self.texts = [p.piece if p.type == normal else "" for p in model.pieces]
        self.scores = {p.piece: p.score for p in model.pieces if p.type == normal}
        self.bytes = np.zeros(256, dtype=np.int32)
        self.surface: list[bytes] = []
        self.silent = np.zeros(self.size, dtype=bool)
        self.raw = np.zeros(self.size, dtype=bool)
        for i, p in enumerate(model.pieces):
            if p.type == byte:
                value = int(p.piece[1:-1], 16)
                self.bytes[value], self.raw[i] = i, True
                self.surface.append(bytes([value]))
            elif p.type == control:
                self.silent[i] = True
                self.surface.append(b"")
            elif p.type == unknown:
                self.surface.append(model.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(p.piece.replace(BLANK, " ").encode())


class Backtracker:
    """Pieces of one segment, all of whose characters are pieces."""

    def __init__(self, model: PieceModel) -> None:
        import ahocorasick

        self.ids, self.scores, self.texts = model.ids, model.scores, model.texts
        self.matcher = ahocorasick.Automaton()
        self.shorter = np.full(model.size, -1, dtype=np.int64).tolist()
        for piece, i in self.ids.items():
            self.matcher.add_word(piece[::-1], i)
            for n in range(len(piece) - 1, 0, -1):
                if piece[:n] in self.ids:
                    self.shorter[i] = self.ids[piece[:n]]
                    break
        self.matcher.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merge a short text step by step."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging gives just these two pieces (or the piece alone, -1 before)."""
        known = self.compatible.get((before, piece))
        if known is None:
            if len(self.compatible) * 150 > MEMO_BYTES:
                self.compatible.clear()
            wanted = [self.texts[piece]] if before < 0 else [self.texts[before], self.texts[piece]]
            known = self.compatible[before, piece] = self.merged("".join(wanted)) == wanted
        return known

    def longest(self, segment: str) -> list[int]:
        """The longest piece that starts at each place."""
        n = len(segment)
        out = [-1] * n
        for end, piece in self.matcher.iter(segment[::-1]):
            start = n - 1 - end
            if out[start] < 0 or len(self.texts[piece]) > len(self.texts[out[start]]):
                out[start] = piece
        return out

    def encode(self, segment: str) -> list[int]:
        whole = self.ids.get(segment)
        if whole is not None and self.fits(-1, whole):
            return [whole]
        n, longest, texts = len(segment), self.longest(segment), self.texts
        failed = bytearray(n // 8 + 1)  # one bit for each place
        out: list[int] = []
        at, piece = 0, longest[0]
        while True:
            end = at + len(texts[piece])
            before = out[-1] if out else -1
            if not failed[end >> 3] & (1 << (end & 7)) and self.fits(before, piece):
                out.append(piece)
                at = end
                if at == n:
                    return out
                piece = longest[at]
            elif self.shorter[piece] >= 0:
                piece = self.shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(texts[piece])


class PieceCodec:
    """Ids of texts and texts of ids for one model file."""

    def __init__(self, path: str) -> None:
        self.model = PieceModel(path)
        self.backtracker = Backtracker(self.model)
        letters = sorted({c for piece in self.model.ids for c in piece})
        if any(c not in self.model.ids for c in letters):
            raise ValueError("every character of a piece must be a piece")
        # classes of characters; 0 for those without a piece
        self.classes = np.zeros(0x110000, dtype=np.int32)
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        side = self.side = len(letters) + 1
        self.inside = np.zeros(side * side, dtype=bool)
        of = {c: i for i, c in enumerate(letters, 1)}
        pairs = {(a, b) for piece in self.model.ids for a, b in zip(piece, piece[1:])}
        self.inside[[of[a] * side + of[b] for a, b in pairs]] = True
        first = [
            s[1:] if text and s.startswith(b" ") else s
            for s, text in zip(self.model.surface, self.model.texts)
        ]
        self.lengths = np.array([len(s) for s in (*self.model.surface, *first)], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.surfaces = np.frombuffer(b"".join((*self.model.surface, *first)), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, np.ndarray] = {}
        self.spent = 0

    def segments(self, texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray]:
        """Segments of normalised texts one after the other, and each text's first one."""
        data, edges = joined(texts)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        signs = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self.classes[signs]
        cut = np.ones(len(signs), dtype=bool)
        cut[1:] = ~self.inside[kind[:-1] * self.side + kind[1:]]
        begins = edges[:-1][edges[:-1] < len(data)]
        cut[np.searchsorted(heads, begins)] = True
        starts = heads[cut]
        offsets = np.append(starts, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )
        return found, np.searchsorted(starts, edges)

    def _of(self, segment: bytes) -> np.ndarray:
        ids = self.known.get(segment)
        if ids is None:
            text = segment.decode()
            if text[0] in self.model.ids:
                ids = np.array(self.backtracker.encode(text), dtype=np.int32)
            else:
                ids = self.model.bytes[np.frombuffer(segment, np.uint8)]
            if len(segment) <= MEMO_LENGTH:
                self.spent += 250 + len(segment) + ids.nbytes
                if self.spent > MEMO_BYTES:
                    self.clear()
                self.known[segment] = ids
        return ids

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of non-null texts, and the number of ids of each."""
        blanks = pc.replace_substring(texts, " ", BLANK)
        some = pc.greater(pc.binary_length(texts), 0)
        normal = pc.if_else(some, pc.binary_join_element_wise(BLANK, blanks, ""), blanks)
        segments, firsts = self.segments(normal)
        coded = pc.dictionary_encode(segments)
        index = coded.indices.to_numpy(zero_copy_only=False)
        each = [self._of(s) for s in coded.dictionary.to_pylist()]
        counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        if not each:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts = np.cumsum(counts) - counts
        per_segment = counts[index]
        flat = np.concatenate(each)[ragged(starts[index], per_segment)]
        sums = np.concatenate([[0], np.cumsum(per_segment)])
        return flat, np.diff(sums[firsts])

    def texts(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of rows of ids."""
        if flat.size and not (0 <= int(flat.min()) and int(flat.max()) < self.model.size):
            raise ValueError("ids beyond the model")
        ends = np.cumsum(counts)
        rows = np.flatnonzero(counts)
        variant = flat.astype(np.int64)
        variant[(ends - counts)[rows]] += self.model.size
        lengths = self.lengths[variant]
        data = self.surfaces[ragged(self.starts[variant], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        edges = sums[np.concatenate([[0], ends])]
        special = self.model.silent[flat] if flat.size else np.zeros(0, bool)
        try:
            valid = not special.any() and data.tobytes().decode("utf-8") is not None
        except UnicodeDecodeError:
            valid = False
        if not valid:
            each = np.split(flat, ends[:-1]) if len(counts) else []
            return pa.array([self.text(ids.tolist()) for ids in each], pa.string())
        offsets = pa.py_buffer(edges.astype(np.int32))
        return pa.Array.from_buffers(pa.string(), len(counts), [None, offsets, pa.py_buffer(data)])

    def text(self, ids: list[int]) -> str:
        """Text of any ids; a run of byte pieces is read as UTF-8."""
        model, out, run, first = self.model, [], bytearray(), True

        def flush() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + n]).decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                at += n
            run.clear()

        for i in ids:
            if model.raw[i]:
                run += model.surface[i]
                first = False
                continue
            flush()
            if model.silent[i]:
                continue
            surface = model.surface[i].decode()
            known = model.texts[i] != ""
            out.append(surface[1:] if first and known and surface.startswith(" ") else surface)
            first = False
        flush()
        return "".join(out)


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The worker's codec of a model file."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, pa.int32()))


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ids of every text."""
    source = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in batches:
            for part in slices(batch, chars=SLICE_CHARS):
                ids = _lists(*pieces.ids(part.column("text")))
                yield pa.record_batch([part.column("key"), ids], names=["key", "ids"])

    return source.mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ids and their text; null ids are none."""
    none = F.array().cast("array<int>")
    source = rows.select(F.col(key).alias("key"), F.coalesce(F.col(ids), none).alias("ids"))
    kind = source.schema["key"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in batches:
            lists = batch.column("ids")
            edges = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]]
            for a, b in _row_slices(edges):
                part = flat[edges[a] - edges[0] : edges[b] - edges[0]]
                text = pieces.texts(part, np.diff(edges[a : b + 1]).astype(np.int64))
                yield pa.record_batch(
                    [batch.column("key")[a:b], lists[a:b], text], names=["key", "ids", "text"]
                )

    return source.mapInArrow(
        decode, f"key {kind}, ids array<int>, text string"
    ).withColumnRenamed("key", key)


def _row_slices(edges: np.ndarray, ids: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows with a bounded number of ids, at least one row each."""
    rows = len(edges) - 1
    part = (edges[:-1].astype(np.int64) - int(edges[0])) // ids
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if rows else np.zeros(0, int)
    for a, b in zip(starts, [*starts[1:], rows]):
        yield int(a), int(b)


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)
