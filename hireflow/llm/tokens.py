"""Token ids of whole texts, word by word, as the ``tokenizers`` library gives them.

Both tokenizer kinds used here split a text into words before merging, so the ids of a text are
the ids of its words one after the other. Words repeat far more often than texts; a worker keeps
the ids of those it has seen (``MEMO_BYTES`` of them, then it starts anew).
"""

from __future__ import annotations

import os
from typing import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker spends on words and their ids. Looking words up takes three times as much for a while.
MEMO_BYTES = 24 << 20

#: Longer words are encoded when they come and not kept.
MEMO_CHARS = 48

#: Plain words encoded in one call.
JOINED = 4000

#: Characters of a batch that are handled at once; a worker needs some thirty bytes for each.
SLICE_CHARS = 4 << 20

def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    indices = np.repeat(starts - (ends - lengths), lengths)
    indices += np.arange(total)
    return indices


class Memo:
    """Growing table of words and their ids; words are held as one Arrow array, not as objects."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def __len__(self) -> int:
        return len(self.words)

    @property
    def spent(self) -> int:
        """Bytes of the words, where they end, their ids, and where these end."""
        return self.words.nbytes + 8 * len(self.words) + 4 * self.used

    def find(self, words: pa.Array) -> np.ndarray:
        """Place of each word, -1 for new ones."""
        if not len(self.words):
            return np.full(len(words), -1, dtype=np.int64)
        found = pc.index_in(words, value_set=self.words)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n, at = len(self.words), self.used
        while self.flat.size < at + flat.size:
            self.flat = np.resize(self.flat, 2 * self.flat.size)
        while self.ends.size < n + 1 + len(words):
            self.ends = np.resize(self.ends, 2 * self.ends.size)
        self.flat[at : at + flat.size] = flat
        self.ends[n + 1 : n + 1 + len(words)] = at + np.cumsum(lengths)
        self.used = at + flat.size
        self.words = pa.concat_arrays([self.words, pa.array(words, pa.string())])

    def lengths(self, places: np.ndarray) -> np.ndarray:
        return self.ends[places + 1] - self.ends[places]


class WordEncoder:
    """Ids of words for one tokenizer file; subclasses say how a text falls into words.

    A full stop or comma after a letter is always a word of its own, so it is split off here: words
    then repeat more often.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.edge[[i for token, i in vocabulary.items() if self.is_edge(token)]] = True

    def is_edge(self, token: str) -> bool:
        """Whether the token begins or ends a word."""
        raise NotImplementedError

    def run_lengths(self, flat: np.ndarray) -> np.ndarray:
        """Number of ids of each of the words that were encoded as one text."""
        raise NotImplementedError

    def spelled(self, key: str) -> str:
        """The text that a key stands for."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts by the library, and the number of ids of each."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        flat = np.empty(int(lengths.sum()), dtype=np.uint32)
        at = 0
        for ids in got:
            flat[at : at + len(ids)] = ids
            at += len(ids)
        return flat, lengths

    def _learn(self, plain: list[str], rest: list[str]) -> None:
        """Add new words in this order. Plain ones are encoded many at a time, as one text."""
        learned: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(0, len(plain), JOINED):
            some = plain[i : i + JOINED]
            flat, _ = self.encode(["".join(map(self.separate, some))])
            lengths = self.run_lengths(flat)
            if len(lengths) != len(some):
                flat, lengths = self.encode([self.spelled(k) for k in some])
            learned.append((flat, lengths))
        for i in range(0, len(rest), JOINED):
            learned.append(self.encode([self.spelled(k) for k in rest[i : i + JOINED]]))
        if learned:
            flat, lengths = map(np.concatenate, zip(*learned))
            self.memo.add([*plain, *rest], flat, lengths)

    def separate(self, key: str) -> str:
        """A plain word with the blank that keeps it apart."""
        return " " + key

    def places(self, keys: list[str]) -> np.ndarray:
        """Places in the memo of all the (distinct) keys, which are encoded if they are new."""
        if self.memo.spent > MEMO_BYTES:
            self.memo = Memo()
        at, known = self.memo.find(pa.array(keys, pa.string())), len(self.memo)
        new = np.flatnonzero(at < 0)
        is_plain = np.fromiter(
            (keys[i].isalpha() and max(keys[i]) <= "ÿ" for i in new), dtype=bool, count=new.size
        )
        plain, rest = new[is_plain], new[~is_plain]
        self._learn([keys[i] for i in plain], [keys[i] for i in rest])
        at[np.concatenate([plain, rest])] = known + np.arange(new.size)
        return at


class WordEnds(WordEncoder):
    """Tokenizers that lower-case, drop white space and mark the end of a word."""

    def is_edge(self, token: str) -> bool:
        return token.endswith("</w>")

    def run_lengths(self, flat: np.ndarray) -> np.ndarray:
        return np.diff(np.flatnonzero(self.edge[flat]) + 1, prepend=0)

    def spelled(self, key: str) -> str:
        return key

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each."""
        # special tokens keep their case, and a mark may combine with one case of a letter only
        as_is = pc.match_substring_regex(texts, r"<\||\p{M}")
        lower = pc.if_else(as_is, texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(
            pc.replace_substring_regex(lower, "([a-z])([.,])", r"\1 \2")
        )
        coded = pc.dictionary_encode(words.flatten())
        index = coded.indices.to_numpy(zero_copy_only=False)
        ids, lengths = self._of(coded.dictionary.to_pylist())
        starts = np.cumsum(lengths) - lengths
        per_word = lengths[index]
        flat = ids[ragged(starts[index], per_word)] if index.size else ids[:0]
        sums = np.concatenate([[0], np.cumsum(per_word)])
        edges = words.offsets.to_numpy() - words.offsets[0].as_py()
        return flat, np.diff(sums[edges])

    def _of(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.zeros(len(keys), dtype=np.int64)
        short = [i for i, k in enumerate(keys) if k and len(k) <= MEMO_CHARS]
        at = self.places([keys[i] for i in short])
        lengths[short] = self.memo.lengths(at)
        long = {i: self.encode([k])[0] for i, k in enumerate(keys) if len(k) > MEMO_CHARS}
        for i, ids in long.items():
            lengths[i] = ids.size
        flat = np.empty(int(lengths.sum()), dtype=np.uint32)
        starts = np.cumsum(lengths) - lengths
        flat[ragged(starts[short], lengths[short])] = self.memo.flat[
            ragged(self.memo.ends[at], lengths[short])
        ]
        for i, ids in long.items():
            flat[starts[i] : starts[i] + ids.size] = ids
        return flat, lengths


class SpacedWords(WordEncoder):
    """Byte-level tokenizers, for which the white space before a word belongs to it.

    Of a run of white space before a word, the last character is split off; so a text may be cut
    before each blank or line feed that a word follows. A key is such a piece, without its blank;
    keys that start with a line feed or ``BARE`` have none.
    """

    #: Starts the key of a sign that was split off a word. Texts that hold it are not cut.
    BARE = "\x00"

    def is_edge(self, token: str) -> bool:
        return token.startswith("Ġ")

    def run_lengths(self, flat: np.ndarray) -> np.ndarray:
        return np.diff(np.flatnonzero(self.edge[flat]), append=flat.size)

    def spelled(self, key: str) -> str:
        if key.startswith(self.BARE):
            return key[1:]
        return key if key.startswith("\n") else " " + key

    def is_piece(self, key: str) -> bool:
        word = key[1:] if key.startswith(("\n", self.BARE)) else key
        return bool(word) and not word[0].isspace()

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        uncut = pc.match_substring(texts, self.BARE).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring_regex(texts, "([A-Za-z])([.,])", "\\1 \x00\\2")
        pieces = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        coded = pc.dictionary_encode(pieces.flatten())
        edges = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        keys = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        lengths = self._of(keys)[index]
        firsts = edges[:-1]
        heads = [keys[i] for i in index[firsts]]  # the first piece has no blank before it
        lengths[firsts] = self.encode(heads)[1]
        odd = np.add.reduceat(lengths < 0, firsts) > 0 if firsts.size else np.zeros(0, dtype=bool)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        out = np.diff(sums[edges])
        for i in np.flatnonzero(odd & ~uncut):
            out[i] = self._glued([keys[j] for j in index[edges[i] : edges[i + 1]]])
        for i in np.flatnonzero(uncut):
            out[i] = self.encode([texts[int(i)].as_py()])[1][0]
        return out

    def _of(self, keys: list[str]) -> np.ndarray:
        """Ids of each key, -1 for keys that are no pieces."""
        good = np.fromiter(map(self.is_piece, keys), dtype=bool, count=len(keys))
        lengths = np.full(len(keys), -1, dtype=np.int64)
        short = [i for i, k in enumerate(keys) if good[i] and len(k) <= MEMO_CHARS]
        at = self.places([keys[i] for i in short])  # may start a new memo
        lengths[short] = self.memo.lengths(at)
        for i in np.flatnonzero(good & (lengths < 0)):
            lengths[i] = self.encode([self.spelled(keys[i])])[1][0]
        return lengths

    def _glued(self, keys: list[str]) -> int:
        """Ids of a text some of whose pieces are no words and stay with the piece before."""
        first, *rest = keys
        cut = [first]
        for key in rest:
            if self.is_piece(key):
                cut.append(self.spelled(key))
            else:
                cut[-1] += key if key.startswith("\n") else " " + key
        return int(self.encode(cut)[1].sum())


_ENCODERS: dict[tuple[type, str], WordEncoder] = {}


def encoder(kind: type, path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def slices(
    batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS
) -> Iterable[pa.RecordBatch]:
    """Parts of a batch with bounded text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // chars
    edges = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else []
    for a, b in zip(edges, [*edges[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
