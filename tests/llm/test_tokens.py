"""Ids and counts word by word against the library on whole texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hireflow.llm import packing, token_cache
from hireflow.llm.queries import QUERIES, tokenizer_path
from hireflow.llm.tokens import SpacedWords, WordEnds, encoder, slices

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")

TEXTS = [
    "", " ", "\n", "\n\n", "a", " a", "  a", "a ", "a\n", "a \n b", "a\n\nb", "\ta", "a\t b", "a\r\nb",
    "The end. Of it, all.", "3.14, e.g. a.b,c ..., x.,y", "don't DON'T we'll 'tis", "x y z",
    "<|endoftext|> a<|endoftext|>.b <|ENDOFTEXT|>", "<|startoftext|>", "J̌ H̱. ǰ",
    "Élan été, ÉTÉ. straße", "a\x00b c. d", "x" * 5000, "日本語 テキスト。 ok", "😀😀 a", "a  b   c.  d\n \n e",
    "\x1c a\x1cb", "É é. Å", "it's.it'S,we'RE", "1,000.50 USD. a1.b2,c", "...a. ,b .c",
]


def whole(path, texts):
    library = Tokenizer.from_file(path)
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def same(texts):
    flat, lengths = encoder(WordEnds, WORDS).ids(pa.array(texts, pa.string()))
    got = [list(x) for x in np.split(flat, np.cumsum(lengths)[:-1])] if texts else []
    assert got == whole(WORDS, texts)
    counts = encoder(SpacedWords, BYTES).counts(pa.array(texts, pa.string()))
    assert list(counts) == [len(x) for x in whole(BYTES, texts)]


def test_texts():
    same(TEXTS)


@pytest.mark.parametrize("text", TEXTS)
def test_each_text(text):
    same([text])


def test_small_memory_gives_the_same(monkeypatch):
    monkeypatch.setattr("hireflow.llm.tokens.MEMO_BYTES", 1500)
    for part in (TEXTS, TEXTS[::-1], TEXTS[5:20]):
        same(part)
        assert all(len(e.memo) < 2000 for e in (encoder(WordEnds, WORDS), encoder(SpacedWords, BYTES)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé.,'s \n\t\x00<|>5́ J"), max_size=14), min_size=1, max_size=4))
def test_any_text(texts):
    same(texts)


def test_memory_of_many_texts():
    """Ids of 24 MB of text are made in parts; arrays of a part stay below 80 MB."""
    texts = pa.record_batch([pa.array(["a few words, " * 20_000] * 92)], names=["text"])
    words = encoder(WordEnds, WORDS)
    words.ids(texts.column("text").slice(0, 1))
    tracemalloc.start()
    for part in slices(texts):
        words.ids(part.column("text"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


def test_counting_takes_small_parts(monkeypatch):
    """Counts of 6 MB of text are made in parts of little more than a megabyte, and stay those of whole texts."""
    texts = pa.array(["word " * 5000 + "end"] * 240)
    batch = pa.record_batch([texts, texts], names=["content_digest", "text"])
    sizes, counts = [], SpacedWords.counts

    def measured(self, part):
        sizes.append(sum(map(len, part.to_pylist())))
        return counts(self, part)

    monkeypatch.setattr(SpacedWords, "counts", measured)
    got = [n for part in token_cache.counted([batch], BYTES) for n in part.column("n_tokens").to_pylist()]
    assert got == [len(whole(BYTES, [texts[0].as_py()])[0])] * 240
    assert sum(sizes) == 240 * 25003 and max(sizes) < 1.1 * (1 << 20)


def test_counts_through_the_cache(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate([None, *TEXTS, *TEXTS[:5]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    cache = token_cache.TokenCache(spark, str(tmp_path), BYTES)
    want = {i: len(whole(BYTES, [t or ""])[0]) for i, t, _ in rows}
    for _ in range(2):
        got = token_cache.token_counts(docs, cache).collect()
        assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(rows)
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
        assert spark.read.parquet(cache.path).count() == len(set(TEXTS))
    more = docs.limit(0)
    assert token_cache.token_counts(more, cache).count() == 0
    cache.fill(spark.createDataFrame([("a new one",), ("a",)], "text string"))
    assert spark.read.parquet(cache.path).count() == len(set(TEXTS)) + 1


def test_packing(spark):
    texts = [None, "", *TEXTS, "word " * 5000, *TEXTS]
    docs = spark.createDataFrame(
        [(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, task int"
    ).repartition(3)
    pieces = packing.pack(docs, WORDS)
    got = pieces.collect()
    want = {i: [*ids, packing.END_ID] for i, ids in enumerate(whole(WORDS, [t or "" for t in texts]))}
    seen = {i: [] for i in want}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(r.ids, packing.STORED)
        assert r.start == len(seen[r.doc_id]) and r.length == len(ids) and r.doc_tokens == len(want[r.doc_id])
        seen[r.doc_id] += list(ids)
    assert seen == want
    windows = packing.sequences(pieces).collect()
    total = sum(map(len, want.values()))
    assert sorted(w.sequence_id for w in windows) == list(range(-(-total // packing.WINDOW)))
    assert sorted(w.n_ids for w in windows)[1:] == [packing.WINDOW] * (len(windows) - 1)
    by_place = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    assert [r.sequence_id * packing.WINDOW + r.offset for r in by_place] == list(
        np.cumsum([0] + [r.length for r in by_place])[:-1]
    )
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def test_queries_against_the_library(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op2_token_counts"](spark, sf).collect()}
    assert counts == {i: len(x) for i, x in zip(docs, whole(BYTES, list(docs.values())))}
    pieces = QUERIES["op10_packing"](spark, sf).collect()
    lengths = {i: len(x) + 1 for i, x in zip(docs, whole(WORDS, list(docs.values())))}
    assert {r.doc_id: r.doc_tokens for r in pieces} == lengths
    assert sum(r.length for r in pieces) == sum(lengths.values())
