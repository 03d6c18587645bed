"""Pieces and texts against the library on whole texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from hireflow.llm import piece_codec
from hireflow.llm.queries import QUERIES, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "\n", "\n\n a", "  a  b\n\nc ▁x \x00 <s> <0x41> <unk></s>", "▁", "▁▁ a",
    "a" * 2000, " " * 70, "ﬁ é é ½ 日本語 テキスト😀\U0010ffff", "\t\r\x0b\x1c", "The end. Of it, all.",
    "x" * 30000 + "y", "0123456789" * 300, "don't DON'T we'll", "abababab" * 99, "straße ÉTÉ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(library, texts):
    pieces = piece_codec.codec(MODEL)
    flat, counts = pieces.ids(pa.array(texts, pa.string()))
    want = library.encode(texts, num_threads=1)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want
    assert pieces.texts(flat, counts).to_pylist() == [library.decode(ids) for ids in want]


def test_texts(library):
    same(library, TEXTS)
    for text in TEXTS:
        same(library, [text])


def test_joined_pieces(library):
    rng, pieces = random.Random(5), list(piece_codec.codec(MODEL).model.ids)
    same(library, ["".join(rng.choices(pieces, k=rng.randint(1, 30))) for _ in range(4000)])
    letters = [p for p in pieces if len(p) == 1]
    same(library, ["".join(rng.choices(letters[:90], k=rng.randint(1, 80))) for _ in range(2000)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeinrstTh .\n▁é日😀\x00"), max_size=30), min_size=1, max_size=4))
def test_any_text(library, texts):
    same(library, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(259, 31999)), max_size=8), max_size=4))
def test_any_ids(library, rows):
    flat = np.array([i for r in rows for i in r], dtype=np.int32)
    counts = np.array([len(r) for r in rows], dtype=np.int64)
    assert piece_codec.codec(MODEL).texts(flat, counts).to_pylist() == [library.decode(r) for r in rows]


def test_small_memory_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "MEMO_BYTES", 2000)
    same(library, TEXTS)


def test_ids_beyond_the_model():
    with pytest.raises(ValueError):
        piece_codec.codec(MODEL).texts(np.array([32000], np.int32), np.array([1]))


def test_rows(spark, library):
    rows = [(i, t, [7], "k") for i, t in enumerate([None, *TEXTS, *TEXTS[:3]])] + [(None, "a b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, key string")
    got = piece_codec.decoded(piece_codec.encoded(docs, MODEL), MODEL).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, *_ in rows]
    assert sorted(map(repr, ((r.doc_id, list(r.ids), r.text) for r in got))) == sorted(map(repr, want))
    assert piece_codec.encoded(docs.limit(0), MODEL).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in piece_codec.decoded(none, MODEL).collect()] == [(1, [], "")]


def test_query(spark, sf, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_piece_codec"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        )
