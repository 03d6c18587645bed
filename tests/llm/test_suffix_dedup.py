"""Removed bytes against a search of every string."""

import hashlib
import random

import numpy as np
import pytest

from hireflow.llm import suffix_dedup as op
from hireflow.llm.queries import QUERIES


def brute(docs):
    """{doc: (n_bytes, n_removed, n_spans, sha256)} by looking up every string."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - op.LENGTH + 1):
            s = data[p : p + op.LENGTH]
            if s in seen:
                gone[p : p + op.LENGTH] = b"\1" * op.LENGTH
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def made(seed):
    pick = random.Random(seed)
    letters = "ab " if seed % 2 else "abcdefghijklmnopqrstuvwxyzé "

    def text(n):
        return "".join(pick.choice(letters) for _ in range(n))

    shared = [text(n) for n in (99, 100, 101, 150, 400)]
    docs = []
    for i in range(60):
        parts = [text(pick.randint(0, 200)) if pick.random() < 0.6 else pick.choice(shared) for _ in range(4)]
        docs.append("".join(parts))
    return docs + docs[:10] + ["", "a" * 500, "a" * 99, "ab" * 300, "a" * 130, shared[4] * 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed, monkeypatch):
    docs = list(enumerate(made(seed)))
    random.Random(seed).shuffle(docs)
    monkeypatch.setattr(op, "PIECES", 50)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, key string")
    assert rows(op.deduplicated(df.repartition(5))) == brute(docs)


def in_many_surroundings(n):
    pick = random.Random(7)

    def text(size):
        return "".join(pick.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))

    shared, line = text(300), text(110)
    return [text(90) + (line if i % 3 else shared) + text(90) for i in range(n)]


@pytest.mark.parametrize("seed", [None, 2])
def test_no_key_of_many_kinds_is_one_group(spark, seed, monkeypatch):
    docs = list(enumerate(in_many_surroundings(150) if seed is None else made(seed)))
    monkeypatch.setattr(op, "MANY", 20, raising=False)
    largest, resolve = [], op.first_places

    def counted(buckets):
        largest.extend(r["count"] for r in buckets.groupBy("key").count().collect())
        return resolve(buckets)

    monkeypatch.setattr(op, "first_places", counted)
    df = spark.createDataFrame(docs + docs[:2], "doc_id long, text string")
    assert rows(op.deduplicated(df.repartition(5))) == brute(docs)
    assert max(largest, default=0) <= 20


def test_nulls_repeats_and_empty(spark):
    a = "the quick brown fox jumps over the lazy dog " * 4
    df = spark.createDataFrame([(1, a), (1, a), (2, a), (3, None), (None, a)], "doc_id long, text string")
    got = op.deduplicated(df).collect()
    want = brute([(1, a), (2, a), (3, None), (4, a)])
    assert len(got) == 5
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id or 4]
    assert op.deduplicated(df.limit(0)).count() == 0


def test_sample_is_the_first_least_key_of_every_string():
    data = np.frombuffer(("xyz" * 80 + "hello world " * 9).encode() * 2, np.uint8)
    at, key, first, last = op.sampled(data)
    keys = op.string_hashes(data, op.KEY)
    upper = keys >> np.uint64(op.PLACE_BITS)
    width = op.LENGTH - op.KEY + 1
    want = [p + int(np.argmin(upper[p : p + width])) for p in range(keys.size - width + 1)]
    assert [a for a, f, b in zip(at, first, last) for _ in range(f, b + 1)] == want
    assert (keys[at] == key).all()


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(QUERIES["op6_suffix_dedup"](spark, sf)) == brute(docs)
