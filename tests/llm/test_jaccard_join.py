"""Components against a comparison of all pairs."""

import random

import numpy as np
import pytest

from hireflow.llm import jaccard_join as op
from hireflow.llm.queries import QUERIES


def shingle_set(text):
    words = (text or "").encode().lower().split()
    n = op.WORDS
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(docs):
    """{doc: (n_shingles, component_id)}"""
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= op.ALIKE * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (len(s), find(i)) for i, s in sets}


def rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def made(seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    boiler = " ".join(pick.choice(words) for _ in range(60))

    def text(n):
        return [pick.choice(words) for _ in range(n)]

    docs = ["", " \t\x0b", "one two", "ONE  two", "one two three four five", "One two three four five six"]
    for n in (3, 7, 20, 60, 200, 900):
        for _ in range(3):
            base = text(n)
            docs.append(" ".join(base))
            for _ in range(8):
                copy = list(base)
                for _ in range(pick.randint(0, max(1, n // 25))):
                    copy[pick.randrange(len(copy))] = pick.choice(words)
                docs.append(("  " if pick.random() < 0.3 else " ").join(copy).upper())
            docs.append(" ".join(base) + " " + boiler)
    docs += [" ".join(text(pick.randint(5, 40))) + " " + boiler for _ in range(40)]
    return docs + docs[10:20]


@pytest.mark.parametrize("seed, frequent", [(1, 2.0), (2, 0.0), (3, 0.0)])
def test_against_all_pairs(spark, seed, frequent, monkeypatch):
    docs = list(enumerate(made(seed)))
    random.Random(seed).shuffle(docs)
    monkeypatch.setattr(op, "FREQUENT", frequent)  # 0 makes all tokens frequent
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, node int")
    assert rows(op.linked(df.repartition(3))) == brute(docs)


@pytest.mark.parametrize("seed", [4, 5])
def test_many_near_copies_of_one_text(spark, seed):
    """Most are linked to the text, some only to others with the same changes, some to none."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(500)}" for _ in range(150)]
    docs = []
    for i in range(260):
        copy = list(docs[pick.randrange(len(docs))]) if docs and pick.random() < 0.25 else list(base)
        for _ in range(pick.randint(1, 5)):
            copy[pick.randrange(len(copy))] = f"x{pick.randrange(10**6)}"
        docs.append(copy[: pick.choice([150, 150, 140, 120])])
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(op.linked(df)) == brute(docs)


def test_nulls_repeats_and_empty(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(4, text), (4, text), (2, text), (1, None), (3, "")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op.linked(df).collect())
    assert got == [(1, 0, 1), (2, 4, 2), (3, 0, 3), (4, 4, 2), (4, 4, 2)]
    assert op.linked(df.limit(0)).count() == 0


def test_alike_sets_share_a_signature():
    pick = np.random.default_rng(5)
    for _ in range(3000):
        n = int(pick.integers(1, 120))
        a = np.unique(pick.integers(0, 1 << 63, n).astype(np.uint64))
        drop = int(pick.integers(0, n // 5 + 1))
        b = np.unique(np.concatenate([a[drop:], pick.integers(0, 1 << 63, int(pick.integers(0, 3))).astype(np.uint64)]))
        if 100 * np.intersect1d(a, b).size < op.ALIKE * np.union1d(a, b).size:
            continue
        counters = pick.integers(0, 50, 1 << 10)
        frequent = float(pick.integers(0, 50))
        x, y = (op.signatures(s, counters, frequent) for s in (a, b))
        assert np.intersect1d(x, y).size


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(QUERIES["op8_jaccard_join"](spark, sf)) == brute(docs)


def test_bitmaps_rule_out_no_alike_sets(spark):
    """Sets differ in at least as many tokens as their bitmaps in bits; all close pairs stay."""
    rng = np.random.default_rng(3)
    sets, pairs = {}, []
    for i in range(120):
        whole = rng.choice(1 << 60, rng.integers(1, 3000), replace=False).astype(np.uint64)
        other = whole[rng.random(whole.size) > rng.choice([0.0, 0.05, 0.1, 0.2, 0.3])]
        more = rng.choice(1 << 60, rng.integers(0, whole.size // 8 + 1), replace=False).astype(np.uint64)
        sets[2 * i], sets[2 * i + 1] = np.unique(whole), np.unique(np.concatenate([other, more]))
        pairs += [(2 * i, 2 * i + 1), (2 * i, int(rng.integers(0, 2 * i + 1)))]
    rows = [(k, k, len(v), op.bitmap(v).view(np.int64).tolist()) for k, v in sets.items()]
    rows += rows[:5]
    bitmaps = op.Bitmaps(spark.createDataFrame(rows, "doc_id long, node long, n long, bitmap array<long>"))
    pairs = [p for p in set(pairs) if p[0] != p[1]]
    able = {(r.a, r.b): r.able for r in bitmaps.able(spark.createDataFrame(pairs, "a long, b long"), 80).collect()}
    assert set(able) == set(pairs)
    ruled_out = 0
    for (a, b), may in able.items():
        shared = np.intersect1d(sets[a], sets[b]).size
        alike = 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared)
        assert may or not alike
        ruled_out += not may
    assert ruled_out > len(pairs) // 4
