"""Runs against all periods at all places, and the query against its contract in plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hireflow.llm import periodic_runs
from hireflow.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(words):
    """(start, length, period) of all runs."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes, found = np.array([names[w] for w in words]), set()
    for q in range(1, len(codes) // 3 + 1):
        equal = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        for a, b in np.flatnonzero(np.diff(equal.astype(np.int8))).reshape(-1, 2).tolist():
            if b - a + q >= max(24, 3 * q):
                part = codes[a : b + q]
                if all(q % d or (part[:-d] != part[d:]).any() for d in range(1, q)):
                    found.add((a, b - a + q, q))
    return sorted(found)


def stitched(codes, tile):
    runs, of = [], None
    for q, a, b in sorted(set(periodic_runs.fragments(np.array(codes, dtype=np.int64), tile))):
        if of is not None and of[0] == q and a <= of[2]:
            of[2] = max(of[2], b)
        else:
            of = [q, a, b]
            runs.append(of)
    runs = [(a, b - a + q, q) for q, a, b in runs]
    return sorted(r for r in runs if r[1] >= max(24, 3 * r[2]))


def periodic_text(rng, n, kinds):
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a = rng.randrange(n)
        p = rng.randint(1, (n - a) // rng.randint(1, 8) + 1)
        for i in range(a, rng.randint(a, n)):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("tile", [8, 64, 1 << 16])
def test_all_runs(tile):
    rng = random.Random(tile)
    for _ in range(250):
        words = periodic_text(rng, rng.randint(1, 400), rng.choice([1, 2, 3, 50]))
        assert stitched(list(map(int, words)), tile) == plain(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90), st.sampled_from([8, 32, 1024]))
def test_two_words(codes, tile):
    assert stitched(codes, tile) == plain(codes)


def test_wrongly_joined_chains_are_cut(monkeypatch):
    """As if hashes always agreed: what they nominate is compared."""
    rng = random.Random(2)
    codes = [rng.randrange(60) for _ in range(300)]
    codes[40:200] = [codes[40 + i % 25] for i in range(160)]
    codes[210:260] = [codes[210 + i % 3] for i in range(50)]

    def all_pairs(words):
        for octave, step in ((0, 8), (8, 8), (16, 16), (32, 32), (64, 64)):
            periods = range(1, 8) if not octave else range(step, 2 * step)
            rows = [(q, b) for q in periods for b in range(0, len(words) - q - step + 1, step)]
            yield octave, np.array(rows).reshape(-1, 2)

    monkeypatch.setattr(periodic_runs, "nominated", all_pairs)
    assert plain(codes) and stitched(codes, 64) == plain(codes)


def test_z_function():
    assert periodic_runs.z_function(np.array([1, 1, 2, 1, 1, 1])) == [6, 1, 0, 2, 2, 1]


def kept_of(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents(spark):
    rng = random.Random(9)
    texts = [" ".join(periodic_text(rng, n, 3)) for n in (30, 100, 300, 800)]
    texts += [None, "", "one", "\n\t", "x\x1cy " * 30, "a\x0bb\fc \r\n" * 20, "été 😀 " * 40, "a " * 23, "a " * 24]
    texts += ["w " * 70000]
    rows = [(i, t, "r", b"d", 5) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "r", b"d", 5), (None, texts[1], None, None, None), (7, texts[2], None, None, None)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, digest binary, period int")
    got = sorted((repr((r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.kept_sha256))
                  for r in periodic_runs.periodic(docs).collect()))
    want = []
    for key, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = plain(words) if len(words) < 10000 else [(0, len(words), 1)]
        kept = hashlib.sha256(kept_of(words, runs).encode()).hexdigest()
        want.append(repr((key, len(words), runs, kept)))
    assert got == sorted(want)
    assert periodic_runs.periodic(docs.limit(0)).collect() == []


def test_best_run_by_exact_exponent(spark):
    big = 3_000_000_000
    rows = spark.createDataFrame(
        [([(5, 3, 3 * big), (0, 1, 3), (9, 2, 6)],), ([(0, big, 3 * big), (1, big - 1, 3 * big - 2)],), ([],)],
        "runs array<struct<start:long,period:long,length:long>>",
    )
    got = [r.best and r.best.start for r in rows.select(periodic_runs.best("runs").alias("best")).collect()]
    assert got == [5, 1, None]


def planted(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_periodic_runs"](spark, sf).collect()
    assert len(got) == len(docs) and sum(r.n_runs > 0 for r in got) > 5
    for r in got:
        words = planted(r.doc_id, docs[r.doc_id])
        runs = plain(words)
        first = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        want = (len(runs), *(first or (None,) * 3), 1000 * first[1] // first[2] if first else None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda x: (x[0], x[2])))
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept_of(words, runs).encode()).hexdigest()
