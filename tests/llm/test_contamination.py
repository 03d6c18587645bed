"""Hits against a look-up of every window."""

import random
import re

import pytest

from hireflow.llm import contamination as op


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - op.WINDOW + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + op.WINDOW]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if of := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= of - {"None"}
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_BYTES", 4000 if seed == 2 else 1 << 20)  # several parts
    pick = random.Random(seed)
    words = ["a", "B", "c", "été", "ÉTÉ", "x1", "of", "the"]

    def text(n):
        return " ".join(pick.choice(words) for _ in range(n))

    items = [(i, text(pick.choice([0, 1, 2, 3, 5, 9, 10, 11, 14]) if i < 12 else 13)) for i in range(30)]
    items = [(i, t) for i, t in items if len(t.split()) > 4 or i in (0, 1)] + [(7, None), (99, "!!"), (5, items[5][1])]
    items += [(None, text(12)), (None, text(4)), (None, None)]
    docs = []
    for i in range(60):
        passage = (pick.choice(items)[1] or "").upper() if pick.random() < 0.5 else text(9)
        docs.append((i, f"{text(pick.randint(0, 30))}, {passage}"))
    docs += [(100, None), (101, ""), (102, "..."), (100, docs[0][1]), (0, docs[0][1])]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, hash int").repartition(3)
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, place int")
    assert rows(op.contaminated(d, b, ["doc_id"])) == brute(docs, items)
    assert op.contaminated(d.limit(0), b, ["doc_id"]).count() == 0
    assert rows(op.contaminated(d, b.limit(0), ["doc_id"])) == brute(docs, [])
