"""Transducers against dictionaries, the audit against sums in plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from hireflow.llm import source_audit
from hireflow.llm.byte_words import LETTERS, LOWER, SPACED, Partial, words_of
from hireflow.llm.transducer import Transducer

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abcé", max_size=6)), st.lists(st.text("abcdé", max_size=7)))
def test_transducer_numbers_sorted_words(words, others):
    held = sorted(w.encode() for w in words)
    transducer = Transducer.from_bytes(Transducer.build(held).to_bytes())
    asked = [*held, *(o.encode() for o in others)]
    data = np.frombuffer(b"".join(asked) or b"", np.uint8)
    lengths = np.array([len(a) for a in asked], dtype=np.int64)
    got = transducer.places(data, np.cumsum(lengths) - lengths, lengths)
    assert got.tolist() == [held.index(a) if a in held else -1 for a in asked]


def test_transducer_is_minimal():
    words = sorted(a + b + c for a in ("x", "y", "z") for b in ("k", "l") for c in ("ing", "ed", "s", ""))
    # begin, after x y z, after k l, after e, i and in, end
    assert len(Transducer.build([w.encode() for w in words]).final) == 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aBé-\t \n1\x1c", max_size=9), max_size=5))
def test_words_by_bytes(texts):
    for inside, fold, pattern in ((LETTERS, LOWER, TERM), (SPACED, None, WORD)):
        words, firsts = words_of(pa.array(texts, pa.string()), inside, fold)
        words = [w.decode() for w in words.to_pylist()]
        got = [words[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        assert got == [pattern.findall(lower(t) if fold is not None else t) for t in texts]


def test_partial_sums_lose_nothing():
    sums = Partial(["k"], "n", limit=3)
    out = []
    for i in range(40):
        out += sums.add({"k": pa.array([f"a{i % 5}", f"b{i}"]), "n": pa.array([1, 2])})
    out += sums.rest()
    total = Counter()
    for batch in out:
        for row in batch.to_pylist():
            total[row["k"]] += row["n"]
    assert total == Counter({f"a{i}": 8 for i in range(5)}) + Counter({f"b{i}": 2 for i in range(40)})


def plain(rows, least, top=10):
    rows = [(lang or "", source or "", TERM.findall(lower(text or ""))) for text, lang, source in rows]
    held = Counter((lang, t) for lang, _, terms in rows for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in held.items():
        if n >= least:
            kept[lang].append(t)
    counts, usual = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        some = [t for t in terms if held[lang, t] >= least]
        counts[lang, source].update(some)
        usual[lang].update(some)

    def shares(lang, counter):
        v, n = len(kept[lang]), sum(counter.values())
        return {t: 1 + 10**9 * (counter[t] + 2) // (n + 2 * v) for t in kept[lang]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for (lang, source), counter in list(counts.items()):
        p, q = shares(lang, counter), shares(lang, usual[lang])
        pairs = []
        for other_lang, other in list(counts):
            if other_lang == lang and other != source:
                s = shares(lang, counts[lang, other])
                pairs.append((other, sum(f(p[t], s[t]) for t in kept[lang])))
        terms = [(t, f(p[t], q[t])) for t in kept[lang] if counter[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i) for i, (t, v) in enumerate(items[:most], 1)]
    return sorted(out)


ROWS = [
    ("the cat THE été 12 a-b", "en", "s1"), ("the dog été", "en", "s1"), ("the the Été ÉTÉ", "en", "s2"),
    ("le chat the", "fr", "s1"), ("le chien", "fr", None), ("le le le the", "fr", "s2"),
    (None, "en", "s3"), ("", "en", "s4"), ("the cat", None, "s1"), ("the cat", None, "s1"),
    ("1 2 3", "xx", "s1"), ("alone", "xx", "s2"), ("日本 日本", "ja", "s1"), ("日本語 日本", "ja", "s2"),
    ("dog cat dog cat", "en", "s2"), ("x" * 20000 + " the", "en", "s1"),
]


def run(spark, rows, **kw):
    docs = spark.createDataFrame(
        [(t, lang, s, 1, "z", 2, "y") for t, lang, s in rows],
        "text string, lang string, source string, p long, term string, n long, item string",
    )
    return sorted(map(tuple, source_audit.audited(docs, **kw).collect()))


def test_audit(spark):
    want = plain(ROWS, 2)
    assert run(spark, ROWS, least=2) == want
    # one transducer for each part, few terms each
    assert run(spark, ROWS, least=2, block_terms=2, part_bytes=1) == want
    assert run(spark, ROWS, least=1, block_terms=1) == plain(ROWS, 1)


def test_audit_in_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "TILE", 1)
    monkeypatch.setattr(source_audit, "COLUMNS", 2)
    assert run(spark, ROWS, least=1) == plain(ROWS, 1)


def test_nothing_kept_and_no_rows(spark):
    got = run(spark, ROWS, least=99)
    assert got == plain(ROWS, 99) and got and all(r[4] == 0 for r in got)
    assert run(spark, []) == []
