"""Base figures, histograms and verdicts against plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from hireflow.llm import divergence as op
from hireflow.llm.queries import QUERIES

CLASSES = (
    lambda c: c.islower() and c.isalpha(),
    lambda c: c in " \t\n\x0b\x0c\r",
    lambda c: c.isupper(),
    lambda c: c.isdecimal(),
    lambda c: c in ".,;:!?'\"()-",
)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    text = text or ""
    w = words_of(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def classes(text):
    bins = [0] * (len(CLASSES) + 1)
    for c in text:
        bins[next((i for i, has in enumerate(CLASSES) if has(c)), len(CLASSES))] += 1
    return bins


def distance(a, b):
    a, b = ([x / sum(n) for x in n] for n in (a, b))
    part = lambda p, q: p * math.log2(2 * p / (p + q)) if p else 0.0
    return math.sqrt(max(0.0, sum(part(p, q) + part(q, p) for p, q in zip(a, b)) / 2))


def brute(docs):
    """{doc: (base figures, kept)} of (doc, text, lang)."""
    per_lang, chars = {}, {}
    for _, text, lang in docs:
        for key in (lang, op.ALL):
            per_lang.setdefault(key, Counter()).update(words_of(text))
            chars[key] = [x + y for x, y in zip(chars.get(key, [0] * 6), classes(text or ""))]
    total = sum(per_lang[op.ALL].values()) if docs else 0
    out = {}
    for doc, text, lang in docs:
        figures = base(text)
        n, far = figures[0], False
        own = lang is not None and sum(per_lang[lang].values()) >= op.SHARE * total
        counts = per_lang[lang if own else op.ALL]
        common = sorted(counts, key=lambda w: (-counts[w], w))[: op.COMMON]
        if n >= op.GUARD_WORDS and len(text) >= op.GUARD_CHARS:
            mine = Counter(words_of(text))
            bins = [mine[w] for w in common]
            ref = [counts[w] for w in common]
            by_word = distance(bins + [n - sum(bins)], ref + [sum(counts.values()) - sum(ref)])
            by_class = distance(classes(text), chars[lang if own else op.ALL])
            far = (
                by_class > op.CHAR_LIMIT + op.CHAR_SLACK / math.sqrt(len(text))
                or by_word > op.WORD_LIMIT + op.WORD_SLACK / math.sqrt(n)
            )
        out[doc] = (*figures, not figures[-1] and not far)
    return out


def rows(df):
    return {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
        for r in df.collect()
    }


@pytest.mark.parametrize("place_bits", [20, 3, 58])
def test_small(spark, monkeypatch, place_bits):
    monkeypatch.setattr(op, "PLACE_BITS", place_bits)  # too few places, or equal upper bits
    plain = "the cat and the dog of a house in the town that is old and was new for all of them, "
    texts = [
        (None, "en"), ("", None), (" \n ", "en"), ("one", "xx"), ("a b a b a b", "en"), (plain * 9, "en"),
        ("\n".join([plain] * 3 + ["", " "]), "de"), ("#* $%" * 90, "en"), (plain + "é ÀÉ 12 ¿" * 40, None),
        (" ".join(f"{plain}{i}" for i in range(5)), "en"), ("x" * 9000, "en"), ("a\x0bb\x0cc\rd\te " * 30, "en"),
    ]
    docs = [(i, t, lang) for i, (t, lang) in enumerate(texts * 2)]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, lang string, words int")
    assert rows(op.judged(df, ["doc_id"])) == brute(docs)
    assert op.judged(df.limit(0), ["doc_id"]).count() == 0


def test_query(spark, sf):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(QUERIES["op3_divergence"](spark, sf)) == brute(docs)


def test_rare_language_in_a_script_without_case(spark):
    pick = random.Random(3)

    def text(words):
        return " ".join(pick.choice(words) + pick.choice(words) for _ in range(90))

    latin = ["the", "House", "of", "a", "cat", "and", "dogs", "in", "Town,", "is", "old."]
    arabic = ["في", "من", "على", "بيت", "قطة", "مدينة", "كتاب", "و", "هذا", "ماء", "يوم"]
    docs = [(i, text(latin), "en") for i in range(2500)]
    rare = [(10_000 + i, text(arabic), "ar") for i in range(2)]
    words = [sum(len(words_of(t)) for _, t, _ in x) for x in (rare, docs)]
    assert words[0] < 0.001 * sum(words)
    df = spark.createDataFrame(docs + rare, "doc_id long, text string, lang string")
    got = rows(op.judged(df, ["doc_id"]))
    assert [got[d][-2:] for d, _, _ in rare] == [(False, True)] * 2
    assert got == brute(docs + rare)


def test_words_of_another_language(spark):
    at = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    fit = [d for d in docs if 400 <= base(d[1])[0] <= 3000 and not base(d[1])[-1]]
    other = [(-1 - i, t, "en") for i, (_, t, lang) in enumerate(fit) if lang == "de"][:10]
    unknown = [
        (-10_000 - i, " ".join(w[::-1] + "x" for w in words_of(t)), "en")
        for i, (_, t, lang) in enumerate(fit) if lang == "en"
    ][:10]
    df = spark.createDataFrame(docs + other + unknown, "doc_id long, text string, lang string")
    got = rows(op.judged(df, ["doc_id"]))
    judged = [got[d] for d, _, _ in other + unknown if not got[d][-2]]
    assert len(judged) == 20 and not any(r[-1] for r in judged)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    good = [got[d] for d, _, _ in docs if labels.get(d) == 1 and not got[d][-2]]
    assert good and all(r[-1] for r in good)


@pytest.mark.parametrize("sizes", ["sf0.01"])
def test_labelled_quality(spark, sizes):
    at = f"/root/testdata/{sizes}"
    judged = QUERIES["op3_divergence"](spark, at)
    labels = spark.read.parquet(f"{at}/labels.parquet")
    found = judged.join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in found}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.15 * n[0, False]
