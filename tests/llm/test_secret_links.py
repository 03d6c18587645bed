"""Base spans against the patterns, linked parts by example."""

import hashlib
import random
import re
from collections import Counter

from hireflow.llm import secret_links as op
from hireflow.llm.queries import QUERIES

VALUE = "A" * 3 + "b9/+_.=-xyz"


def brute(text):
    """Base spans, in order."""
    text = text or ""
    found = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for order, (kind, pattern, test) in enumerate(
        [
            ("assign", assign, lambda m: len(m.group(2)) >= 12),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
            ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16),
        ]
    ):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if test(m)]
    return [s for *_, s in sorted(found)]


TEXTS = [
    None, "", "nothing here", f"é password = '{VALUE}'", f"token=short token : {VALUE}", "ſecret=abcdefghijklmnop",
    "toKen=abcdefghijklmnop", f"PASSWD:\"{VALUE}\"", "AKIA" + "Q" * 13, "AKIA" + "Q" * 14, "AKIAAKIA" + "0" * 10,
    "0123456789abcdef", "0123456789abcdeF", "x" + "f" * 200, "token=token=abcdefghijklmnop", "secret=" + "0" * 20,
    "token=secret : abcdefghijklmnop", f"api_key={VALUE} apikey={VALUE}\napi__key={VALUE}", "api-key=" + VALUE,
]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in op.scanned(df, ["doc_id"]).collect()}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [
            sum(s.startswith(k + ":") for s in want) for k in op.BASE
        ]
        assert set(want) <= set(got[i].spans.split(","))or not want
    assert op.scanned(df.limit(0), ["doc_id"]).count() == 0


KEY = "aB3" * 8


def kinds(text):
    return [op.KINDS[s.kind] for s in op.linked_spans(text, op.base_spans(text))]


def test_weak_parts_need_their_complements():
    assert kinds(f"a run {KEY} alone") == []
    assert kinds("user = bob") == []
    assert kinds("see https://example.org/x") == []
    assert kinds(f"user = bob\nkey {KEY}") == ["id", "key"]
    assert kinds(f"key {KEY} at https://example.org/x") == ["key"]
    assert kinds(f"https://www.example.com/watch?v={KEY}") == []  # its own address is no complement
    assert kinds(f"https://www.example.com/watch?v={KEY} https://example.org") == ["key"]
    assert kinds(f"user = bob {KEY} https://db.example.org") == ["id", "key", "endpoint"]
    assert kinds(f"user = bob\n\nkey {KEY}") == []  # another scope
    assert kinds("user = bob" + " x" * 5000 + f" {KEY}") == ["id", "key"]  # the scope is the only bound
    assert kinds(f"password = {'c' * 14} user: bob") == ["id"]
    assert kinds(f"AKIA{'Z' * 16} and {KEY}") == ["key"]


def brute_links(text):
    """Every weak part against every other part of its scope."""
    base = op.base_spans(text)
    taken = {i for s in base for i in range(s.start, s.end)}
    mixed = lambda k: all(re.search(p, k) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    free = lambda a, b: not taken & set(range(a, b))
    ids = [m.span() for m in op.IDENTIFIER.finditer(text) if free(*m.span())]
    points = [m.span() for m in op.ENDPOINT.finditer(text) if free(*m.span())]
    inside = {i for a, b in points + ids for i in range(a, b)}
    keys = [m.span() for m in op.KEY.finditer(text)
            if mixed(m.group()) and free(*m.span()) and not inside & set(range(*m.span()))]
    of_ids = {i for a, b in ids for i in range(a, b)}
    for a, b in points:
        address = text[a:b]
        parts = [re.search("://([^/?#]*)@", address), re.search("(?s)[?#](.*)", address)]
        for part in parts:
            for m in op.KEY.finditer(part.group(1)) if part else ():
                x, y = a + part.start(1) + m.start(), a + part.start(1) + m.end()
                if mixed(m.group()) and free(x, y) and not of_ids & set(range(x, y)):
                    keys.append((x, y))
    ends = [m.end() for m in op.BLANK_LINE.finditer(text)]
    scope = lambda s: sum(e <= s[0] for e in ends)
    secrets = [(s.start, s.end) for s in base if s.kind != 1] + keys
    names = [(s.start, s.end) for s in base if s.kind == 1] + ids
    out = [("id", *s) for s in ids if any(scope(t) == scope(s) for t in secrets)]
    for s in keys:
        others = names + [p for p in points if not (p[0] <= s[0] and s[1] <= p[1])]
        if any(scope(t) == scope(s) for t in others):
            out.append(("key", *s))
    for s in points:
        if any(scope(t) == scope(s) for t in names) and any(scope(t) == scope(s) for t in secrets):
            out.append(("endpoint", *s))
    return sorted(set(out))


def test_links_against_all_pairs():
    rng = random.Random(4)
    pieces = ["user = bob", f"key {KEY}", KEY, "https://example.org/x", f"https://h/x?sig={KEY}", "plain words",
              f"postgres://bob:{KEY}@db/x", f"password = {'c' * 14}", "AKIA" + "Z" * 16, "0123456789abcdef0",
              "\n\n", "\n \t\n", "\n", "login: ann.lee", "host: db.example.org:5432", f"client_id={KEY}", "é"]
    seen = Counter()
    for _ in range(3000):
        text = rng.choice(["", "\n\n"]) + " ".join(rng.choices(pieces, k=rng.randint(1, 9)))
        got = sorted((op.KINDS[s.kind], s.start, s.end) for s in op.linked_spans(text, op.base_spans(text)))
        assert got == brute_links(text), text
        seen.update(k for k, *_ in got)
    assert min(seen[k] for k in ("id", "key", "endpoint")) > 100


def test_keys_in_endpoints_and_long_identifiers():
    sig = KEY + "Zz9" * 6
    assert kinds(f"client_id: acme https://host/x?sig={sig}&v=1") == ["id", "key", "endpoint"]
    assert kinds(f"client_id: acme\npostgres://{KEY}:{sig}@db/x") == ["id", "key", "key", "endpoint"]
    assert kinds(f"see https://host/{KEY}/x") == []  # a path
    text = f"login: bob https://bob:{KEY}@host/x?sig={sig}"
    spans = op.disjoint([s for s in op.linked_spans(text, op.base_spans(text)) if s.kind != 5])
    assert op.without(text, spans) == f"{op.MASK} https://bob:{op.MASK}@host/x?sig={op.MASK}"
    text = f"user = {'ab.' * 40} key {KEY}"
    spans = op.linked_spans(text, op.base_spans(text))
    assert [text[s.start : s.end] for s in spans] == [f"user = {'ab.' * 40}", KEY]


def test_redaction(spark):
    df = spark.createDataFrame(
        [(1, f"é token = {VALUE}, then text", "en"), (2, "plain", "en"), (3, None, None)], "doc_id long, text string, lang string"
    )
    got = {r.doc_id: r.text for r in op.redacted(df).collect()}
    assert got == {1: f"é {op.MASK}, then text", 2: "plain", 3: None}
    assert op.redacted(df).columns == df.columns


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op9_secret_links"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(",".join(brute(docs[r.doc_id])).encode()).hexdigest()
