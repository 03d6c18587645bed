"""Shards, address filters, page model, and the queries against their SQL."""

import duckdb
import numpy as np
import pytest

from hireflow.llm import kd_shards, page_model, url_markov
from hireflow.llm.dom import Tree
from hireflow.llm.queries import QUERIES, REFERENCE_SQL, URL_RULES


@pytest.mark.parametrize("name", sorted(REFERENCE_SQL))
def test_query_against_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = db.execute(REFERENCE_SQL[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def numbered(df):
    slots = {}
    for r in df.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_shards_of_near_equal_bytes(spark, sf):
    got = QUERIES["op1_kd_shards"](spark, sf)
    rows = got.collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.size for r in rows} == {i: len((t or "").encode()) + 16 for i, t in docs.items()}
    assert len(rows) == len(docs) and set(numbered(got)) <= set(range(40))
    totals = np.bincount([r.shard for r in rows], [r.size for r in rows], 40)
    assert np.abs(totals - totals.mean()).max() <= 2 * max(r.size for r in rows)


def test_shards_of_ties_nulls_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_ROWS", 7)
    same = spark.createDataFrame([(1, 10, 5)] * 400, "doc_id long, size long, dim long")
    got = kd_shards.shards(same, "size", ["dim"], 7)
    sizes = sorted(map(len, numbered(got).values()))
    assert len(sizes) == 7 and sizes[-1] - sizes[0] <= 4
    few = spark.createDataFrame([(1, None, None), (2, 5, 1), (None, 5, 1)], "doc_id long, size long, dim long")
    assert kd_shards.shards(few, "size", ["dim"], 40).count() == 3
    assert kd_shards.shards(few.limit(0), "size", ["dim"], 40).count() == 0
    wide = spark.range(2000).selectExpr("id as doc_id", "1 + id % 7 as size", "id as dim", "id % 3 as other", "id as shard_")
    totals = kd_shards.shards(wide, "size", ["dim", "other"], 5).groupBy("shard").sum("size").collect()
    assert max(r[1] for r in totals) - min(r[1] for r in totals) <= 40


def test_hosts_paths_and_rules(spark):
    urls = {
        "http://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "x://org": ("org", "", None, None),
        "x://org/": ("org", "/", "org/", "allow"),
        "http://borg/": ("borg", "/", None, None),
        "http://a.com/fr/://b": ("a.com", "/fr/://b", "com/fr/", "allow"),
        "http://a.com#/fr/": ("a.com", "", None, None),
        "a.com/fr/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://É.COM/de/": ("É.com", "/de/", "com/de/", "block"),
        "http://h/" + "é" * 3000: ("h", "/" + "é" * 3000, None, None),
    }
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_markov.judged(df.union(df), URL_RULES, ["page_id"]).collect()}
    for i, want in enumerate(urls.values()):
        r = got[i]
        assert (r.host, r.path, r.rule) == want[:3]
        assert r.verdict == want[3] if want[3] else r.verdict in ("allow", "block")
    assert url_markov.judged(df.limit(0), URL_RULES, ["page_id"]).count() == 0
    alone = df.where("page_id = 4")
    assert url_markov.judged(alone, URL_RULES, ["page_id"]).first().verdict == "allow"


def test_markov_model_tells_languages_apart(spark):
    rows = [(i, f"http://h{i % 50}.{'org' if i % 2 else 'com'}/{'fr/gateau' if i % 2 else 'de/kuchen'}-{i}") for i in range(400)]
    rows += [(1000 + i, f"http://new{i}.net/{'gateau' if i % 2 else 'kuchen'}-{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_markov.judged(df, URL_RULES, ["page_id"]).collect()}
    right = sum(got[1000 + i] == ("allow" if i % 2 else "block") for i in range(40))
    assert right >= 38


def enumerated(parent, looks, weights):
    """Marginals by summing over all labellings."""
    n = len(parent)
    total = np.zeros(n)
    mass = 0.0
    for code in range(1 << n):
        y = [(code >> i) & 1 for i in range(n)]
        score = sum(looks[i] @ weights.nodes * y[i] for i in range(n))
        score += sum(weights.edges[y[parent[i]], y[i]] for i in range(n) if parent[i] >= 0)
        total += np.exp(score) * np.array(y)
        mass += np.exp(score)
    return total / mass


def test_sum_product_is_exact():
    pick = np.random.default_rng(3)
    for _ in range(5):
        parent = np.array([-1, 0, 0, 1, 1, 2, 4, 4])
        looks = pick.normal(size=(8, len(page_model.FEATURES)))
        weights = page_model.Weights(pick.normal(size=looks.shape[1]) / 2, pick.normal(size=(2, 2)))
        page = page_model.Page(parent, looks, [], None)
        p, pair = page_model.sum_product(page_model.forest([page, page]), weights)
        want = enumerated(parent, looks, weights)
        assert np.allclose(p, np.tile(want, 2))
        assert np.allclose(pair[1:8, :, 1].sum(axis=1), want[1:])


def test_training_raises_the_likelihood():
    html = "<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>Some text. More of it.</p></article><footer>f</footer></body>"
    some = [page_model.labelled(v) for v in page_model.variants(html, ["other words", "x"], 1)]
    pages, labels = zip(*[(s[0], s[1]) for s in some])
    trees, y = page_model.forest(list(pages)), np.concatenate(labels)

    def fit(w):
        p, _ = page_model.sum_product(trees, w)
        return np.mean(np.where(y, np.log(p), np.log(1 - p)))

    assert fit(page_model.train(list(pages), list(labels))) > fit(page_model.prior())


def test_trees_of_broken_markup():
    html = "<p><b>one<br><p>two</b> <script>var t='</p>';</script>&amp;&lt;x</p><ul><li>a<li>b</ul>t<div/>u"
    tree = Tree(html)
    text = " ".join("".join(t for _, t in tree.pieces).split())
    assert text == "one two &<x a b t u"
    assert [tree.tag[i] for i in (tree.parent[tree.tag.index("li")],)] == ["ul"]
    deep = Tree("<div>" * 3000 + "x")
    assert len(deep.tag) == 3001


def held_out(template):
    body = "<h1>Title of it</h1><p>First part, with words. And more.</p><p>Second <i>part</i> here. It goes on.</p>"
    return template.format(body), "Title of it First part, with words. And more. Second part here. It goes on."


@pytest.mark.parametrize(
    "template",
    [
        "<html><body><nav><a href=/>Home</a></nav><article>{}</article><footer>&copy; me</footer></body></html>",
        "<body><div class=menu><a href=/>Home</a><a href=/b>B</a></div><div class='entry-content'>{}</div>"
        "<div class=sidebar><p>Also read this.</p></div></body>",
        "<body><header><a href=/>Site</a></header><main>{}</main><section class=comments><p>I agree. Nice.</p></section></body>",
        "<body><div id=cookie-notice><p>We use cookies. Accept.</p></div><article>{}</article><form><label>Mail</label><button>Go</button></form></body>",
    ],
)
def test_main_text_of_other_layouts(spark, template):
    html, want = held_out(template)
    sample = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = page_model.trained(sample)
    assert page_model.main_texts([page_model.page_of(html)], weights) == [want]


def test_pages_of_the_query(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op5_page_model"](spark, sf).collect()
    for r in got:
        inside = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split())
        assert r.text == want and r.n_chars == len(want)
    odd = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, "<p", "u")], "page_id long, html string, text string")
    assert all(isinstance(r.text, str) for r in page_model.extracted(odd, ["page_id"]).collect())
    assert page_model.extracted(odd.limit(0), ["page_id"]).count() == 0
