"""Main text of pages by a graphical model on the element tree.

Every element is content or not. An element has a potential for each from what it looks like, and
each element and its parent have a potential for the four ways they can agree or differ. Messages
passed up and then down the tree (sum-product) give each element's exact probability of being
content; the text of those above one half is the main text.

Weights are found by gradient ascent on the likelihood of labelled pages, whose gradient is the
difference between the labels and the marginals. Labelled pages are built from a bounded sample of
the given ones (the ``SAMPLE`` smallest content hashes of pages with an ``article`` or ``main`` element,
none longer than ``SAMPLE_CHARS``): that element marks what is content. Each is used as it is and with
its landmarks renamed or without a name, with its article cut short, and with sidebars, notices, forms
and comments filled with text of other pages, so that the model learns looks and not one tag. Without
such pages the weights of ``PRIOR`` hold. A page without any likely element gives its likeliest ones.

* Null and empty pages have an empty text. Broken markup is closed as browsers do.
* White space within a text becomes one blank, and blocks are joined by one.
* Repeated rows are read one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hireflow.llm.dom import INLINE, Tree
from hireflow.llm.shared import whole_text

#: Pages and characters of each in the training sample.
SAMPLE, SAMPLE_CHARS = 240, 40_000

#: Steps and rate of the ascent, and the pull towards ``PRIOR``.
STEPS, RATE, PULL = 120, 0.4, 2e-3

#: Elements that one pass handles together.
BATCH_ELEMENTS = 20_000

#: Words in class, id and role that speak against and for content. Names are cut at all signs but
#: letters, and only whole words count: "research" is no search, "football" no foot.
AGAINST = frozenset(
    "nav navbar navigation menu menus side sidebar sidebars ad ads advert adverts advertisement"
    " advertising promo promos promotion sponsor sponsored foot footer footers header headers masthead"
    " comment comments discuss discussion disqus reply replies share sharing social login signin signup"
    " sign search subscribe subscription newsletter cookie cookies consent notice notices banner banners"
    " popup modal related recommend recommended recommendations widget widgets breadcrumb breadcrumbs"
    " pagination pager toolbar copyright alert alerts feedback links".split()
)
FOR = frozenset("article articles content contents main post posts entry entries story body prose text".split())
_LETTERS = re.compile(r"[^\W\d_]+")

#: What a name says it has, or has not, is not what it is: "has-sidebar".
_HAS = re.compile(r"\b(?:has|with|without|no|hide|show)[-_]+\w+")

#: Elements whose names say nothing about their own text.
NAMELESS = frozenset("#page html body article main".split())


def speaks(names: str, words: frozenset[str]) -> bool:
    return bool(names) and not words.isdisjoint(_LETTERS.findall(_HAS.sub(" ", names)))


#: Looks of an element; a bias comes first.
TAGS = {
    "boilerplate_tag": frozenset("nav footer aside header form button menu dialog select label fieldset".split()),
    "content_tag": frozenset("article main".split()),
    "paragraph": frozenset("p blockquote pre".split()),
    "heading": frozenset("h1 h2 h3 h4 h5 h6".split()),
    "list": frozenset("ul ol li dl dt dd".split()),
    "table": frozenset("table thead tbody tr td th".split()),
    "link": frozenset(["a"]),
    "inline": INLINE - {"a"},
    "block": frozenset("div section".split()),
    "page": frozenset("#page html body".split()),
}
FEATURES = [
    "bias", *TAGS, "against", "for", "under_against", "under_for", "under_boilerplate_tag",
    "under_content_tag", "words", "words_below", "no_words", "links", "links_below",
    "sentences", "repeated_children",
]

#: Weights before training, by feature; the rest are 0.
PRIOR = {
    "bias": -0.5, "boilerplate_tag": -3.0, "content_tag": 2.0, "paragraph": 1.0, "page": -2.0,
    "against": -3.0, "for": 0.5, "under_against": -1.5, "under_boilerplate_tag": -1.5,
    "under_content_tag": 1.5, "words": 1.0, "links_below": -1.5, "sentences": 0.5,
}
#: Potentials of parent and child: rows by the parent's label, columns by the child's.
PRIOR_EDGES = np.array([[1.0, -1.0], [-0.5, 1.0]])


class Weights(NamedTuple):
    nodes: np.ndarray
    edges: np.ndarray


class Page(NamedTuple):
    parent: np.ndarray
    looks: np.ndarray
    pieces: list[tuple[int, str]]
    tree: Tree


def prior() -> Weights:
    return Weights(np.array([PRIOR.get(f, 0.0) for f in FEATURES]), PRIOR_EDGES.copy())


def page_of(html: str) -> Page:
    tree = Tree(html)
    parent = np.array(tree.parent)
    return Page(parent, looks(tree), tree.pieces, tree)


def looks(tree: Tree) -> np.ndarray:
    """Features of every element."""
    n = len(tree.tag)
    out = np.zeros((n, len(FEATURES)), dtype=np.float32)
    at = {f: i for i, f in enumerate(FEATURES)}
    words, ends = [0] * n, [0] * n
    for element, text in tree.pieces:
        words[element] += len(text.split())
        ends[element] += text.count(". ") + text.rstrip().endswith((".", "!", "?"))
    below, linked, kinds = list(words), [0] * n, {}
    for i in range(n - 1, 0, -1):  # children come after their parents
        if tree.tag[i] == "a":
            linked[i] = below[i]
        up = tree.parent[i]
        below[up] += below[i]
        linked[up] += linked[i]
        kinds[up, tree.tag[i]] = kinds.get((up, tree.tag[i]), 0) + 1
    bad, good = [False] * n, [False] * n
    bad_tag, good_tag = [False] * n, [False] * n
    for i in range(n):
        up, tag, names = tree.parent[i], tree.tag[i], tree.attrs[i]
        row = out[i]
        row[0] = 1
        for kind, tags in TAGS.items():
            if tag in tags:
                row[at[kind]] = 1
        # a name like "with-sidebar" beside one like "content" tells of what else is there
        favour = speaks(names, FOR)
        against = speaks(names, AGAINST) and not favour and tag not in NAMELESS
        row[at["against"]], row[at["for"]] = against, favour
        if up >= 0:
            row[at["under_against"]] = bad[up]
            row[at["under_for"]] = good[up]
            row[at["under_boilerplate_tag"]] = bad_tag[up]
            row[at["under_content_tag"]] = good_tag[up]
            bad[i], good[i] = bad[up] or against, good[up] or favour
            bad_tag[i] = bad_tag[up] or tag in TAGS["boilerplate_tag"]
            good_tag[i] = good_tag[up] or tag in TAGS["content_tag"]
            row[at["repeated_children"]] = math.log1p(kinds[up, tag]) / 4
        row[at["words"]] = math.log1p(words[i]) / 4
        row[at["words_below"]] = math.log1p(below[i]) / 6
        row[at["no_words"]] = below[i] == 0
        row[at["links"]] = tag == "a" or (up >= 0 and row[at["inline"]] and tree.tag[up] == "a")
        row[at["links_below"]] = linked[i] / below[i] if below[i] else 0
        row[at["sentences"]] = math.log1p(ends[i]) / 2
    return out


class Forest(NamedTuple):
    """Trees side by side, their elements grouped by depth."""

    parent: np.ndarray
    looks: np.ndarray
    levels: list[np.ndarray]


def forest(pages: list[Page]) -> Forest:
    shifts = np.cumsum([0, *(len(p.parent) for p in pages)])
    parent = np.concatenate([np.where(p.parent < 0, -1, p.parent + s) for p, s in zip(pages, shifts)])
    depth = np.zeros(parent.size, dtype=np.int32)
    for i, up in enumerate(parent.tolist()):
        if up >= 0:
            depth[i] = depth[up] + 1
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    return Forest(parent, np.concatenate([p.looks for p in pages]), levels)


def sum_product(trees: Forest, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content of every element, and of (parent, child) labels of every edge."""
    n = trees.parent.size
    own = np.zeros((n, 2))
    own[:, 1] = trees.looks @ weights.nodes
    up = np.zeros((n, 2))  # message to the parent, by the parent's label
    belief = own.copy()  # own potential and all messages from below
    for level in trees.levels[:0:-1]:
        joint = belief[level][:, None, :] + weights.edges[None]
        up[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        up[level] -= up[level].max(axis=1, keepdims=True)
        np.add.at(belief, trees.parent[level], up[level])
    down = np.zeros((n, 2))  # message from the parent, by the element's label
    pair = np.zeros((n, 2, 2))
    for level in trees.levels[1:]:
        over = trees.parent[level]
        outside = belief[over] + down[over] - up[level]
        joint = outside[:, :, None] + weights.edges[None]
        down[level] = np.logaddexp(joint[:, 0], joint[:, 1])
        down[level] -= down[level].max(axis=1, keepdims=True)
        both = joint + belief[level][:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        pair[level] = both / both.sum(axis=(1, 2), keepdims=True)
    total = belief + down
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), pair


def train(pages: list[Page], labels: list[np.ndarray]) -> Weights:
    """Weights of greatest likelihood near the prior."""
    start = prior()
    if not pages:
        return start
    trees, y = forest(pages), np.concatenate(labels)
    nodes, edges = start.nodes.copy(), start.edges.copy()
    child = np.flatnonzero(trees.parent >= 0)
    n = max(1, y.size)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[trees.parent[child]], y[child]), 1)
    speed_nodes, speed_edges = np.zeros_like(nodes), np.zeros_like(edges)
    for _ in range(STEPS):
        p, pair = sum_product(trees, Weights(nodes, edges))
        slope_nodes = trees.looks.T @ (y - p) / n * 10 - PULL * (nodes - start.nodes)
        slope_edges = (seen - pair[child].sum(axis=0)) / n * 10 - PULL * (edges - start.edges)
        speed_nodes = 0.8 * speed_nodes + RATE * slope_nodes
        speed_edges = 0.8 * speed_edges + RATE * slope_edges
        nodes, edges = nodes + speed_nodes, edges + speed_edges
    return Weights(nodes, edges)


def text_of(page: Page, content: np.ndarray) -> str:
    return " ".join("".join(t if content[e] else " " for e, t in page.pieces).split())


LANDMARKS = re.compile(r"<(/?)(article|main|nav|footer|aside|header)\b", re.IGNORECASE)

#: Names that landmarks get when they are renamed; none for content as often as not.
RENAMED = {
    "article": ("post-body", "article-text", "entry-content", "story", "", "", "x1", "design"),
    "main": ("content", "main-text", "", "wrap"),
    "nav": ("menu", "top-links", "breadcrumbs"),
    "footer": ("page-foot", "copyright"),
    "aside": ("sidebar", "related"),
    "header": ("masthead", "top"),
}

#: Parts that are added around and inside the content of labelled pages; {} is text of another page.
AROUND = (
    '<aside><h3>{}</h3><p>{}</p></aside>',
    '<div class="sidebar"><ul><li><a href="/">{}</a></li><li><a href="/">{}</a></li></ul></div>',
    '<div id="cookie-notice"><p>{}</p><button>{}</button></div>',
    '<form action="/"><label>{}</label><input><button>{}</button></form>',
    '<section class="comments"><h2>{}</h2><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></section>',
    '<div class="newsletter"><p>{}</p></div>',
    '<header><a href="/">{}</a><p>{}</p></header>',
)
INSIDE = (
    '<div class="ad">{}</div>',
    '<div class="share"><a href="/">{}</a></div>',
    '<aside class="related"><a href="/">{}</a></aside>',
)


def labelled(html: str) -> tuple[Page, np.ndarray] | None:
    """A page and which of its elements are content, if a landmark tells."""
    page = page_of(html)
    tree = page.tree
    inside = [False] * len(tree.tag)
    barred = [False] * len(tree.tag)
    for i, (up, tag) in enumerate(zip(tree.parent, tree.tag)):
        if up >= 0:
            names = tree.attrs[i]
            marked = tag in TAGS["content_tag"] or "true-content" in names
            # a landmark is content whatever its name
            named = speaks(names, AGAINST) and not speaks(names, FOR) and tag not in NAMELESS
            barred[i] = barred[up] or not marked and (tag in TAGS["boilerplate_tag"] or named)
            inside[i] = (inside[up] or marked) and not barred[i]
    return (page, np.array(inside, dtype=np.int64)) if any(inside) else None


def variants(html: str, texts: list[str], seed: int) -> Iterator[str]:
    """The page as it is, and rebuilt with other names and other parts."""
    pick = np.random.default_rng(seed)
    yield html

    def fill(part: str) -> str:
        return part.format(*[texts[pick.integers(len(texts))] for _ in range(part.count("{}"))])

    names = {tag: RENAMED[tag][pick.integers(len(RENAMED[tag]))] for tag in RENAMED}

    def rename(m: re.Match) -> str:
        if m[1]:
            return "</div"
        mark = " true-content" if m[2].lower() in TAGS["content_tag"] else ""
        return f'<div class="{(names[m[2].lower()] + mark).strip()}"'

    for renamed in (False, True):
        page = html
        for part in pick.permutation(len(AROUND))[:4]:
            where = "<article" if pick.random() < 0.5 else "<footer"
            page = page.replace(where, fill(AROUND[part]) + where, 1)
        first = page.find("</p>", max(0, page.find("<article")))
        if first > 0:
            part = fill(INSIDE[pick.integers(len(INSIDE))])
            page = page[: first + 4] + part + page[first + 4 :]
        page = shortened(page, int(pick.integers(1, 5))) if pick.random() < 0.5 else page
        yield LANDMARKS.sub(rename, page) if renamed else page


def shortened(html: str, paragraphs: int) -> str:
    """The page with only the first paragraphs of its article."""
    start, end = html.find("<article"), html.find("</article>")
    place = start
    for _ in range(paragraphs):
        found = html.find("</p>", place, end)
        if found < 0:
            return html
        place = found + 4
    return html[:place] + html[end:]


def trained(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from a bounded sample of the pages; the same whatever their order."""
    col = F.col(html)
    able = pages.where(col.isNotNull() & (F.char_length(col) <= SAMPLE_CHARS) & col.rlike("(?i)<(article|main)"))
    hashes = able.select(F.xxhash64(col).alias("order")).distinct().orderBy("order").limit(SAMPLE)
    # only hashes go through the sort; then the pages themselves, one for each of at most SAMPLE hashes
    chosen = [r["order"] for r in hashes.collect()]
    sample = (
        able.where(F.xxhash64(col).isin(chosen))
        .groupBy(F.xxhash64(col).alias("order"))
        .agg(F.min(col).alias("html"))
        .orderBy("order")
        .collect()
    )
    found = [r["html"] for r in sample]
    texts = [" ".join("".join(t for _, t in Tree(h).pieces).split())[:400] for h in found]
    texts = [t[i : i + 60 + 40 * (i % 7)] for t in texts for i in range(0, len(t), 120)] or ["text"]
    looked = [
        one
        for i, h in enumerate(found)
        for v in variants(h, texts, i)
        if (one := labelled(v)) is not None
    ]
    looked = [(Page(p.parent, _unmarked(p), p.pieces, p.tree), y) for p, y in looked]
    return train([p for p, _ in looked], [y for _, y in looked])


def _unmarked(page: Page) -> np.ndarray:
    """Looks without the mark that told the label."""
    page.tree.attrs = [a.replace("true-content", "").strip() for a in page.tree.attrs]
    return looks(page.tree)


def extracted(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep``, text and n_chars of every page."""
    weights = trained(pages, html)
    names = [f"keep_{i}" for i in range(len(keep))]
    source = pages.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names)], whole_text(html).alias("html")
    )
    fields = [source.schema[n] for n in names]
    fields += [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, some, size = [], [], 0
            for i, value in enumerate(batch.column("html")):
                some.append(page_of(value.as_py()))
                size += len(some[-1].parent)
                if size >= BATCH_ELEMENTS or i == batch.num_rows - 1:
                    texts += main_texts(some, weights)
                    some, size = [], 0
            yield pa.record_batch(
                [batch.column(n) for n in names]
                + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[f.name for f in fields],
            )

    return source.mapInArrow(extract, T.StructType(fields)).withColumnsRenamed(dict(zip(names, keep)))


def main_texts(pages: list[Page], weights: Weights) -> list[str]:
    probability, _ = sum_product(forest(pages), weights)
    ends = np.cumsum([len(p.parent) for p in pages])
    each = [(p, probability[e - len(p.parent) : e]) for p, e in zip(pages, ends)]
    return [text_of(p, chosen(p, likely)) for p, likely in each]


def chosen(page: Page, likely: np.ndarray) -> np.ndarray:
    """Elements above one half; if none of them has text, the likeliest with text among its siblings.

    Then all children of one element that are not much less likely than the best of the page count,
    with what is below them and not much less likely either. Menus, footers, forms and the like are
    never content, nor is anything in them.
    """
    barred = np.zeros(len(likely), dtype=bool)
    for i, (up, tag) in enumerate(zip(page.tree.parent, page.tree.tag)):
        barred[i] = tag in TAGS["boilerplate_tag"] or up >= 0 and barred[up]
    likely = np.where(barred, 0, likely)
    content = likely > 0.5
    words = np.zeros(len(likely), dtype=np.int64)
    for element, text in page.pieces:
        words[element] += len(text.split())
    if words[content].any() or not words[~barred].any():
        return content
    best = int(np.argmax(np.where((words > 0) & ~barred, likely, -1)))
    enough = ~barred & (likely >= likely[best] / 2)
    up = page.parent[best]
    below = np.zeros(len(likely), dtype=bool)
    for i in range(len(likely)):  # children come after their parents
        below[i] = enough[i] and (i == up or page.parent[i] == up or page.parent[i] >= 0 and below[page.parent[i]])
    return below
