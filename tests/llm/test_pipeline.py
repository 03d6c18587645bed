"""The pipeline stage by stage against the brute-force versions of its operators."""

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from hireflow.llm import packing, secret_links
from hireflow.llm.queries import tokenizer_path
from tests.llm import test_contamination, test_divergence, test_jaccard_join


def masked(text):
    if text is None:
        return None
    base = secret_links.base_spans(text)
    spans = [s for s in [*base, *secret_links.linked_spans(text, base)] if s.kind != 5]
    return secret_links.without(text, secret_links.disjoint(spans))


def brute(docs, items):
    """Documents (id, text, language) that are left after each stage but the last."""
    good = test_divergence.brute(docs)
    out = [[d for d in docs if good[d[0]][-1]]]
    groups = test_jaccard_join.brute([d[:2] for d in out[-1]])
    out.append([d for d in out[-1] if groups[d[0]][1] == d[0]])
    hits = {r[0]: r[2] for r in test_contamination.brute([d[:2] for d in out[-1]], items)}
    out.append([d for d in out[-1] if not hits[d[0]]])
    out.append([(i, masked(t), lang) for i, t, lang in out[-1]])
    return out


def test_stages(spark, sf, tmp_path):
    read = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r.doc_id, r.text, r.lang) for r in read.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert len(want[0]) < len(docs) and len(want[1]) < len(want[0]) and len(want[2]) < len(want[1])
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        got = stage(spark, read, sf)
        assert got.columns == read.columns, name
        path = str(tmp_path / f"{i}")
        got.write.parquet(path)
        read = spark.read.parquet(path)
        assert sorted((r.doc_id, r.text, r.lang) for r in read.collect()) == sorted(want[i]), name
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    lengths = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t, _ in want[-1]}
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == lengths
    assert sum(r.length for r in pieces) == sum(lengths.values())
    assert {r.sequence_id for r in pieces} == set(range(-(-sum(lengths.values()) // packing.WINDOW)))


def test_nulls_repeats_and_empty(spark, sf):
    plain = " ".join(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").limit(3).collect())
    schema = "doc_id long, text string, lang string, source string, n_chars long, node int, content_ string"
    rows = [(1, plain), (1, plain), (2, plain), (3, None), (4, ""), (None, plain + " and some more of it")]
    docs = spark.createDataFrame([(i, t, "en", None, None, 1, "x") for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    kept = corpus_pipeline.near_duplicates(spark, docs.where("length(text) > 0"), sf).collect()
    assert [r.doc_id for r in kept] == [1]
    assert corpus_pipeline.without_secrets(spark, docs, sf).count() == len(rows)


def test_one_of_each_group_with_repeated_and_null_ids(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").limit(9).collect()]
    one, two, three = (" ".join(texts[i : i + 3]) for i in (0, 3, 6))
    rows = [(1, one), (1, one + " and more"), (None, two), (None, two + " and more"), (1, three)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = [r.text for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()]
    assert sorted(sum(t.startswith(x) for t in kept) for x in (one, two, three)) == [1, 1, 1]
    assert len(kept) == 3


def test_entry_has_all_queries():
    names = entry.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
