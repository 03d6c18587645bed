"""From raw documents to packed training windows, stage by stage.

Each stage takes what the stage before it kept and is written before the next one reads it. All but
the last return the columns of the documents. A stage that drops documents finds their keys first,
which are few and narrow, and leaves them out where the documents are read; the keys are broadcast
while they are small and joined by a shuffle beyond that.

Documents are told apart by id and text, so repeated ids with different texts stay apart. Null
texts have no words and go with the quality rules. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hireflow.llm import contamination, divergence, jaccard_join, packing, secret_links
from hireflow.llm.queries import tokenizer_path
from hireflow.llm.shared import bounded, whole_text, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of a dropped document's key in a broadcast.
KEY_BYTES = 32


def content(text: str = "text") -> Column:
    return jaccard_join.node_of(whole_text(text))


def leave_out(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose id and content are not in ``gone`` (gone_id, gone_content)."""
    gone = bounded(written(gone.distinct(), "left-out"), KEY_BYTES)
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (content() == gone["gone_content"])
    return docs.join(gone, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like their language."""
    keyed = docs.select(
        F.col("doc_id").alias("gone_id"), content().alias("gone_content"), "text", "lang"
    )
    judged = divergence.judged(keyed, ["gone_id", "gone_content"])
    return leave_out(docs, judged.where("not kept").select("gone_id", "gone_content"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike ones: that of the least id (null last) and content."""
    linked = jaccard_join.linked(docs).select(
        "doc_id", "component", F.col("node").alias("content")
    )
    linked = written(linked, "linked")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")
    firsts = (
        linked.where("component is not null")
        .groupBy("component")
        .agg(F.min(place).alias("first"), F.max(place).alias("latest"))
        .where(~F.col("first").eqNullSafe(F.col("latest")))
        .select("component", "first")
    )
    alike = linked.join(written(firsts, "firsts"), "component")
    gone = alike.where(~place.eqNullSafe(F.col("first")))
    kept = leave_out(docs, gone.select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_content")))
    repeated = (
        linked.groupBy("doc_id", "content").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_content"))
    )
    repeated = written(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    once = bounded(repeated, KEY_BYTES)
    same = kept["doc_id"].eqNullSafe(once["gone_id"]) & (content() == once["gone_content"])
    rows = kept.join(once, same, "left_semi").select(
        F.struct(*docs.columns).alias("row"), content().alias("content")
    )
    rows = rows.groupBy("row.doc_id", "content").agg(F.first("row").alias("row")).select("row.*")
    return leave_out(kept, repeated).unionByName(rows)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(
        F.col("doc_id").alias("gone_id"), content().alias("gone_content"), F.col("text")
    )
    found = contamination.contaminated(keyed, benchmark, ["gone_id", "gone_content"])
    return leave_out(docs, found.where("n_hit > 0").select("gone_id", "gone_content"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked."""
    return secret_links.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of equal length."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: Token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i + 1}")
    return docs
