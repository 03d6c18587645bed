"""The operators applied to the given tables, one query each."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hireflow.llm import (
    contamination,
    divergence,
    jaccard_join,
    kd_shards,
    packing,
    page_model,
    periodic_runs,
    piece_codec,
    reference_sql,
    secret_links,
    source_audit,
    suffix_dedup,
    token_cache,
    url_markov,
)
from hireflow.llm.shared import let, spaced_words, whole_text
from hireflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            REFERENCE_SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of its own, so every distinct text is encoded."""
    cache = token_cache.TokenCache(
        spark, scratch_path(spark, "token-cache"), tokenizer_path("byte_bpe_50k.json")
    )
    return token_cache.token_counts(table(spark, sf_dir, "documents"), cache)


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json")).drop("ids")


@query("op3_divergence", reference_sql.DIVERGENCE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return divergence.judged(docs, ["doc_id"]).drop("char_distance", "word_distance")


@query("op4_contamination", reference_sql.CONTAMINATION)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


URL_RULES = [
    url_markov.Rule("allow", "org", "/"),
    url_markov.Rule("block", "example.org", "/es/"),
    url_markov.Rule("block", "example.org", "/en/1"),
    url_markov.Rule("allow", "com", "/fr/"),
    url_markov.Rule("block", "com", "/de/"),
]


@query("op7_url_markov", reference_sql.url_markov_sql(URL_RULES))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_markov.judged(pages, URL_RULES, ["page_id"]).drop("score")


SHARDS = 40


@query("op1_kd_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dims = kd_shards.documents_dimensions()
    rows = docs.select(
        "doc_id",
        kd_shards.size_of(F.col("text")).alias("size"),
        F.crc32(whole_text("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        *[col.alias(name) for name, col in dims.items()],
    )
    return kd_shards.shards(rows, "size", list(dims), SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_page_model")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_model.extracted(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query("op6_suffix_dedup", reference_sql.SUFFIX_DEDUP)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query("op8_jaccard_join", reference_sql.JACCARD_JOIN)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents")).drop("node", "component")


@query("op9_secret_links")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.scanned(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op11_source_audit", reference_sql.SOURCE_AUDIT)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audited(table(spark, sf_dir, "documents"))


@query("op12_piece_codec")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    ids = piece_codec.encoded(table(spark, sf_dir, "documents"), model)
    return piece_codec.decoded(ids, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        piece_codec.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the words of about every tenth document repeat from some word on.

    Which document, from where and how often follows from the checksum of its id. Null ids: none.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        start = g % n
        period = F.floor((n - start) / (g % 8 + 3)) + 1

        def word(i: Column) -> Column:
            place = F.when(i < start, i).otherwise(start + (i - start) % period)
            return F.get(words, place.cast("int"))

        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word)
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    text = whole_text("text")
    return docs.select(
        "doc_id", F.when(h % 10 == 0, let(spaced_words(text), repeated)).otherwise(text).alias("text")
    )


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic(with_planted_periods(table(spark, sf_dir, "documents")))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.transform("runs", lambda run: F.concat(line(run), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.col("kept_sha256").alias("collapsed_sha256"),
    )
