"""Token counts behind a cache that is keyed by content and tokenizer version.

Equal texts have equal counts, so a count is stored under the digest of the normalised content
together with the digest of the tokenizer file. A run joins its digests to the stored counts,
encodes each distinct miss once, and appends the counts.

* Content: the text as it is, empty where null. The tokenizer has no normaliser, so nothing else
  may change without changing counts.
* Copies of one text collapse in the tasks that read them, before the shuffle by digest.
* Rows appended twice (two runs at a time) are equal and collapse on reading.
* Extra columns are ignored; an empty table gives no rows and adds nothing; repeated rows each get
  their count.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hireflow.llm.shared import whole_text, written
from hireflow.llm.tokens import SpacedWords, encoder, slices
from hireflow.session import path_exists

#: Longer documents are flagged.
LIMIT = 1024

#: Characters that are counted at once, as pieces, their numbers and sums take many times their bytes.
PART_CHARS = 1 << 20


def tokenizer_digest(tokenizer: str) -> str:
    with open(tokenizer, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def counted(batches: Iterable[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Counts of the texts (content_digest, text), a bounded part of a batch at a time."""
    words = encoder(SpacedWords, tokenizer)
    for batch in batches:
        for part in slices(batch, chars=PART_CHARS):
            counts = words.counts(part.column("text"))
            yield pa.record_batch(
                [part.column("content_digest"), pa.array(counts, pa.int64())],
                names=["content_digest", "n_tokens"],
            )
        # a worker that waits for its next task holds what its allocator kept
        pa.default_memory_pool().release_unused()


class TokenCache:
    """Stored counts below ``path``, one folder per tokenizer version."""

    schema = "content_digest binary, n_tokens long"

    def __init__(self, spark: SparkSession, path: str, tokenizer: str) -> None:
        self.spark, self.tokenizer = spark, tokenizer
        self.path = f"{path.rstrip('/')}/tokenizer_digest={tokenizer_digest(tokenizer)}"

    def stored(self) -> DataFrame:
        """One row per digest."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))

    def fill(self, docs: DataFrame, text: str = "text") -> None:
        """Encode the distinct texts without a stored count and append their counts."""
        content = whole_text(text)
        distinct = (
            docs.select(content_digest(content).alias("content_digest"), content.alias("text"))
            .groupBy("content_digest")
            .agg(F.first("text").alias("text"))
        )
        if path_exists(self.spark, self.path):
            distinct = distinct.join(self.stored(), "content_digest", "left_anti")
        tokenizer = self.tokenizer

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return counted(batches, tokenizer)

        distinct.mapInArrow(count, self.schema).write.mode("append").parquet(self.path)


def token_counts(
    docs: DataFrame, cache: TokenCache, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit of every row, through the cache."""
    cache.fill(docs, text)
    content = whole_text(text)
    rows = docs.select(
        F.col(key),
        F.octet_length(content).cast("long").alias("n_bytes"),
        content_digest(content).alias("content_digest"),
    )
    # written before it is joined, so that the rows of one text can be split
    return rows.join(written(cache.stored(), "counts"), "content_digest").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
