"""Token counts through a digest cache.

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens). A run digests all
texts, joins the digests to the cache, encodes each distinct missing text once and appends
its count; then every row takes its count from the cache. Normalising may only do what the
tokenizer itself does before it counts, so by default it maps null to the empty text.

Defined results: null text counts as empty, with 0 bytes and 0 tokens; ids may be null or
repeat, each row is counted; digests appended twice, as by two runs at a time, count once;
an empty table gives an empty result and appends nothing; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm import encoders
from terrace.llm.scratch import Scratch
from terrace.sources.paths import exists

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"
# Texts encoded at a time in a task.
ENCODE_BATCH = 256


def null_as_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def read_cache(df: DataFrame, cache: str, tokenizer_digest: str) -> DataFrame:
    """One row per digest that this tokenizer has counted."""
    spark = df.sparkSession
    if not exists(spark, cache):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("tokenizer_digest")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    own = stored.where(F.col("tokenizer_digest") == tokenizer_digest)
    return own.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(content_digest, n_tokens) of (content_digest, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders.load(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_BATCH):
                part = batch.slice(at, ENCODE_BATCH)
                counts = [len(ids) for ids in encode(part.column("content").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("content_digest"), pa.array(counts, pa.int64())],
                    names=["content_digest", "n_tokens"],
                )

    return texts.mapInArrow(run, "content_digest binary, n_tokens long")


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    cache: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = null_as_empty,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. Appends misses to ``cache``."""
    key = encoders.version(tokenizer)
    content = normalise(df[text_col])
    rows = df.select(
        df[id_col].alias("doc_id"),
        F.octet_length(null_as_empty(df[text_col])).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(content, 256)).alias("content_digest"),
        content.alias("content"),
    )
    with Scratch(df.sparkSession) as scratch:
        digests = scratch.keep(rows.drop("content"), "digests")
        known = read_cache(df, cache, key)
        missing = digests.select("content_digest").join(known, "content_digest", "left_anti")
        if not missing.isEmpty():
            texts = rows.select("content_digest", "content")
            if not known.isEmpty():
                texts = texts.join(known, "content_digest", "left_anti")
            # Copies are dropped within the map task before they are shuffled.
            found = encode_counts(texts.dropDuplicates(["content_digest"]), tokenizer)
            found.select("content_digest", F.lit(key).alias("tokenizer_digest"), "n_tokens").write.mode(
                "append"
            ).option("compression", "zstd").parquet(cache)
        # Written, so that Spark can split the join where many rows share a digest.
        counts = scratch.keep(read_cache(df, cache, key), "counts")
        counted = digests.join(counts, "content_digest")
        out = counted.select(
            "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
        )
        return scratch.result(out, "token-counts")
