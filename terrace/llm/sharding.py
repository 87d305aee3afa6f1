"""Rendezvous hashing: each record goes to the shard that scores highest for its key.

A shard's score is ``-weight / ln(u)`` with ``u`` a hash of key and shard in (0, 1). Scores
of other shards do not depend on one that is added or removed, so records move only into a
new shard or out of a removed one, and shares follow the weights. Built-in expressions only.

Defined results: a null key is a key of its own; rows with equal keys share a shard; null
text has size 1 and the checksum of no bytes; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.running import order_key, with_range_sum
from terrace.llm.scratch import Scratch

# Fixed value: 52 bits of the digest make a double exactly.
_DIGEST_HEX, _SCALE = 13, float(2**52)


def _unit(key: Column, shard: int) -> Column:
    """A number in (0, 1) from key and shard."""
    digest = order_key(key, F.lit(shard))
    return (F.conv(F.substring(digest, 1, _DIGEST_HEX), 16, 10).cast("double") + 0.5) / _SCALE


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a stable record key among weighted shards. Weights must be positive."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every shard needs a positive weight")
    scored = [
        F.struct((-F.lit(float(w)) / F.ln(_unit(key, s))).alias("score"), F.lit(-s).alias("inverse"))
        for s, w in sorted(weights.items())
    ]
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["inverse"]).cast("int")


def shard_documents(
    df: DataFrame,
    weights: Mapping[int, float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard once one more, of mean weight and the next number, is
    there. ``slot`` numbers the rows of a shard without gaps, in the order of a digest of id
    and text; rows that agree in both take neighbouring slots.
    """
    grown = {**weights, max(weights) + 1: sum(weights.values()) / len(weights)}
    text = F.coalesce(F.encode(df[text_col], "UTF-8"), F.lit(b""))
    key = df[id_col]
    rows = df.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown).alias("grown_shard"),
        order_key(key, F.md5(text)).alias("_key"),
        F.lit(1).cast("long").alias("_one"),
        # Tells repeated rows apart, so that a range can end among them.
        F.monotonically_increasing_id().alias("_uid"),
    )
    with Scratch(df.sparkSession) as scratch:
        order = [F.col(c) for c in ("shard", "_key", "doc_id", "_uid")]
        numbered = with_range_sum(scratch.keep(rows, "sharded"), order, "_one", "_before", scratch)
        # The shards' places in the order: a row per shard.
        firsts = numbered.groupBy("shard").agg(F.min("_before").alias("_first"))
        slots = numbered.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_before") - F.col("_first"))
        out = slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
        return scratch.result(out, "shards")
