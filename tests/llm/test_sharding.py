from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from terrace.llm.sharding import rendezvous, shard_documents
from tests.llm.helpers import docs

EQUAL = {s: 1.0 for s in range(8)}


def test_shards_slots_and_checksums(spark):
    data = [(i, f"text {i}") for i in range(3000)]
    data += [(5000, None), (5001, ""), (5002, "é" * 100_000), (7, "again"), (7, "again"), (None, "x")]
    df = docs(spark, data).withColumn("shard", F.lit("clash")).withColumn("slot", F.lit(None).cast("int"))
    got = shard_documents(df, EQUAL).collect()
    assert len(got) == len(data)
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert 0.06 < sum(r.grown_shard == 8 for r in got) / len(got) < 0.17
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and min(counts.values()) > 300
    text = {(i, (t or "")) for i, t in data}
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == sizes
    assert len({r.shard for r in got if r.doc_id == 7}) == 1 and text


def test_weights_share_records_and_only_the_changed_shard_moves(spark):
    keys = spark.range(20_000)
    weights = {0: 1.0, 1: 2.0, 2: 5.0}
    rows = keys.select(
        rendezvous(F.col("id"), weights).alias("a"),
        rendezvous(F.col("id"), {**weights, 2: 2.5}).alias("b"),
        rendezvous(F.col("id"), {0: 1.0, 2: 5.0}).alias("c"),
    ).collect()
    share = Counter(r.a for r in rows)
    assert all(abs(share[s] / 20_000 - w / 8) < 0.02 for s, w in weights.items())
    assert all(r.a == r.b for r in rows if r.a != 2)
    assert all(r.a == r.c for r in rows if r.a != 1)


def test_empty_table(spark):
    assert shard_documents(docs(spark, []), EQUAL).count() == 0
