from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terrace.llm import packing
from terrace.llm.scratch import Scratch
from tests.llm.helpers import docs

JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def verify(rows, pieces, window=2048):
    """Every id of every document in exactly one piece, windows gapless; returns fill."""
    want = Counter((doc_id, tuple(ids_of(text))) for doc_id, text in rows)
    spans, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        spans[p.doc_id, p.doc_tokens].append(p)
        windows[p.sequence_id].append((p.offset, p.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    got = Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
    for (doc_id, ids), n in want.items():
        if n == 1 and sum(d == doc_id and len(i) == len(ids) for d, i in want) == 1:
            at = 0
            for p in sorted(spans[doc_id, len(ids)], key=lambda p: p.start):
                assert p.start == at
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)
    total = sum(len(i) * n for (_, i), n in want.items())
    assert sum(p.length for p in pieces) == total
    assert got
    return total / (len(windows) * window)


def test_every_id_once_and_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    pieces = packing.piece_table(df, JSON).collect()
    assert verify(rows, pieces) > 0.98
    again = packing.piece_table(df.repartition(3), JSON).select(F.col("doc_id"), "start", "length", "ids_crc32").collect()
    small = lambda ps: sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in ps)
    assert small(pieces) == small(again)


def test_shards_stay_small_and_hot_cells_are_spread(spark):
    rows = [(i, "copies of one text " * 30) for i in range(400)] + [(1000 + i, f"other {i} " * 40) for i in range(60)]
    df = docs(spark, rows)
    pieces = packing.piece_table(df, JSON, shard_tokens=8000).collect()
    shards = Counter()
    for p in pieces:
        shards[p.sequence_id >> 32] += p.length
    assert len(shards) > 5 and max(shards.values()) < 3 * 8000
    verify(rows, pieces)


def test_windows_join_neighbours(spark):
    rng = random.Random(3)
    topics = [[f"{t}{rng.randrange(10**6)}" for _ in range(40)] for t in "abcdefgh"]
    rows = [(i, " ".join(rng.choice(topics[i % 8]) for _ in range(60))) for i in range(160)]
    with Scratch(spark) as scratch:
        packed = packing.pack(docs(spark, rows), JSON, scratch, shard_tokens=10**7).collect()
    by_window = defaultdict(list)
    for p in packed:
        by_window[p.sequence_id].append(p.doc_id % 8)
    same = sum(Counter(v).most_common(1)[0][1] for v in by_window.values())
    assert same / sum(map(len, by_window.values())) > 0.75


def test_index_scores_are_bm25():
    pieces = [np.array(x, np.uint32) for x in ([1, 2, 2, 3], [2, 2, 9], [4, 5], [3, 3, 3, 3], [1, 2, 3, 4])]
    idf = np.linspace(0.5, 2.0, 10)
    mean, k1, b = 3.4, 1.2, 0.75
    index = packing.Index(pieces, idf, mean, k1, b)

    def score(seed, doc):
        out = 0.0
        for t in set(pieces[seed].tolist()):
            tf = int((pieces[doc] == t).sum())
            out += idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(pieces[doc]) / mean)) if tf else 0
        return out

    free = np.array([False, True, True, True, True])
    want = sorted((d for d in range(1, 5) if score(0, d)), key=lambda d: -score(0, d))
    assert index.neighbours(0, free, 64).tolist() == want
    free[want[0]] = False
    assert index.neighbours(0, free, 64).tolist() == want[1:]


@pytest.mark.parametrize("window", [8, 2048])
def test_defined_cases(spark, window):
    rows = [
        (1, None), (2, ""), (3, "x"), (3, "x"), (None, "no id"), (4, "word " * 20_000), (5, "é€😀" * 500),
        (6, "<|endoftext|>"), (7, "a b c d e f g"), (8, "same"), (9, "same"),
    ]
    df = docs(spark, rows).withColumn("ids", F.lit(1)).withColumn("cell", F.lit("x")).withColumn("shard", F.lit(0))
    pieces = packing.piece_table(df, JSON, window=window).collect()
    verify(rows, pieces, window)
    assert sum(p.doc_id == 3 for p in pieces) >= 2
    assert {(p.length, p.doc_tokens) for p in pieces if p.doc_id in (1, 2)} == {(1, 1)}


def test_empty_table(spark):
    assert packing.piece_table(docs(spark, []), JSON).count() == 0
