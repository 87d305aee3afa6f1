from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from terrace.llm.importance import crossing_features, line_features, resample_table, resampled, _Hashed
from tests.llm.helpers import docs, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, ngrams, buckets):
    w = words_of(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]
    return [crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, ngrams=1, buckets=10_000, percent=10, least=20, seed=2024):
    s = Counter(b for _, text in rows for b in features(text, ngrams, buckets))
    t = Counter(b for text in target for b in features(text, ngrams, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    ]
    out = []
    for doc_id, text in rows:
        own = features(text, ngrams, buckets)
        name = "\\N" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(words_of(text))])
    fit = [r for r in out if r[5] >= least]
    order = sorted(fit, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, row in enumerate(order[: percent * len(fit) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=lambda r: tuple(map(str, r)))


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(["Tax", "été", "9a", "b-c", "dog", "_x_"]) for _ in range(rng.randrange(9))) for _ in range(30)]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(12)))) for i in range(n)]


ODD = [
    (500, None), (501, ""), (502, "\n\n .,\n"), (503, "dog " * 40_000), (504, "same\n" * 30), (504, "same\n" * 30),
    (504, "other words\r\n" * 25), (None, "tax " * 25), (None, "tax\n" * 25),
]
TARGET = ["dog tax dog", "9a\nété DOG", None, ""]


def frames(spark, rows, target=TARGET):
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return docs(spark, rows).repartition(5), aim


@pytest.mark.parametrize(("ngrams", "percent", "buckets"), [(1, 10, 10_000), (1, 100, 7), (2, 30, 10_000), (4, 50, 500)])
def test_matches_brute_force(spark, ngrams, percent, buckets):
    rows = corpus() + ODD
    df, aim = frames(spark, rows)
    df = df.withColumn("uid", F.lit("x")).withColumn("weight", F.lit(1)).withColumn("line", F.lit(2))
    got = resample_table(df, aim, ngrams=ngrams, percent=percent, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert table(got) == brute(rows, TARGET, ngrams, buckets, percent)


def test_a_line_in_most_documents(spark):
    rows = [(i, f"hot line of many words\nown {i}") for i in range(300)] + corpus(20)
    df, aim = frames(spark, rows)
    assert table(resample_table(df, aim, least_words=3)) == brute(rows, TARGET, least=3)


def test_lines_and_crossings_make_up_all_runs():
    text = "a b\n\nc\nd e f\ng"
    for ngrams in (1, 2, 3, 5):
        hashed = _Hashed(997)
        lines = [words_of(x) for x in text.split("\n")]
        both = [b for x in lines for b in line_features(x, ngrams, hashed)]
        both += crossing_features(lines, ngrams, hashed)
        assert sorted(both) == sorted(features(text, ngrams, 997))


def test_resampled_keeps_rows_whole(spark):
    rows = corpus() + ODD
    df, aim = frames(spark, rows)
    df = df.withColumn("uid", F.lit("x")).withColumn("row", F.lit(1)).withColumn("rank", F.lit(2))
    out = resampled(df, aim, percent=20)
    assert out.columns == df.columns
    want = [r for r in brute(rows, TARGET, percent=20) if r[4]]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in want)


def test_empty_tables(spark):
    df, aim = frames(spark, [], [])
    assert resample_table(df, aim).count() == 0
    rows = corpus(30)
    df, aim = frames(spark, rows, [])
    assert table(resample_table(df, aim)) == brute(rows, [])
