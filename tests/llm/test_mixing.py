from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrace.llm.mixing import mix_table, mixed
from terrace.llm.running import order_key, with_running_sum
from tests.llm.helpers import docs, table


def brute(rows, weights=(3, 1, 2), share=1.5, epochs=2, seed=17):
    sized = [
        (doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), source, text)
        for doc_id, text, _, source in rows
    ]
    total = defaultdict(int)
    for _, size, source, _ in sized:
        total[source] += size
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, budget = {}, set(names), sum(total.values()) * share
    while left:
        rest = budget - sum(target.values())
        part = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if part[s] > epochs * total[s]}
        if not over:
            target.update(part)
            break
        target.update({s: epochs * total[s] for s in over})
        left -= over
    queued, sent = [], defaultdict(int)
    for name in names:
        def place(r):
            inner = hashlib.md5((r[3] or "").encode()).hexdigest()
            key = f"{seed}|{chr(92) + 'N' if r[0] is None else r[0]}|{inner}"
            return hashlib.md5(key.encode()).hexdigest()
        queue, start = sorted((r for r in sized if r[2] == name), key=place), 0
        for i, r in enumerate(queue):
            for n in range(epochs):
                finish = (n * total[name] + start + r[1]) / weight[name]
                queued.append((finish, name is None, (name or "").encode(), n, i, r))
            start += r[1]
    left = int(budget)
    for _, _, _, _, i, r in sorted((q for q in queued if q[5][1]), key=lambda q: q[:5]):
        step = min(left, r[1])
        sent[r[2], i] += step
        left -= step
    out = []
    for q in queued:
        if q[3] == 0:
            name, r = q[5][2], q[5]
            out.append((r[0], r[1], total[name], target[name], sent[name, q[4]]))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[1], r[2], r[4])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert (g[0], g[1], g[2], g[4]) == (w[0], w[1], w[2], w[4])
        assert g[3] == pytest.approx(w[3])


def rows(n, sources):
    return [(i, " ".join(["w"] * ((i * 7) % 23)), "en", sources[i % len(sources)]) for i in range(n)]


def test_matches_brute_force(spark):
    data = rows(300, ["b", "a", None, "é", "B"]) + [
        (1000, None, "en", "a"), (1001, "", "en", "empty"), (1002, "x " * 5000, "en", "long"),
        (7, "w w", "en", "a"), (7, "w w", "en", "a"), (None, "n n n", "en", None),
    ]
    same([tuple(r) for r in mix_table(docs(spark, data)).collect()], brute(data))


def test_hot_source_and_reruns(spark):
    data = rows(2000, ["hot"] * 9 + ["cold"])
    df = docs(spark, data).withColumn("size", F.lit(-1)).withColumn("target", F.lit("x"))
    first = table(mix_table(df))
    assert first == table(mix_table(df.repartition(11)))
    same(first, brute(data))


def test_one_source_takes_its_share_and_tiny_sources_two_rounds(spark):
    same([tuple(r) for r in mix_table(docs(spark, rows(50, ["only"]))).collect()], brute(rows(50, ["only"])))
    data = rows(200, ["big"]) + [(900, "a b c", "en", "a"), (901, "d", "en", "z")]
    got = {r.doc_id: r.taken for r in mix_table(docs(spark, data)).collect()}
    assert got[900] == 6 and got[901] == 2


def test_each_source_comes_near_its_target(spark):
    data = rows(3000, ["a"] * 5 + ["b", "c", None])
    sums = defaultdict(int)
    for r in mix_table(docs(spark, data)).collect():
        sums[r.target] += r.taken
    for target, taken in sums.items():
        assert abs(target - taken) <= 23


def test_mixed_comes_in_the_order_of_finish_times(spark):
    """With weights 3 and 1, and more of the lighter source, three words of one come to one word
    of the other from the beginning on, in the files' own order."""
    data = [(i, "w", "en", "a" if i % 4 == 0 else "b") for i in range(4000)]
    out = mixed(docs(spark, data), share=0.2)
    files = sorted(out.inputFiles())
    got = [r.source for f in files for r in spark.read.parquet(f).collect()]
    assert len(got) == 800
    for at in range(0, 800, 80):
        assert abs(got[at : at + 80].count("a") - 60) <= 2


def test_mixed_keeps_columns_of_any_name(spark):
    df = docs(spark, rows(60, ["a", "b"]))
    for name in ("_uid", "uid", "row", "size", "taken", "finish", "_source"):
        df = df.withColumn(name, F.lit("own"))
    out = mixed(df)
    assert out.columns == df.columns and out.where("_uid = 'own' and finish = 'own'").count() == out.count()
    want = {r[0]: r[4] for r in brute(rows(60, ["a", "b"]))}
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
    assert {k: v for k, v in want.items() if v} == dict(got)


def test_many_sources(spark):
    data = [(i, "w " * (i % 5), "en", f"host{i % 700}") for i in range(2100)]
    same([tuple(r) for r in mix_table(docs(spark, data)).collect()], brute(data))


def test_empty_and_wordless(spark):
    assert mix_table(docs(spark, [])).count() == 0
    assert table(mix_table(docs(spark, [(1, None, None, "s"), (2, " ", None, "s")]))) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)
    ]


def test_running_sum_crosses_blocks(spark):
    df = spark.range(5000).select(
        (F.col("id") % 2).alias("g"), F.col("id").alias("v"), order_key(F.col("id")).alias("k")
    )
    got = with_running_sum(df, "g", "k", ["v"], "v", "before", 5000).collect()
    for g in (0, 1):
        total = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.k):
            assert r.before == total
            total += r.v
