from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.scratch import Scratch
from terrace.llm.vector_forest import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    vec_id, vector, label = row
    if vec_id is None or label is None or not vector or any(x is None for x in vector):
        return False
    v = np.asarray(np.float32(vector), np.float64)
    return bool(np.isfinite(v).all() and (v != 0).any())


def brute(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) per row, in input order, and all links."""
    good = [i for i, r in enumerate(rows) if usable(r)]
    near = {i: [] for i in good}
    for label in {rows[i][2] for i in good}:
        for dims in {len(rows[i][1]) for i in good}:
            at = [i for i in good if rows[i][2] == label and len(rows[i][1]) == dims]
            if not at:
                continue
            v = np.array([np.float32(rows[i][1]) for i in at], np.float64)
            v = v / np.abs(v).max(axis=1, keepdims=True)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            a, b = np.nonzero(v @ v.T >= threshold)
            for x, y in zip(a, b, strict=True):
                if x != y:
                    near[at[x]].append(at[y])
    root = {}
    for i in good:
        if i in root:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen)
        root.update(dict.fromkeys(seen, least))
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        component = root.get(i, vec_id)
        out.append((vec_id, len(near.get(i, [])), component, vec_id is not None and vec_id == component))
    return out


def got(spark, rows, **options):
    return [tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA), **options).collect()]


def key(r):
    return tuple(map(str, r))


def clustered(n, dims=24, labels=3, noise=0.05, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dims))
    picked = rng.integers(0, len(centres), n)
    points = centres[picked] + noise * rng.standard_normal((n, dims)) * rng.integers(0, 6, (n, 1))
    return [(i, [float(x) for x in np.float32(p)], int(c % labels)) for i, (p, c) in enumerate(zip(points, picked, strict=True))]


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 40, "sample": 300, "trees": 12}])
def test_recall_and_precision_against_brute_force(spark, options):
    rows = clustered(1500)
    want, found = {r[0]: r for r in brute(rows)}, {r[0]: r for r in got(spark, rows, **options)}
    assert set(found) == set(want)
    assert all(found[i][1] <= want[i][1] for i in want)
    links = sum(r[1] for r in want.values())
    assert links > 1000 and sum(r[1] for r in found.values()) >= 0.98 * links
    right = sum(found[i][2] == want[i][2] for i in want)
    assert right >= 0.98 * len(want)


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want, found = brute(rows), [tuple(r) for r in near_vectors(df).collect()]
    links = sum(r[1] for r in want)
    assert sum(r[1] for r in found) >= 0.9 * links
    assert len(found) == len(want)


def test_dense_cluster_in_blocks_counts_each_pair_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.5, *(0.01 * rng.standard_normal(4)).tolist()], 1) for i in range(300)]
    rows += [(1000 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 1) for i in range(200)]
    found = got(spark, rows, leaf_rows=32, sample=64)
    assert sorted(found, key=key) == sorted(brute([(a, [float(np.float32(x)) for x in b], c) for a, b, c in rows]), key=key)
    assert all(r[1] == 499 for r in found)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, nan], 1), (9, [inf, 1.0], 1), (10, [1.0, None], 1),
        (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1),
        (13, [-1.0, 0.0], 1), (14, [1e38, 1e30], 1), (15, [1e-38, 0.0], 1), (16, [0.0, -0.0], 1),
        (17, [-0.0, 1.0], 1), (18, [0.0, 1.0], 1),
    ]
    assert sorted(got(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)], SCHEMA)
    df = df.withColumn("uid", F.lit("x")).withColumn("values", F.lit(0)).withColumn("kept", F.lit(1))
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 300)]
    edges += [(500, 501), (501, 502), (502, 500), (500, 501)]
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(edges, "a long, b long").repartition(5)
        got = {r.node: r.root for r in components(df, scratch).collect()}
        assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {i: 500 for i in range(500, 503)}
    assert got == want
