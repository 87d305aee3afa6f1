from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.llm import order_minhash as omh
from tests.llm.helpers import docs


def distance(a, b):
    row = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        step = np.minimum(row[:-1] + (np.asarray(b) != x), row[1:] + 1)
        row = np.minimum.accumulate(np.concatenate([[i], step]) - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
    return int(row[-1])


sequences = st.lists(st.integers(0, 4), max_size=40)


@settings(max_examples=500, deadline=None)
@given(sequences, sequences, st.integers(0, 45))
def test_banded_alignment_matches_full_alignment(a, b, limit):
    want = distance(a, b)
    assert omh.edit_distance_within(a, b, limit) == (want if want <= limit else None)


@settings(max_examples=300, deadline=None)
@given(sequences, st.lists(st.tuples(st.integers(0, 39), st.integers(0, 4), st.integers(0, 2)), max_size=9))
def test_similarity_test_matches_full_alignment(a, edits):
    b = list(a)
    for place, word, kind in edits:
        b[place : place + (kind > 0)] = [word] if kind < 2 else []
    want = distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9
    assert omh.similar(np.array(a, np.uint32), np.array(b, np.uint32), 0.8) == want


@settings(max_examples=500, deadline=None)
@given(sequences, st.lists(st.tuples(st.integers(0, 39), st.integers(0, 400), st.integers(0, 2)), max_size=9))
def test_bags_let_all_similar_pairs_pass(a, edits):
    b = list(a)
    for place, word, kind in edits:
        b[place : place + (kind > 0)] = [word] if kind < 2 else []
    left, right = (omh.unpacked(pa.array([omh.bag(np.array(x, np.uint32))])) for x in (a, b))
    may = omh.may_be_similar(left, right, np.array([len(a)]), np.array([len(b)]), 0.8)
    assert may[0] or distance(a, b) > omh.allowed_edits(max(len(a), len(b)), 0.8)


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def edited(rng, text, rate):
    out = []
    for w in text:
        r = rng.random()
        if r < rate / 3:
            continue
        out.append(words(rng, 1)[0] if r < 2 * rate / 3 else w)
        if 2 * rate / 3 <= r < rate:
            out.append(words(rng, 1)[0])
    return out


def test_recall_of_the_sketches():
    rng = random.Random(4)

    def share(rate, n=300):
        found = 0
        for _ in range(n):
            a = words(rng, 120)
            b = edited(rng, a, rate)
            _, _, keys = omh.sketch_texts([" ".join(a), " ".join(b)], 5, 64)
            found += bool((keys[0] == keys[1]).any())
        return found / n

    assert share(0.05) == 1.0
    assert share(0.13) > 0.97
    assert share(0.2) > 0.8


def test_sketches_see_order_and_repeats():
    rng = random.Random(5)
    a = words(rng, 200)
    swapped = [w for i in range(0, 200, 20) for w in a[180 - i : 200 - i]]
    _, _, keys = omh.sketch_texts([" ".join(a), " ".join(swapped), " ".join(a), " ".join(a + a)], 5, 64)
    assert (keys[0] == keys[2]).all()
    # The swapped text has nearly the same k-mers, yet agrees in far fewer sketches.
    assert (keys[0] == keys[1]).mean() < 0.6
    assert (keys[0] == keys[3]).mean() < 0.9


def brute(rows, threshold=0.8):
    content = [omh.normalised(t).split() for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = content[i], content[j]
            if a and b and distance(a, b) <= (1 - threshold) * max(len(a), len(b)) + 1e-9:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def classes(df):
    return {r.doc_id: r.class_id for r in omh.near_classes(df).collect()}


def corpus(seed=6):
    rng = random.Random(seed)
    passage = words(rng, 50)
    rows = []
    for _ in range(40):
        base = words(rng, rng.randint(60, 200))
        for _ in range(rng.randint(1, 5)):
            rows.append(edited(rng, base, rng.choice([0, 0.02, 0.05, 0.08])))
    hot = words(rng, 150)
    rows += [edited(rng, hot, 0.05) for _ in range(60)]
    # Unrelated texts around a passage that they share.
    rows += [words(rng, 80) + passage + words(rng, 80) for _ in range(60)]
    rows += [words(rng, n) for n in (1, 1, 2, 3, 4, 5, 6)]
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_classes_match_brute_force(spark):
    rows = corpus()
    got = classes(docs(spark, rows).repartition(7))
    want = brute(rows)
    assert sum(got[i] == want[i] for i in range(len(rows))) >= 0.99 * len(rows)
    # Nothing unlike is joined: every class of ours lies within one of theirs.
    assert all(want[i] == want[got[i]] for i in range(len(rows)))


def template_texts(seed, strangers):
    """Texts of 150 template and 50 own words; the last two differ in every third own word."""
    rng = random.Random(seed)
    template, own = words(rng, 150), words(rng, 50)
    other = [words(rng, 1)[0] if i % 3 == 0 else w for i, w in enumerate(own)]
    texts = [template + words(rng, 50) for _ in range(strangers)] + [template + own, template + other]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("strangers", [1, 10, 60])
def test_pairs_under_a_shared_template_are_found(spark, strangers):
    rows = template_texts(3, strangers)
    got = classes(docs(spark, rows).repartition(3))
    assert got[strangers + 1] == strangers and len(set(got.values())) == strangers + 1


def test_blocks_find_what_brute_force_finds(spark, monkeypatch):
    monkeypatch.setattr(omh, "BLOCK", 7)
    rows = [(i, t) for i, (_, t) in enumerate(template_texts(4, 30) + corpus()[-80:])]
    got = classes(docs(spark, rows).repartition(3))
    want = brute(rows)
    assert all(got[i] == want[i] for i in range(len(rows)))


@settings(max_examples=500, deadline=None)
@given(
    st.lists(st.integers(0, 30), min_size=1, max_size=59),
    st.lists(st.tuples(st.integers(0, 58), st.integers(0, 30), st.integers(0, 2)), max_size=14),
    st.dictionaries(st.integers(0, 30), st.integers(0, 99)),
)
def test_similar_short_texts_share_a_rare_word(a, edits, ranks):
    b = list(a)
    for place, word, kind in edits:
        b[place : place + (kind > 0)] = [word] if kind < 2 else []
    if b and distance(a, b) <= omh.allowed_edits(max(len(a), len(b)), 0.8):
        assert len(b) < omh.shortest_long(0.8)
        keys = [set(omh.rare_word_keys(np.array(x, np.uint32), ranks, 0.8)) for x in (a, b)]
        assert keys[0] & keys[1]


def test_short_texts_match_brute_force(spark):
    rng = random.Random(8)
    common = words(rng, 12)
    rows = []
    for n in [*range(5, 13), 20, 30, 45, 59]:
        for _ in range(4):
            text = [rng.choice(common) if rng.random() < 0.4 else w for w in words(rng, n)]
            middle = [*text[: n // 2], words(rng, 1)[0], *text[n // 2 + 1 :]]
            spread = [words(rng, 1)[0] if i % 5 == 2 and i // 5 < n // 5 else w for i, w in enumerate(text)]
            rows += [text, middle, spread]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    got = classes(docs(spark, rows).repartition(3))
    want = brute(rows)
    assert all(got[i] == want[i] for i in range(len(rows)))


def test_unlike_candidates_send_no_words(spark, monkeypatch):
    """Each two texts have a third of their words in common, rare ones among them."""
    rng = random.Random(9)
    rows = []
    for _ in range(40):
        both = words(rng, 10)
        rows += [both + words(rng, 20), both + words(rng, 20)]
    rows += [rows[0][:29], rows[5][1:]]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    sent, verified = [], omh._verified

    def count(pairs, texts, threshold):
        sent.append((pairs.count(), texts.count()))
        return verified(pairs, texts, threshold)

    monkeypatch.setattr(omh, "_verified", count)
    got = classes(docs(spark, rows).repartition(3))
    assert {i: c for i, c in got.items() if c != i} == {80: 0, 81: 5}
    assert max(pairs for pairs, _ in sent) == 2 and max(texts for _, texts in sent) == 4


def test_members_of_large_groups_without_partner_send_no_words(spark, monkeypatch):
    """Sixty texts share a passage and little else; two are alike."""
    rng = random.Random(10)
    template, own = words(rng, 100), words(rng, 100)
    rows = [template + words(rng, 100) for _ in range(60)] + [template + own, template + edited(rng, own, 0.1)]
    members, keep = [], omh.Scratch.keep

    def count(self, df, label, rows=None):
        out = keep(self, df, label, rows)
        if label == "blocks":
            members.append(out.select("uid").distinct().count())
        return out

    monkeypatch.setattr(omh.Scratch, "keep", count)
    got = classes(docs(spark, [(i, " ".join(r)) for i, r in enumerate(rows)]).repartition(3))
    assert got[61] == 60 and len(set(got.values())) == 61
    assert len(members) == 1 and members[0] < 10


ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "!!!"), (5, "!!! "), (6, "One two, three."), (7, "one TWO three"),
    (8, "a"), (9, "a " * 30_000), (10, "a " * 30_000 + "b"), (11, "same text here again now"),
    (11, "same text here again now"), (None, "same text here again now"), (None, "lone words of no id at all"),
    (12, "x" * 200_000), (13, "日本語 テキスト"),
]


def test_defined_cases(spark):
    df = docs(spark, ODD).withColumn("uid", F.lit("clash")).withColumn("digest", F.lit(1)).withColumn("kept", F.lit(0))
    rows = omh.near_classes(df).collect()
    assert len(rows) == len(ODD)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.class_id, r.class_size, r.kept))
    assert all(of[i] == [(i, 1, True)] for i in (1, 2, 3, 8, 12, 13))
    assert of[4] == [(4, 2, True)] and of[5] == [(4, 2, False)]
    assert of[6] == [(6, 2, True)] and of[7] == [(6, 2, False)]
    assert of[10] == [(9, 2, False)]
    assert sorted(of[11]) == [(11, 3, False), (11, 3, True)]
    assert sorted(of[None], key=str) == sorted([(11, 3, False), (None, 1, True)], key=str)
    kept = omh.survivors(df)
    assert kept.columns == df.columns
    want = sorted(str(r.doc_id) for r in rows if r.kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(spark):
    assert omh.near_classes(docs(spark, [])).count() == 0
    assert omh.survivors(docs(spark, [])).count() == 0
