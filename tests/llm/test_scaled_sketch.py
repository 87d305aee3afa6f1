from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.llm import scaled_sketch as s
from tests.llm.helpers import docs, table
from tests.llm.test_importance import words_of


def shingles(text):
    words = words_of(text) or ([text] if text else [])
    runs = [" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, min(1, len(words))))]
    return {hashlib.md5(r.encode()).digest()[:5] for r in runs}


def kept(text, one_in=8):
    found = shingles(text)
    low = {h for h in found if int.from_bytes(h) < 2**40 / one_in}
    return low or ({min(found)} if found else set())


def near(one, two):
    small, large = sorted((one, two), key=len)
    return len(small & large) / len(small) if small else float(not large)


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        one, two, three = kept(text), kept(edited), kept(after)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), b"".join(sorted(one)).hex(),
            b"".join(sorted(two)).hex(), near(one, two), near(one, three),
        ))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def corpus(n=90, seed=8):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "Aébß中" for b in ("", "x", "1", "😀")]
    rows = [(i * 3 - 7, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(200)))) for i in range(n)]
    odd = [None, "", "!!!", "one two", "a b c d e", "  . ", "x" * 50_000, "w v " * 30_000, "w v " * 30_000, "é😀ü"]
    return rows + [(5000 + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_matches_brute_force(spark, partitions):
    rows = corpus()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = docs(spark, rows).repartition(6).withColumn("block", F.lit("b")).withColumn("edge", F.lit(1))
        got = s.neighbours(df)
        assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert table(got) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f g h")] * 3 + [(2, "q r s t u v w x")] + [(None, "m n o p q r s t")] * 2
    got = table(s.neighbours(docs(spark, rows).repartition(3)))
    assert len(got) == 6 and got == brute(rows)
    assert len({r[3] for r in got if r[0] == 1}) == 1


def test_one_row_and_none(spark):
    text = "a b c d e f g h i j k l"
    assert table(s.neighbours(docs(spark, [(4, text)]))) == brute([(4, text)])
    assert s.neighbours(docs(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB1 .é\n", max_size=80), st.text(alphabet="aB1 .é\n", max_size=80), st.integers(1, 9))
def test_sketch_merge_and_edit(one, two, one_in):
    assert s.sketch(one, one_in) == kept(one, one_in)
    assert s.read(s.written(s.sketch(one, one_in))) == s.sketch(one, one_in)
    both = shingles(one) | shingles(two)
    assert s.merge(s.sketch(one, one_in), s.sketch(two, one_in), one_in) == s.sketch_of(both, one_in)
    first, second = s._Document(1, one, one_in), s._Document(2, two, one_in)
    other = s.edited(one, two)
    assert first.row(second)[4] == s.written(s.sketch(other, one_in))


def test_containment_of_unequal_documents():
    """The estimate is near the true containment, however long the other text is."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    whole, part = s.sketch(" ".join(words)), " ".join(words[1000:3000])
    foreign = " ".join(f"v{i}" for i in range(2000))
    assert s.containment(s.sketch(part), whole) == 1
    assert abs(s.containment(s.sketch(part + " " + foreign), whole) - 0.5) < 0.07
    assert s.containment(s.sketch(foreign), whole) == 0


def test_fingerprints_of_texts(spark):
    rows = [(1, "a b c d e f"), (2, None), (3, "A, b c d e f")]
    got = {r.doc_id: r.fingerprint for r in s.fingerprints(docs(spark, rows)).collect()}
    assert got[1] == got[3] == s.written(s.sketch("a b c d e f")) and got[2] == ""
