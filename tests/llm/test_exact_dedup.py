from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from terrace.llm.exact_dedup import copy_groups, survivors
from tests.llm.helpers import docs, table


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for content, members in groups.items():
        ranked = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        digest = hashlib.sha256(content.encode()).hexdigest()
        for place, (doc_id, _) in enumerate(ranked):
            out.append((doc_id, ranked[0][0], len(ranked), place == 0, digest))
    return sorted(out, key=lambda r: tuple(map(str, r)))


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " \x0b\x0c\r\n"), (7, "a b"),
    (8, "x" * 300_000), (9, "x" * 150_000 + " " + "x" * 150_000), (10, "é€😀"), (11, "é€ 😀"),
    (12, "same"), (12, "same"), (12, "same"), (13, "same "), (13, "same "), (None, "ab  "),
    (None, "lone"), (None, "twin"), (None, "twin"),
]


def test_groups_match_brute_force(spark):
    assert table(copy_groups(docs(spark, ROWS).repartition(5))) == brute(ROWS)


def test_hot_group_and_salts(spark):
    rows = [(i, "hot text" + " " * (i % 7)) for i in range(400)] + [(1000 + i, f"t{i}") for i in range(50)]
    df = docs(spark, rows).repartition(13)
    for salts in (1, 4):
        assert table(copy_groups(df, salts=salts)) == brute(rows)


def test_survivors_keep_all_columns_and_one_row_of_each_group(spark):
    df = docs(spark, ROWS).withColumn("digest", F.lit(1)).withColumn("hash", F.lit("h"))
    df = df.withColumn("kept", F.lit(None).cast("string"))
    out = survivors(df)
    assert out.columns == df.columns
    want = sorted(str(r[0]) for r in brute(ROWS) if r[3])
    assert sorted(str(r.doc_id) for r in out.collect()) == want


def test_empty_table(spark):
    assert copy_groups(docs(spark, [])).count() == 0
    assert survivors(docs(spark, [])).count() == 0
