from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from terrace.llm import warc
from terrace.llm.scratch import Scratch
from tests.llm.helpers import table


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        response = first.get(html or "", page_id)
        again = response != page_id
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", response if again else None, True))
    return sorted(out, key=lambda r: tuple(map(str, r)))


ROWS = [
    (1, "http://a/", "plain"), (2, None, "plain"), (3, "http://b/\r\nX: y", None), (4, "http://c/", ""),
    (5, "http://d/", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nfoo\r\n\r\n"), (6, "http://e/", "é€😀" * 9000),
    (7, "http://e/", "é€😀" * 9000), (8, "u", "0\r\n\r\n" * 5000), (9, "u", "x" * 32768), (9, "u", "x" * 32768),
    (10, "u", "y" * 131072), (None, "u", "plain"), (None, "u", "lone"), (11, "u", "z" * 1_000_000),
    (12, "u", "z" * 1_000_000), (12, "u", "z" * 1_000_000), (0, "u", "z" * 1_000_000), (13, "", "\x00\x01 \t"),
]


@pytest.mark.parametrize("sizes", [(32768, 8192), (100, 7), (1 << 22, 1 << 22)])
def test_round_trip(spark, sizes):
    rows = ROWS if sizes[0] > 100 else [r for r in ROWS if len(r[2] or "") < 60_000]
    df = pages(spark, rows).withColumn("digest", F.lit("clash")).withColumn("segment", F.lit(9))
    got = warc.round_trip(df, segment_bytes=sizes[0], chunk_bytes=sizes[1], archive_records=64)
    assert table(got) == brute(rows)


def test_records_are_well_formed(spark, tmp_path):
    with Scratch(spark) as scratch:
        warc.write_archives(pages(spark, ROWS[:8]), str(tmp_path / "w"), scratch, 1000, 64, compression="none")
    files = sorted((tmp_path / "w").glob("part-*"))
    assert all(f.read_bytes()[:8] == b"WARC/1.1" for f in files if f.stat().st_size)
    records = [r for f in files for r in warc.parse(f.read_bytes(), str(f))]
    assert sum(r["type"] != "continuation" for r in records) == 8
    long = [r for r in records if r["segment"]]
    assert all(len(r["block"]) <= 1000 for r in long) and any(r["segment"] > 5 for r in long)
    assert all((r["origin"] is None) == (r["segment"] == 1) for r in long)


def record(segment, block, total=None, origin="o"):
    own = "o" if segment == 1 else f"c{segment}"
    return (own, "response" if segment == 1 else "continuation", 1 if segment == 1 else None, None, None, None,
            None if segment == 1 else origin, segment, total, bytearray(block))


def test_reassembly_orders_and_verifies(spark):
    def done(*records):
        df = spark.createDataFrame(list(records), warc.RECORD_SCHEMA).repartition(3)
        return [(r.record_id, bytes(r.block) if r.block is not None else None, r.complete) for r in warc.reassemble(df).collect()]

    parts = [record(i, bytes([65 + i]) * 3, 36 if i == 12 else None) for i in range(1, 13)]
    whole = b"".join(bytes([65 + i]) * 3 for i in range(1, 13))
    random.Random(1).shuffle(parts)
    assert done(*parts) == [("o", whole, True)]
    assert done(*parts, parts[3]) == [("o", whole, True)]
    assert done(*[p for p in parts if p[7] != 5]) == [("o", None, False)]
    assert done(*[p for p in parts if p[7] != 12]) == [("o", None, False)]
    assert done(record(1, b"ab"), record(2, b"cd", 5)) == [("o", None, False)]
    assert done(record(2, b"cd", 2)) == [("o", None, False)]


def test_broken_archives_and_chunks():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc", "p"))
    with pytest.raises(ValueError):
        warc.unframe(b"H\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab\r\n0\r\n\r\n")
    assert warc.unframe(b"H\r\nTransfer-Encoding: Chunked\r\n\r\n2;x=y\r\nab\r\n1\r\nc\r\n0\r\n\r\n") == b"abc"
    assert warc.unframe(b"H\r\n\r\nplain") == b"plain"


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0
