from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from terrace.llm import language_id
from tests.llm.helpers import docs

SF = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def fitted(spark):
    return language_id.fit(spark.read.parquet(SF))


def test_held_out_accuracy_and_few_rejections(spark, fitted):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(SF).collect()}
    rows = [r for r in language_id.predict(spark.read.parquet(SF), fitted).collect()]
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_fit_reads_only_training_documents(spark):
    df = spark.read.parquet(SF)
    model = language_id.fit(df)
    blind = df.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert language_id.fit(blind) == model
    assert language_id.fit(df.repartition(7)) == model
    assert all(len(content) <= 256 * 4 * 402 for _, content in model.dictionaries)


def test_prediction_sees_the_text_only_and_all_of_it(fitted):
    english, french = ("the and of with that erhaing onea thnd " * 40, "le de la éaux queaux éoucha les dans " * 400)
    assert language_id.identify(fitted, english)[0] == "en"
    assert language_id.identify(fitted, english + french)[0] == "fr"


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "12 %% 34"), (5, "a"), (6, "the and of " * 60_000), (7, "²³"),
    (None, "the and of the erhaing"), (5, "a"), (8, "日本語"),
]


def test_defined_cases(spark, fitted):
    df = docs(spark, ODD).withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    rows = language_id.predict(df, fitted).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True) for i in (1, 2, 3, 4, 7))
    assert by_id[6].lang_pred == "en" and not by_id[6].rejected
    assert by_id[None].held_out is False
    kept = language_id.identified(df, fitted)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if not r.rejected)


def test_narrow_margins_are_rejected():
    model = language_id.Model((("a", b"xyzw " * 40), ("b", b"xyzw " * 40)))
    lang, score, margin, rejected = language_id.identify(model, "xyzw xyzw qq")
    assert (lang, score, margin, rejected) == ("a", 0.5, 0.0, True)
    one = language_id.Model((("a", b"xyzw " * 40),))
    assert language_id.identify(one, "xyzw")[0::3] == ("a", False)


def test_nothing_to_learn_from_and_empty_table(spark):
    rows = [(1, "text", None), (2, None, "en"), (None, "text", "en")]
    model = language_id.fit(docs(spark, rows))
    assert model.dictionaries == ()
    assert {r.lang_pred for r in language_id.predict(docs(spark, rows), model).collect()} == {"und"}
    assert language_id.predict(docs(spark, []), language_id.fit(docs(spark, []))).count() == 0
    assert language_id.identified(docs(spark, []), model).count() == 0


def test_predictions_match_brute_force(spark, fitted):
    """Sizes by a new compressor for every block, words by a pattern on the text."""
    import math
    import re

    import zstandard

    def blocks(text):
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.lower())
        data = (" " + " ".join(words) + " ").encode()
        return [data[i : i + 4096] for i in range(0, len(data), 4096)]

    def size(content, block):
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one = zstandard.ZstdCompressor(level=6, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(one.compress(b" " * 64 + block))

    picked = spark.read.parquet(SF).orderBy(F.char_length("text")).limit(40).union(
        spark.read.parquet(SF).orderBy(F.char_length("text").desc()).limit(3)
    )
    rows = [(r.doc_id, r.text) for r in picked.collect()] + [(-1, None), (-2, ""), (-3, "12 !"), (-4, "ЖЖ abc")]
    got = {r.doc_id: r for r in language_id.predict(docs(spark, rows), fitted).collect()}
    for doc_id, text in rows:
        r = got[doc_id]
        if text is None or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        totals = {lang: sum(size(content, b) for b in blocks(text)) for lang, content in fitted.dictionaries}
        best = min(totals, key=lambda lang: (totals[lang], lang))
        gaps = [t - totals[best] for lang, t in totals.items() if lang != best]
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / (1 + sum(math.exp(-g / 4) for g in gaps)))
        assert r.rejected == (min(gaps) / totals[best] < 0.005)
