from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terrace.llm import encoders
from terrace.llm.token_counts import count_tokens
from tests.llm.helpers import docs, table

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_fast_path_is_in_use_and_gives_the_library_ids(spark, library):
    assert encoders._byte_level is not None
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ["", " ", "\n\n  \t", "<|endoftext|>", "a<|endoftext|> b", " " * 400_000, "a" * 50_000, "don't 12,5€ 😀‍"]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoders.load(JSON)(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'stré<|endoftext>1")), max_size=60))
def test_fast_path_on_odd_texts(text):
    want = Tokenizer_cached().encode(text, add_special_tokens=False).ids
    assert encoders.load(JSON)([text])[0].tolist() == want


def Tokenizer_cached(_cache=[]):
    if not _cache:
        _cache.append(Tokenizer.from_file(JSON))
    return _cache[0]


ROWS = [(1, "some text"), (2, None), (3, ""), (4, "some text"), (5, "word " * 600), (5, "word " * 600), (None, "é€ 😀"),
        (6, "x y " * 40_000)]


def want(library, rows, limit=512):
    out = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def test_counts_and_cache(spark, library, tmp_path):
    cache = str(tmp_path / "cache")
    df = docs(spark, ROWS).withColumn("content", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    assert table(count_tokens(df, JSON, cache)) == want(library, ROWS)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in ROWS})
    more = [*ROWS, (9, "another text")]
    assert table(count_tokens(docs(spark, more), JSON, cache, limit=1)) == want(library, more, 1)
    assert spark.read.parquet(cache).count() == stored.count() + 1
    # Hits are taken from the cache and not encoded again.
    spark.createDataFrame([(bytearray(range(32)), "x", 5)], stored.schema).write.mode("append").parquet(cache)
    assert table(count_tokens(docs(spark, more), JSON, cache)) == want(library, more)
    assert spark.read.parquet(cache).count() == stored.count() + 2


def test_other_tokenizers_have_their_own_counts(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), [(1, "some text here"), (2, None)]
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    json_counts = table(count_tokens(docs(spark, rows), JSON, cache))
    got = table(count_tokens(docs(spark, rows), model, cache))
    assert [r[2] for r in got] == [len(pieces.encode("some text here")), 0]
    words = public_tokenizers.path("word_bpe_49k.json")
    n = len(Tokenizer.from_file(words).encode("some text here", add_special_tokens=False).ids)
    assert table(count_tokens(docs(spark, rows), words, cache))[0][2] == n
    assert table(count_tokens(docs(spark, rows), JSON, cache)) == json_counts


def test_empty_table(spark, tmp_path):
    assert count_tokens(docs(spark, []), JSON, str(tmp_path / "cache")).count() == 0
