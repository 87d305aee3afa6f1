"""Small hand-written documents shared by the tests of the training-data operators."""

from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))
