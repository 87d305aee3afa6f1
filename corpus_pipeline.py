"""The training-data pipeline: stages over documents, each written before the next reads it.

A stage takes whatever its predecessor kept and returns the columns of documents; the last
one returns the pieces of the training sequences. Nulls, empty texts, repeated rows and empty
tables mean in each stage what they mean in its operator.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import exact_dedup, language_id, mixing, order_minhash, packing
from terrace.llm.scratch import Scratch
from terrace.sources.paths import delete

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"

class _Returned(threading.local):
    """Folders of the tables that the stages of one run have returned. The pipeline writes each
    table before it calls the next stage, which can therefore delete it. Runs side by side are in
    threads of their own, and so are their lists."""

    def __init__(self):
        self.folders: list[str] = []


_returned = _Returned()


def _drop_returned(spark: SparkSession) -> None:
    while _returned.folders:
        delete(spark, _returned.folders.pop())


def _returning(result: DataFrame) -> DataFrame:
    """Remember the folder of a table that an operator has written for its caller."""
    _returned.folders.extend({file.rsplit("/", 1)[0] for file in result.inputFiles()})
    return result


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not clear go."""
    _drop_returned(spark)
    return language_id.identified(docs, language_id.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    _drop_returned(spark)
    return _returning(exact_dedup.survivors(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts stays."""
    _drop_returned(spark)
    return _returning(order_minhash.survivors(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a cut one has its own number of characters."""
    _drop_returned(spark)
    mixed = _returning(mixing.mixed(docs))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 ids, with the ids."""
    _drop_returned(spark)
    with Scratch(spark) as scratch:
        packed = packing.pack(docs, public_tokenizers.path(TOKENIZER), scratch)
        return scratch.result(packed, "sequences")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Compression, sketches and tokens have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
        name, stage = STAGES[-1]
        return stage(spark, docs, sf_dir)
