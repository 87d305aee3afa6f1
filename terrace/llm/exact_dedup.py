"""Exact deduplication that no group of copies can overload.

Texts are equal when identical after deleting ASCII white space. Rows whose 64-bit hash of
the normalised text occurs once are done at once. All others are combined three times, and
each time the full content is part of the grouping key, so that no digest collision can
merge different texts:

1. within the map task (Spark's partial aggregation sends one row per content and task),
2. per digest, salt and content, where the salt spreads a digest over several tasks,
3. per digest and content, over the salt winners.

Each row then meets the winner of its own content; adaptive execution splits that join where
one content holds much of the rows.

Defined results: null text counts as empty and empty texts equal each other; a null id loses
every tie; rows that agree in id and text are copies like any other, one of them stays;
an empty table gives an empty result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.scratch import Scratch

# The characters [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _better() -> Column:
    """Orders copies: more code points, then the smaller id; null ids last."""
    return F.struct("points", F.bitwise_not("id").alias("inverse"))


def winners(rows: DataFrame, salts: int) -> DataFrame:
    """One row per content of (digest, content, points, id): its winner and its size."""
    local = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("digest", "salt", "content").agg(
        F.max(_better()).alias("best"), F.count(F.lit(1)).alias("n")
    )
    return salted.groupBy("digest", "content").agg(
        F.max("best").alias("best"), F.sum("n").alias("group_size")
    )


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(df[text_col], F.lit(""))
    return df.select(
        F.struct("*").alias("row"),
        df[id_col].cast("long").alias("id"),
        F.char_length(text).cast("long").alias("points"),
        normalised(text).alias("content"),
    ).withColumn("hash", F.xxhash64("content"))


def _repeated(hashes: DataFrame) -> DataFrame:
    return hashes.groupBy("hash").count().where("count > 1").select("hash")


def _copies(rows: DataFrame, repeated: DataFrame, salts: int, scratch: Scratch) -> DataFrame:
    """Rows that share their hash with another, with the winner of their content. ``is_best``
    marks the row that stays, and rows that agree with it in id and text."""
    some = rows.join(repeated, "hash", "left_semi").withColumn("digest", F.sha2("content", 256))
    # Written, so that both sides of the join are plain shuffles, which Spark can split.
    best = scratch.keep(winners(some, salts), "winners")
    met = some.join(best, ["digest", "content"])
    return met.withColumn("is_best", _better() == F.col("best"))


def _first_of(*key: str) -> Column:
    return F.row_number().over(Window.partitionBy(*key).orderBy("id")) == 1


def copy_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    with Scratch(df.sparkSession) as scratch:
        rows = _rows(df, id_col, text_col)
        narrow = scratch.keep(
            rows.select("id", "hash", F.sha2("content", 256).alias("digest")), "digests"
        )
        repeated = scratch.keep(_repeated(narrow), "repeated")
        single = narrow.join(repeated, "hash", "left_anti").select(
            "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), "digest",
        )
        met = _copies(rows.drop("row"), repeated, salts, scratch).drop("content", "points")
        copies = met.select(
            "id", F.bitwise_not("best.inverse").alias("keep_id"), "group_size",
            (F.col("is_best") & _first_of("digest", "id", "is_best")).alias("kept"), "digest",
        )
        out = single.unionByName(copies)
        return scratch.result(
            out.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"}), "copy-groups"
        )


def survivors(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """The rows that stay, with all their columns."""
    with Scratch(df.sparkSession) as scratch:
        rows = _rows(df, id_col, text_col)
        repeated = scratch.keep(_repeated(rows.select("hash")), "repeated")
        single = rows.join(repeated, "hash", "left_anti").select("row")
        best = _copies(rows, repeated, salts, scratch).where("is_best")
        one = best.withColumn("first", _first_of("digest", "content")).where("first").select("row")
        return scratch.result(single.unionByName(one).select("row.*"), "survivors")
