"""Running sums over groups of any size, without a group ever meeting in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.scratch import Scratch

# About how many rows share the smallest cell of the order.
CELL_ROWS = 64


def order_key(*parts: Column) -> Column:
    """A hexadecimal digest of the parts: a fixed, evenly spread order. Nulls differ from
    empty strings."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))


def with_running_sum(
    df: DataFrame, group: str, order: str, ties: list[str], value: str, out: str, rows: int
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come before.

    ``order`` is an ``order_key`` column; equal keys are ordered by ``ties``. ``group`` must
    not be null. The digest space is cut into cells of about 64 of the ``rows`` rows and
    these into blocks, about as many as a block has cells. Sums are taken over the cells of
    a block, over the blocks of a group, and over the rows of a cell, so the largest window
    grows with the square root of the rows.
    """
    cells = max(1, min(2**32, math.ceil(rows / CELL_ROWS)))
    per_block = math.ceil(math.sqrt(cells))
    head = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    cell = F.shiftright(head * F.lit(cells), 32)
    df = df.withColumn("_cell", cell).withColumn("_block", F.floor(F.col("_cell") / per_block))
    before = (Window.unboundedPreceding, -1)

    in_cells = df.groupBy(group, "_block", "_cell").agg(F.sum(value).alias("_sum"))
    in_blocks = in_cells.groupBy(group, "_block").agg(F.sum("_sum").alias("_sum"))
    blocks = in_blocks.select(
        group, "_block",
        _sum_before("_sum", Window.partitionBy(group).orderBy("_block").rowsBetween(*before)).alias("_base"),
    )
    cells_before = in_cells.select(
        group, "_block", "_cell",
        _sum_before("_sum", Window.partitionBy(group, "_block").orderBy("_cell").rowsBetween(*before)).alias("_start"),
    ).join(blocks, [group, "_block"])
    starts = cells_before.select(group, "_cell", (F.col("_base") + F.col("_start")).alias("_start"))

    within = Window.partitionBy(group, "_cell").orderBy(order, *ties).rowsBetween(*before)
    summed = df.drop("_block").withColumn(out, _sum_before(value, within))
    met = summed.join(starts, [group, "_cell"])
    return met.withColumn(out, F.col(out) + F.col("_start")).drop("_cell", "_start")


def _sum_before(value: str, window) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("long"))


def with_range_sum(
    df: DataFrame, order: list[Column], value: str, out: str, scratch: Scratch
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows that come before in the global order.

    Rows are sorted globally: dealt by ranges of ``order``, which must tell all rows apart, into
    the partitions of a shuffle. Each is a block; sums are taken over the rows of a block and over
    the blocks, of which there are as many as shuffle partitions.
    """
    dealt = df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    rows = scratch.keep(dealt, "range")
    before = (Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_block").agg(F.sum(value).alias("_sum")).select(
        "_block", _sum_before("_sum", Window.orderBy("_block").rowsBetween(*before)).alias("_base")
    )
    within = Window.partitionBy("_block").orderBy(*order).rowsBetween(*before)
    summed = rows.withColumn(out, _sum_before(value, within))
    met = summed.join(F.broadcast(blocks), "_block")
    return met.withColumn(out, F.col(out) + F.col("_base")).drop("_block", "_base")
