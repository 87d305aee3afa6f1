"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order, up to ``epochs`` times over.
The virtual finish time of a document is the words its source has sent up to and with it,
divided by the source's weight. All documents of all queues are sorted globally by that time
and sent until the budget is used; the one on the budget's edge is cut at a word. So sources
take turns, each sends in proportion to its weight from the first document on, and one whose
epochs run out leaves its share to the others. The sort is a range partitioning; what has been
sent before a document is summed over the ranges, then within them.

Targets are what the budget gives each source by weight: a source that cannot send so much,
``epochs`` times its size, gets that, and the others share the rest, until none is above.

Defined results: null text has size 0 and is sent with 0 words; a null source is a source of
its own and comes last; documents without words take nothing and are not queued; repeated rows are
queued one after the other; equal digests are ordered by id; equal finish times go by source; an
empty table gives an empty mix; other columns are carried along by ``mixed`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.running import order_key, with_range_sum, with_running_sum
from terrace.llm.scratch import Scratch

# Fixed value: a word is a run of other characters than [\x20\x09-\x0D].
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Never null, in code-point order, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def plan_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, epochs: int, scratch: Scratch
) -> tuple[DataFrame, int]:
    """(per source its weight and target, the budget in words), of (``_source``, ``source_size``).

    Each round of sharing is an aggregate over the sources; a round in which no further source is
    above what it can send is the last.
    """
    ones = sizes.withColumn("one", F.lit(1).cast("long"))
    placed = with_range_sum(ones, [F.col("_source")], "one", "place", scratch)
    # The weights go round over the sources in code-point order.
    cyclic = F.array(*[F.lit(float(w)) for w in weights])
    rows = scratch.keep(
        placed.select(
            "_source", "source_size",
            F.get(cyclic, (F.col("place") % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(epochs))).alias("cap"),
        ),
        "sources",
    )
    end = F.col("cap") / F.col("weight")
    budget = float(rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * float(share)
    level, spent = 0.0, None
    while True:
        # The first round has no level yet: no source has sent all it can.
        done = end < F.lit(level) if spent is not None else F.lit(False)
        used, open_weight, n = rows.agg(
            F.coalesce(F.sum(F.when(done, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~done, F.col("weight"))), F.count_if(done)
        ).first()
        if spent == n or open_weight is None:
            break
        level, spent = (budget - used) / open_weight, n
    if open_weight is None:
        level = rows.agg(F.coalesce(F.max(end), F.lit(0.0))).first()[0]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return rows.select("_source", "source_size", "weight", target.alias("target")), int(budget)


def queue(
    df: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    uid: Column | None = None,
) -> DataFrame:
    """Per document and round: uid, doc_id, size, source_size, target, round, finish (the virtual
    finish time; null without words) and taken, the words of it that the mix sends."""
    text = df[text_col]
    rows = scratch.keep(
        df.select(
            (F.monotonically_increasing_id() if uid is None else uid).alias("uid"),
            df[id_col].cast("long").alias("doc_id"),
            _source_key(df[source_col]).alias("_source"),
            words(text).alias("size"),
            order_key(F.lit(seed), df[id_col], F.md5(F.coalesce(text, F.lit("")))).alias("_order"),
        ),
        "sizes",
    )
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets, budget = plan_targets(scratch.keep(sizes, "source-sizes"), weights, share, epochs, scratch)
    targets = scratch.keep(targets, "targets")
    started = with_running_sum(
        rows, "_source", "_order", ["doc_id", "size", "uid"], "size", "start", rows.count()
    )
    met = started.join(targets, "_source")
    rounds = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("round")
    copies = met.where("size > 0").select("*", rounds)
    sent = F.col("round") * F.col("source_size") + F.col("start") + F.col("size")
    finish = sent.cast("double") / F.col("weight")
    queued = copies.select("uid", "doc_id", "_source", "size", "source_size", "target", "round", finish.alias("finish"))
    # No two documents of a source finish at the same time.
    ordered = with_range_sum(queued, [F.col("finish"), F.col("_source")], "size", "before", scratch)
    room = F.lit(budget) - F.col("before")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), room))
    columns = ("uid", "doc_id", "size", "source_size", "target", "round", "finish")
    empty = met.where("size = 0").withColumns(
        {"round": F.lit(0), "finish": F.lit(None).cast("double"), "taken": F.lit(0).cast("long")}
    )
    return ordered.withColumn("taken", taken).select(*columns, "taken").unionByName(empty.select(*columns, "taken"))


def mix_table(df: DataFrame, **options) -> DataFrame:
    """Per input row: doc_id, size, source_size, target, taken."""
    with Scratch(df.sparkSession) as scratch:
        each = ["uid", "doc_id", "size", "source_size", "target"]
        summed = queue(df, scratch, **options).groupBy(*each).agg(F.sum("taken").alias("taken"))
        return scratch.result(summed.select("doc_id", "size", "source_size", "target", "taken"), "mix")


def mixed(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix: every row as often as it is sent, with all its columns, written in the order of the
    finish times. The copy on the budget's edge holds its first words, with single spaces between
    them."""
    columns = df.columns
    with Scratch(df.sparkSession) as scratch:
        row = F.struct("*").alias("row")
        numbered = scratch.keep(df.select(row, F.monotonically_increasing_id().alias("uid")), "numbered")
        id_col, source_col = options.pop("id_col", "doc_id"), options.pop("source_col", "source")
        # Names of the caller's columns stay inside the row.
        plain = numbered.select(
            F.col("uid"),
            F.col("row")[id_col].alias("doc_id"),
            F.col("row")[text_col].alias("text"),
            F.col("row")[source_col].alias("source"),
        )
        sent = queue(plain, scratch, uid=F.col("uid"), **options).where("taken > 0")
        met = numbered.join(sent.select("uid", "finish", "size", "taken"), "uid")
        text = F.col("row")[text_col]
        first = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("taken").cast("int"))
        whole = F.col("taken") == F.col("size")
        out = [
            F.when(whole, text).otherwise(F.array_join(first, " ")).alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in columns
        ]
        dealt = met.repartitionByRange("finish", "uid").sortWithinPartitions("finish", "uid")
        return scratch.result(dealt.select(*out), "mixed")
