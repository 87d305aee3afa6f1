"""Importance resampling towards a target distribution, with features counted once per line.

Texts are cut into lines at the separator, a newline, which no word holds. Equal lines are
gathered over the whole corpus; each distinct line's features, runs of one to ``ngrams``
words hashed into buckets, are counted once and multiplied by the line's occurrences. Runs
that reach over the end of a line belong to no line and are added by document. The gain of
a bucket is the logarithm of its smoothed share in the target over that in the corpus. A
line's weight, the sum of its gains, is computed once as well and joined back to the
documents that hold it. Documents are drawn without replacement by their greatest scores,
weight plus Gumbel noise from a digest of the id, by a global range sort.

Lines are grouped by their content, not by a digest; the join back to documents goes by a
128-bit digest. The features of a line are kept as bucket numbers. Only the gains, one
number per bucket, pass through the driver.

Defined results: null and empty texts have no words, no features and weight 0; very long texts
and lines are read whole; a null id has noise of its own and loses ties; repeated rows get equal
scores and following ranks; with an empty target all its shares are the smoothed zero; an empty
table gives an empty result; other columns are not looked at, ``resampled`` keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.running import with_range_sum
from terrace.llm.scratch import Scratch

# Texts are lower-cased in A-Z only; a word is a run of other characters than
# [\x00-\x2F\x3A-\x60\x7B-\x7F]; a feature's words are joined by one space.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The noise is drawn from 32 bits of a digest, in thousandths like the gains.
DIGEST_HEX, DIGEST_RANGE, SCALE = 8, 4294967296.0, 1000
# Bucket numbers of single words that a task remembers.
REMEMBERED = 500_000


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.explode(F.split(_lowered(text), "\n"))


class _Hashed(dict):
    """Bucket of a feature."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        bucket = crc32(feature.encode()) % self.buckets
        if len(self) < REMEMBERED:
            self[feature] = bucket
        return bucket


def line_features(words: list[str], ngrams: int, bucket_of: _Hashed) -> list[int]:
    """The bucket of every run of up to ``ngrams`` words."""
    out = list(map(bucket_of.__getitem__, words))
    for n in range(2, ngrams + 1):
        out += [bucket_of[" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
    return out


def crossing_features(lines: list[list[str]], ngrams: int, bucket_of: _Hashed) -> list[int]:
    """The bucket of every run that reaches over the end of a line."""
    words = [w for line in lines for w in line]
    line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    out = []
    for n in range(2, ngrams + 1):
        for i in np.flatnonzero(line_of[: max(0, len(words) - n + 1)] != line_of[n - 1 :]):
            out.append(bucket_of[" ".join(words[i : i + n])])
    return out


def _arrays(found: list[list[int]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    flat = np.fromiter((b for x in found for b in x), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def distinct_lines(texts: DataFrame, ngrams: int, buckets: int) -> DataFrame:
    """(digest, times, n_words, features) per distinct line with words, of (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _Hashed(buckets)
        for batch in batches:
            words = [WORD.findall(x) for x in batch.column("line").to_pylist()]
            features = _arrays([line_features(w, ngrams, bucket_of) for w in words])
            sizes = pa.array([len(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("times"), sizes, features],
                names=["digest", "times", "n_words", "features"],
            )

    lines = texts.select(_lines(F.col("text")).alias("line"))
    once = lines.where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    return once.select(_digest("line"), "line", "times").mapInArrow(
        run, "digest binary, times long, n_words long, features array<int>"
    )


def _digest(line: str) -> Column:
    return F.unhex(F.md5(line)).alias("digest")


def crossings(texts: DataFrame, ngrams: int, buckets: int) -> DataFrame:
    """(uid, times, n_words, features) per document, of (uid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _Hashed(buckets)
        for batch in batches:
            found = [
                crossing_features([WORD.findall(x) for x in text.split("\n")], ngrams, bucket_of)
                for text in batch.column("text").to_pylist()
            ]
            none, one = np.zeros(len(found), np.int64), np.ones(len(found), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(one), pa.array(none), _arrays(found)],
                names=["uid", "times", "n_words", "features"],
            )

    lowered = texts.select("uid", _lowered(F.col("text")).alias("text"))
    return lowered.mapInArrow(run, "uid long, times long, n_words long, features array<int>")


def bucket_counts(lines: DataFrame) -> DataFrame:
    """(bucket, n) over all occurrences."""
    each = lines.select("times", F.explode("features").alias("bucket"))
    return each.groupBy("bucket").agg(F.sum("times").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket, in thousandths: as many numbers as buckets."""
    grid = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = grid.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in both.na.fill(0).collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    up, down = (t + 1.0) * (s.sum() + float(buckets)), (s + 1.0) * (t.sum() + float(buckets))
    return np.floor(float(SCALE) * np.log(up / down)).astype(np.int64)


def weighed(lines: DataFrame, key: str, kind: str, gain: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight) of each line or document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column("features")
            ends = features.offsets.to_numpy()
            flat = features.values.to_numpy()
            sums = np.concatenate([[0], np.cumsum(gain[flat])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    batch.column("n_words"),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(sums[ends[1:]] - sums[ends[:-1]]),
                ],
                names=[key, "n_words", "n_features", "weight"],
            )

    return lines.select(key, "n_words", "features").mapInArrow(
        run, f"{key} {kind}, n_words long, n_features long, weight long"
    )


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("\\N")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, DIGEST_HEX), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((drawn + 0.5) / DIGEST_RANGE)))


def _scored(
    rows: DataFrame, target: DataFrame, scratch: Scratch, ngrams: int, buckets: int, seed: int
) -> DataFrame:
    """(uid, doc_id, n_words, n_features, weight, score) of (uid, doc_id, text)."""
    if ngrams > 1:
        # Read twice by their numbers, which must be the same both times.
        rows = scratch.keep(rows, "numbered")
    held = scratch.keep(
        rows.select("uid", "doc_id", _lines(F.col("text")).alias("line")).select("uid", "doc_id", _digest("line")),
        "lines",
    )
    lines = scratch.keep(distinct_lines(rows, ngrams, buckets), "distinct")
    counted, aimed = bucket_counts(lines), bucket_counts(distinct_lines(target, ngrams, buckets))
    over = None
    if ngrams > 1:
        over = scratch.keep(crossings(rows, ngrams, buckets), "crossings")
        others = crossings(target.withColumn("uid", F.lit(0).cast("long")), ngrams, buckets)
        counted = _added(counted, bucket_counts(over))
        aimed = _added(aimed, bucket_counts(others))
    gain = gains(counted, aimed, buckets)
    # Written, so that Spark can split the join where very many documents hold a line.
    weights = scratch.keep(weighed(lines, "digest", "binary", gain), "weights")
    parts = held.join(weights, "digest", "left").select("uid", "doc_id", "n_words", "n_features", "weight")
    if over is not None:
        own = weighed(over, "uid", "long", gain).withColumn("doc_id", F.lit(None).cast("long"))
        parts = parts.unionByName(own)
    summed = parts.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_features", "weight")],
    )
    return summed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _added(one: DataFrame, two: DataFrame) -> DataFrame:
    return one.unionByName(two).groupBy("bucket").agg(F.sum("n").alias("n"))


def _ranked(
    rows: DataFrame, target: DataFrame, scratch: Scratch, ngrams: int, buckets: int, percent: int,
    least_words: int, seed: int,
) -> DataFrame:
    scored = scratch.keep(_scored(rows, target, scratch, ngrams, buckets, seed), "scored")
    fit = F.col("n_words") >= least_words
    drawn = percent * scored.where(fit).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("uid")]
    ones = scored.where(fit).withColumn("one", F.lit(1).cast("long"))
    placed = with_range_sum(ones, order, "one", "place", scratch).drop("one")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    others = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("place").unionByName(others)


def resample_table(
    df: DataFrame,
    target: DataFrame,
    ngrams: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, and rank if it is drawn: the ``percent``
    greatest scores of the rows with ``least_words`` words or more. ``target`` has its texts
    in ``text_col`` too."""
    with Scratch(df.sparkSession) as scratch:
        rows = df.select(
            F.monotonically_increasing_id().alias("uid"),
            df[id_col].cast("long").alias("doc_id"),
            df[text_col].alias("text"),
        )
        aim = target.select(target[text_col].alias("text"))
        ranked = _ranked(rows, aim, scratch, ngrams, buckets, percent, least_words, seed)
        out = ranked.select("doc_id", "n_features", "weight", "score", "rank")
        return scratch.result(out, "importance")


def resampled(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    ngrams: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """The drawn rows, with all their columns."""
    with Scratch(df.sparkSession) as scratch:
        numbered = scratch.keep(
            df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")),
            "numbered",
        )
        rows = numbered.select(
            "uid", F.col("row")[id_col].cast("long").alias("doc_id"), F.col("row")[text_col].alias("text")
        )
        aim = target.select(target[text_col].alias("text"))
        ranked = _ranked(rows, aim, scratch, ngrams, buckets, percent, least_words, seed)
        drawn = numbered.join(ranked.where("rank is not null").select("uid"), "uid", "left_semi")
        return scratch.result(drawn.select("row.*"), "resampled")
