"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's shingles are its runs of ``WIDTH`` words, lower-cased in A-Z, of ASCII letters and digits
and all other characters beyond ASCII; a text with fewer words is one shingle, and a text without
words is one shingle as it stands. A shingle's hash is the first 40 bits of its MD5 digest: two
sketches of fifty hashes share one by chance in one of fifty million comparisons.
The sketch retains every hash below a fixed fraction of the range, so its size follows the text's,
the sketch of a union is the union of the sketches, and the share of one sketch found in
another estimates containment without bias however unequal the texts are. A text with no hash
below the threshold keeps its least one, and so does a merged sketch, which thus stays
the sketch of the merged shingles.

``neighbours`` compares each document with its edited text and with the next document. The
table is dealt and sorted by ranges of the id, so that almost every next document lies in the
same task; tasks hand out the texts at their ends, of which there are two per partition, and
these are paired in a second, small step. Every shingle of a document is hashed once for both
texts as far as they agree.

Defined results: null text counts as empty; an empty text has an empty fingerprint, like only
another empty one; texts of any length are read whole; null ids come last and rows of equal ids
are ordered by a hash of their text, so repeated rows are neighbours; a single row is its own
next; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.scratch import Scratch, bound_batches

# Words of a shingle.
WIDTH = 5
# One in so many hashes is retained.
ONE_IN = 8
HASH_BYTES = 5

# ASCII letters and digits, lower-cased, and all bytes of other characters stay, the rest are spaces.
_WORD_BYTES = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)
# Rows that a task gives out at a time.
_OUT_ROWS = 1000

_ROW = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)
# Besides: the partition, and the text of a partition's first and last document.
_EDGES = T.StructType(
    [*_ROW.fields, *[T.StructField(c, T.StringType()) for c in ("edge", "text")], T.StructField("block", T.IntegerType())]
)


def _words(text: str) -> list[bytes]:
    data = text.encode()
    return data.translate(_WORD_BYTES).split() or ([data] if data else [])


def _hashes(words: list[bytes], first: int = 0) -> list[bytes]:
    """The hash of each shingle from the ``first`` on."""
    if len(words) < WIDTH:
        return [hashlib.md5(b" ".join(words)).digest()[:HASH_BYTES]] if words else []
    part = words[first:]
    data, md5 = b" ".join(part), hashlib.md5
    starts, at = [], 0
    for word in part:
        starts.append(at)
        at += len(word) + 1
    # A shingle ends one space before the start of the word behind it.
    ends = [s - 1 for s in starts[WIDTH:]] + [len(data)]
    return [md5(data[a:b]).digest()[:HASH_BYTES] for a, b in zip(starts, ends)]


def _below(threshold: int) -> bytes:
    return threshold.to_bytes(HASH_BYTES, "big")


def sketch_of(hashes: list[bytes] | set[bytes], one_in: int = ONE_IN) -> frozenset[bytes]:
    """The hashes below the threshold, or the least where there are none."""
    limit = _below(-(-(1 << 8 * HASH_BYTES) // one_in) if one_in > 1 else (1 << 8 * HASH_BYTES) - 1)
    kept = frozenset(h for h in hashes if h < limit)
    return kept or frozenset([min(hashes)] if hashes else [])


def sketch(text: str | None, one_in: int = ONE_IN) -> frozenset[bytes]:
    return sketch_of(_hashes(_words(text or "")), one_in)


def merge(one: frozenset[bytes], two: frozenset[bytes], one_in: int = ONE_IN) -> frozenset[bytes]:
    """The sketch of both texts' shingles together."""
    return sketch_of(one | two, one_in)


def containment(part: frozenset[bytes], whole: frozenset[bytes]) -> float:
    """Estimates the share of one text's shingles that the other one has."""
    return len(part & whole) / len(part) if part else float(not whole)


def likeness(one: frozenset[bytes], two: frozenset[bytes]) -> float:
    """Containment of the smaller sketch in the larger one."""
    return containment(*sorted((one, two), key=len))


def written(kept: frozenset[bytes]) -> str:
    """The fingerprint: the hashes in order, each as 10 hexadecimal digits."""
    return b"".join(sorted(kept)).hex()


def read(fingerprint: str) -> frozenset[bytes]:
    data = bytes.fromhex(fingerprint)
    return frozenset(data[i : i + HASH_BYTES] for i in range(0, len(data), HASH_BYTES))


def edited(text: str, following: str) -> str:
    """The text, its last quarter replaced by as many characters of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


class _Document:
    def __init__(self, doc_id: int | None, text: str, one_in: int):
        self.doc_id, self.text, self.one_in = doc_id, text, one_in
        self.words = _words(text)
        self.hashes = _hashes(self.words)
        self.kept = sketch_of(self.hashes, one_in)

    def row(self, following: _Document) -> tuple:
        other = edited(self.text, following.text)
        kept = self.kept if other == self.text else sketch_of(self._hashes_of(other), self.one_in)
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(other.encode()).hexdigest(),
            written(self.kept),
            written(kept),
            likeness(self.kept, kept),
            likeness(self.kept, following.kept),
        )

    def _hashes_of(self, other: str) -> list[bytes]:
        """Hashes of the edited text: where its words begin like this text's they are known."""
        words = _words(other)
        if min(len(words), len(self.words)) < WIDTH:
            return _hashes(words)
        pairs = enumerate(zip(words, self.words))
        same = next((i for i, (a, b) in pairs if a != b), min(len(words), len(self.words)))
        known = max(0, same - WIDTH + 1)
        return self.hashes[:known] + (_hashes(words, known) if len(words) - known >= WIDTH else [])


def _batches(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "integer": pa.int32()}
    arrow = pa.schema([(f.name, kinds[f.dataType.typeName()]) for f in schema.fields])
    held: list[tuple] = []

    def leave() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*held), arrow.types)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield leave()
    if held:
        yield leave()


def _documents(batches: Iterator[pa.RecordBatch], one_in: int) -> Iterator[tuple[int, _Document]]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "doc_id", "text"))
        for block, doc_id, text in zip(*columns):
            yield block, _Document(doc_id, text, one_in)


def _within(rows: DataFrame, one_in: int) -> DataFrame:
    """Every document followed by another one of its partition, and the texts at the ends."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        none = (None,) * (len(_ROW.fields) - 1)
        last = None
        for block, document in _documents(batches, one_in):
            if last is None:
                yield (document.doc_id, *none, "first", document.text, block)
            else:
                yield (*last.row(document), None, None, None)
            last = document
        if last is not None:
            yield (last.doc_id, *none, "last", last.text, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), _EDGES)

    return rows.mapInArrow(run, _EDGES)


def _across(edges: DataFrame, one_in: int) -> DataFrame:
    """The last document of each partition followed by the first of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    own = _Document(row["doc_id"], row["text"], one_in)
                    yield own.row(_Document(None, row["following"], one_in))

        return _batches(found(), _ROW)

    firsts, lasts = edges.where("edge = 'first'"), edges.where("edge = 'last'")
    # One narrow row per partition.
    after = firsts.select(
        "block",
        F.coalesce(
            F.lead("block").over(Window.orderBy("block")), F.min("block").over(Window.partitionBy())
        ).alias("next"),
    )
    following = firsts.select(F.col("block").alias("next"), F.col("text").alias("following"))
    met = lasts.join(after, "block").join(following, "next").select("doc_id", "text", "following")
    return met.mapInArrow(run, _ROW)


def neighbours(
    df: DataFrame, one_in: int = ONE_IN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next."""
    text = F.coalesce(df[text_col], F.lit(""))
    order = [F.asc_nulls_last("doc_id"), "tie", "uid"]
    rows = df.select(
        df[id_col].cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("uid"),
    )
    with Scratch(df.sparkSession) as scratch:
        dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        numbered = dealt.select(F.spark_partition_id().alias("block"), "doc_id", "text")
        # The result is what the tasks wrote, beside the few rows of their ends: not copied together.
        done = scratch.result(_within(numbered, one_in), "neighbours")
        ends = scratch.result(_across(done, one_in), "neighbours-across")
        return done.where("edge is null").select(*_ROW.names).unionByName(ends)


def fingerprints(
    df: DataFrame, one_in: int = ONE_IN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id and the fingerprint of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [written(sketch(text, one_in)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], names=["id", "fingerprint"])

    bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)
