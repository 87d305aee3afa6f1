"""Packing documents into windows with their lexical neighbours.

A document is its token ids and an end id. What fills whole windows by itself stays where it
is; the rest of each document, its tail, shares a window with the tails most like it. Tails
are dealt to shards of about ``shard_tokens`` ids by a lexical signature, the least hash of
their adjacent id pairs, and each shard builds a BM25 inverted index over its tails. Their
term statistics are those of all pieces of all documents. The next unused tail seeds a
window, the index returns its unused neighbours by descending score, and they fill the window
in that order. The one that overflows is cut, its rest opens the next window and becomes the
seed there. So windows are full but for the last one of a shard.

A signature with more tails than a shard holds, as that of a large group of copies, is spread
over several shards by a second hash. The signature table has at most 2**16 rows, and the
statistics at most one row per token id, which bounds both broadcasts.

Defined results: null text counts as empty and is the end id alone; null ids are kept as they
are; rows that repeat are packed each; a document of any length is cut at window borders;
tails without neighbours are followed by the next unused tail; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import encoders
from terrace.llm.scratch import Scratch

# Fixed value: the number of lexical signatures.
CELLS = 1 << 16
# Added to a piece's length when shards are sized, for what it costs besides its ids.
PIECE_COST = 64
# Whole windows are numbered from here, windows of shards below.
WHOLE_WINDOWS = 1 << 62
PIECES = "doc_id long, start long, doc_tokens long, cell int, ids binary, counts binary"
PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def signature(ids: np.ndarray) -> int:
    """The cell of a tail: texts with common passages tend to share it."""
    wide = ids.astype(np.uint64)
    pairs = (wide[:-1] << np.uint64(32)) | wide[1:] if len(wide) > 1 else wide
    least = _mix(pairs * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).min(keepdims=True)
    return int(_mix(least)[0]) % CELLS


def cut(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """PIECES of (doc_id, text): whole windows without a cell, tails with theirs, and a row per
    task with nothing but ``counts``, in how many of its pieces each token id occurs."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ["doc_id", "start", "doc_tokens", "cell", "ids", "counts"]

    def rows(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders.load(tokenizer)
        counts = np.zeros(end_id + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[list] = [[], [], [], [], []]
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, found in zip(part.column("doc_id").to_pylist(), encode(texts), strict=True):
                    ids = np.append(found, end_id).astype("<u4")
                    top = int(ids.max()) + 1
                    if top > len(counts):
                        counts = np.concatenate([counts, np.zeros(top - len(counts), np.int64)])
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        counts[np.unique(piece)] += 1
                        cell = signature(piece) if len(piece) < window else None
                        for column, value in zip(out, (doc_id, start, len(ids), cell, piece.tobytes()), strict=True):
                            column.append(value)
                yield rows(*out, [None] * len(out[0]))
        yield rows([None], [None], [None], [None], [None], [counts.tobytes()])

    return docs.mapInArrow(run, PIECES)


def term_counts(pieces: DataFrame) -> DataFrame:
    """(term, n): in how many pieces each token id occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("counts"):
                counts = np.frombuffer(data.as_py(), np.int64)
                terms = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(counts[terms])], names=["term", "n"])

    per_task = pieces.select("counts").where("counts IS NOT NULL").mapInArrow(run, "term long, n long")
    return per_task.groupBy("term").agg(F.sum("n").alias("n"))


def assign_shards(tails: DataFrame, shard_tokens: int) -> DataFrame:
    """Adds ``shard``: neighbouring cells together, large cells spread."""
    cost = F.octet_length("ids") / 4 + PIECE_COST
    cells = tails.groupBy("cell").agg(F.sum(cost).alias("cost"))
    # At most CELLS rows.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select(
        "cell",
        F.floor(F.coalesce(F.sum("cost").over(before), F.lit(0.0)) / shard_tokens).alias("base"),
        F.ceil(F.col("cost") / shard_tokens).alias("spread"),
    )
    spread = F.pmod(F.xxhash64("doc_id", "ids"), F.col("spread"))
    met = tails.join(F.broadcast(placed), "cell").withColumn("shard", F.col("base") + spread)
    return met.drop("base", "spread")


class Index:
    """A BM25 inverted index over the pieces of a shard."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float, k1: float, b: float):
        lengths = np.array([len(p) for p in pieces])
        owner = np.repeat(np.arange(len(pieces)), lengths)
        width = len(idf)
        found, tf = np.unique(owner * width + np.concatenate(pieces).astype(np.int64), return_counts=True)
        self.size = len(pieces)
        self.doc, self.term = found // width, found % width
        self.impact = idf[self.term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[self.doc] / mean))
        self.doc_start = np.searchsorted(self.doc, np.arange(self.size + 1))
        order = np.argsort(self.term, kind="stable")
        self.posted, self.weight = self.doc[order], self.impact[order]
        self.term_start = np.searchsorted(self.term[order], np.arange(width + 1))

    def neighbours(self, seed: int, free: np.ndarray, query_terms: int) -> np.ndarray:
        """The unused pieces that share one of the seed's strongest terms, best first."""
        own = slice(self.doc_start[seed], self.doc_start[seed + 1])
        terms, strength = self.term[own], self.impact[own]
        if len(terms) > query_terms:
            terms = terms[np.argpartition(-strength, query_terms)[:query_terms]]
        spans = [slice(self.term_start[t], self.term_start[t + 1]) for t in terms]
        posted = np.concatenate([self.posted[s] for s in spans])
        weight = np.concatenate([self.weight[s] for s in spans])
        scores = np.bincount(posted, weight, self.size) * free
        found = np.flatnonzero(scores)
        return found[np.lexsort((found, -scores[found]))]


def fill(index: Index, lengths: np.ndarray, window: int, query_terms: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, start, length, window number, offset) of all pieces, windows in a row."""
    out: list[tuple[int, int, int, int, int]] = []
    free = np.ones(len(lengths), bool)
    number = offset = 0

    def place(piece: int) -> bool:
        """Whether the piece, or its rest, stands in a new window."""
        nonlocal number, offset
        free[piece] = False
        start, opened = 0, offset == 0
        while start < lengths[piece]:
            length = min(int(lengths[piece]) - start, window - offset)
            out.append((piece, start, length, number, offset))
            start, offset = start + length, offset + length
            if offset == window:
                number, offset, opened = number + 1, 0, True
        return opened

    for first in range(len(lengths)):
        if not free[first]:
            continue
        seed: int | None = first
        place(first)
        while seed is not None and offset:
            queue, seed = index.neighbours(seed, free, query_terms), None
            for piece in queue:
                if place(int(piece)):
                    seed = int(piece)
                    break
    return out


def _pack_shard(idf: np.ndarray, mean: float, window: int, query_terms: int, k1: float, b: float):
    def run(table: pa.Table) -> pa.Table:
        # A fixed order, whatever order the shuffle brought: by cell, then id and content.
        table = table.sort_by([(n, "ascending") for n in ("cell", "doc_id", "start", "ids")])
        pieces = [np.frombuffer(x.as_py(), "<u4") for x in table.column("ids")]
        lengths = np.array([len(p) for p in pieces])
        index = Index(pieces, idf, mean, k1, b)
        rows = fill(index, lengths, window, query_terms)
        at = np.array([r[0] for r in rows])
        start, length, number, offset = (np.array([r[n] for r in rows], np.int64) for n in (1, 2, 3, 4))
        shard = table.column("shard")[0].as_py()
        took = table.select(["doc_id", "start", "doc_tokens"]).take(pa.array(at))
        ids = [pieces[p][s : s + n].tobytes() for p, s, n, *_ in rows]
        return pa.table(
            {
                "doc_id": took.column("doc_id"),
                "start": pa.array(took.column("start").to_numpy() + start),
                "length": pa.array(length),
                "ids": pa.array(ids, pa.binary()),
                "doc_tokens": took.column("doc_tokens"),
                "sequence_id": pa.array((shard << 32) + number),
                "offset": pa.array(offset),
            }
        )

    return run


def pack(
    df: DataFrame,
    tokenizer: str,
    scratch: Scratch,
    window: int = 2048,
    end_id: int = 1,
    shard_tokens: int = 2_000_000,
    query_terms: int = 64,
    k1: float = 1.2,
    b: float = 0.75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id,
    offset."""
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    pieces = scratch.keep(cut(docs, tokenizer, window, end_id), "pieces")
    # One row per token id.
    counts = term_counts(pieces).collect()
    total, mean = pieces.where("cell IS NOT NULL").agg(
        F.count(F.lit(1)), F.coalesce(F.avg(F.octet_length("ids") / 4), F.lit(1.0))
    ).first()
    seen = np.zeros(max((r.term for r in counts), default=0) + 1)
    seen[[r.term for r in counts]] = [r.n for r in counts]
    units = max(total, seen.max())
    idf = np.log1p((units - seen + 0.5) / (seen + 0.5))
    tails = assign_shards(pieces.where("cell IS NOT NULL"), shard_tokens)
    packed = tails.groupBy("shard").applyInArrow(_pack_shard(idf, mean, window, query_terms, k1, b), PACKED)
    whole = pieces.where("cell IS NULL AND ids IS NOT NULL").select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), "ids", "doc_tokens",
        (F.monotonically_increasing_id() + F.lit(WHOLE_WINDOWS)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole)


def piece_table(df: DataFrame, tokenizer: str, **options) -> DataFrame:
    """``pack`` with a checksum in place of the ids."""
    with Scratch(df.sparkSession) as scratch:
        packed = pack(df, tokenizer, scratch, **options)
        out = packed.select(
            "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
        )
        return scratch.result(out, "packed")
