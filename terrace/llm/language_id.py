"""Language identification by compression.

A language's model is a raw-content zstandard dictionary of stretches of its labelled
documents. A text is lower-cased, its ASCII digits and punctuation become spaces, and it is
cut into blocks of ``block_bytes``; each block is compressed with every language's
dictionary, and the language of the smallest total wins. A narrow margin between the
smallest and the next total rejects the text.

Fitting takes a bounded sample: per language ``sample_docs`` documents, those with the
smallest hash of their id, and of each one stretch of ``stretch`` characters at a hashed
place. Predicting reads whole texts and nothing but texts.

Defined results: null text and text without letters is ``und`` with score 0 and rejected; so
is every text if there is nothing to learn from; null languages and null texts are not learned
from; nor are documents without id, which are never held out; equal totals go to the first
language in code-point order and are rejected; repeated rows get equal answers; an empty
table gives an empty result; other columns are not looked at, ``identified`` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.scratch import bound_batches

UNKNOWN = "und"
# ASCII letters and all bytes of other characters stay, the rest become spaces.
LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
# Before each block, so that zstandard also looks for matches in very short ones.
FILL = b" " * 64
LETTER = regex.compile(r"\p{L}")
PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean"


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, in code-point order, and how to use them."""

    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = 6
    block_bytes: int = 4096
    # Bytes of difference between two totals that make a factor e in the score.
    scale: float = 4.0
    # Least difference between the best totals, as a share of the best one.
    min_margin: float = 0.005


def held_out(doc_id: Column) -> Column:
    """Documents kept away from fitting: a quarter, by their id."""
    bucket = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4
    return F.coalesce(bucket == 2, F.lit(False))


def fit(
    df: DataFrame,
    sample_docs: int = 256,
    stretch: int = 400,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    **settings,
) -> Model:
    """Dictionaries from the labelled documents that are not held out. At most ``sample_docs``
    stretches a language come to the driver."""
    place = F.xxhash64(df[id_col].cast("string"), F.lit("sample"))
    usable = df[lang_col].isNotNull() & df[text_col].isNotNull() & df[id_col].isNotNull()
    training = df.where(usable & ~held_out(df[id_col])).select(
        df[lang_col].alias("lang"), df[text_col].alias("text"), place.alias("place"),
        F.xxhash64(df[id_col].cast("string"), F.lit("stretch")).alias("spot"),
    )
    # Of a language's documents about four times the sample pass by their hash alone, so the
    # ranking sees few rows, however many the language has.
    counts = training.groupBy("lang").count()
    share = F.col("place") / F.lit(2.0**64) + 0.5
    # One row per language, fewer than the model that comes to the driver.
    met = training.join(F.broadcast(counts), "lang")
    few = met.where(share * F.col("count") < 4 * sample_docs)
    room = F.greatest(F.char_length("text") - stretch, F.lit(0)) + 1
    start = (F.pmod("spot", room) + 1).cast("int")
    pieces_of = few.select("lang", "place", F.substring("text", start, F.lit(stretch)).alias("piece"))
    by_place = Window.partitionBy("lang").orderBy("place", "piece")
    ranked = pieces_of.withColumn("rank", F.row_number().over(by_place))
    rows = ranked.where(F.col("rank") <= sample_docs).select("lang", "rank", "piece").collect()
    pieces: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        pieces.setdefault(row.lang, []).append((row.rank, row.piece))
    joined = {lang: "\n".join(p for _, p in sorted(found)) for lang, found in pieces.items()}
    content = {lang: normalised(text) for lang, text in joined.items()}
    # zstandard takes content of 8 bytes and more.
    return Model(tuple(sorted((k, v) for k, v in content.items() if len(v) >= 8)), **settings)


def normalised(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().translate(LETTERS_ONLY).split()) + b" "


@lru_cache(maxsize=2)
def _compressors(model: Model) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model.dictionaries:
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=model.level)
        compressor = zstandard.ZstdCompressor(
            level=model.level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        out.append((lang, compressor))
    return out


def identify(model: Model, text: str | None) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of one text."""
    if text is None or not model.dictionaries or not LETTER.search(text):
        return UNKNOWN, 0.0, 0.0, True
    data, size = normalised(text), model.block_bytes
    blocks = [FILL + data[at : at + size] for at in range(0, len(data), size)]
    totals = [
        (sum(len(c.compress(block)) for block in blocks), lang) for lang, c in _compressors(model)
    ]
    best, lang = min(totals)
    others = [size - best for size, other in totals if other != lang]
    score = 1.0 / (1.0 + sum(math.exp(-gap / model.scale) for gap in others))
    margin = min(others) / best if others else 1.0
    return lang, score, margin, margin < model.min_margin


def _answers(model: Model, texts: Sequence[str | None]) -> list[tuple[str, float, float, bool]]:
    return [identify(model, text) for text in texts]


def predict(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, margin, rejected."""
    bound_batches(df.sparkSession)
    rows = df.select(
        df[id_col].cast("long").alias("doc_id"),
        held_out(df[id_col]).alias("held_out"),
        df[text_col].alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _answers(model, batch.column("text").to_pylist())
            columns = [list(c) for c in zip(*found, strict=True)] or [[], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out")]
                + [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"],
            )

    return rows.mapInArrow(run, PREDICTION)


def identified(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    bound_batches(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = [a[3] for a in _answers(model, batch.column(at).to_pylist())]
            yield batch.filter(pc.invert(pa.array(rejected, pa.bool_())))

    return df.mapInArrow(run, df.schema)
