"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every position of a piece of text points at the suffix that starts there, cut after
``longest`` words. The suffixes are routed by their leading words, so that all suffixes which
share them meet in one task, and there sorted word by word: a segment is parted at a pivot
into smaller, equal and greater ones; the size of an equal part is the count of the phrase
read so far, and only that part is sorted on by its next word. A part of fewer than
``least`` suffixes holds no frequent phrase and is abandoned unsorted.

What keeps the work even and the shuffle small:

- A phrase with a rare word is rare, so suffixes end before rare words. Which words are
  frequent is counted over all texts first; tasks know them by a bit table of fixed size
  (``FILTER_BITS``), whose false positives cost some rows and no result.
- A task merges equal suffixes before they are routed; pointers carry how many they stand for.
- Suffixes are routed by their first word; where that, or what follows it, leads more than one
  in ``routes`` of all words, by one word more, up to ``longest``. Such leading words are few,
  since each level of them adds up to no more than all words. They are found in the first pass:
  a part of the texts tells every phrase that holds a share eight times smaller of it, so what
  goes untold cannot add up to more than an eighth of the limit. Counts of leading words whose
  suffixes lie in several tasks are added up from the tasks that merged them.

Defined results: null and empty texts have no words; a null lang is ``und``, and meets a
lang of that name; texts of any length are read whole; repeated rows count again; ties
end in the phrase itself, by the bytes of its UTF-8 form; an empty table gives an empty
result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.scratch import Scratch

# Texts are lower-cased in A-Z only, cut into pieces at [.,;:!?\x0A-\x0D], and
# pieces into words [^\x20\x09]+.
CUTS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"
# Fixed value: the scale of a score.
SCORE_SCALE = 2_000_000

# Stands between pieces: lower-cased text holds no such letter.
_CUT = "X"
_LETTERS = bytes(
    10 if b in CUTS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
# Bytes of text that a task splits into words, and whose suffixes it merges, at a time.
HELD_BYTES = 32 << 20
# Bits of the table of frequent words: 8 MB.
FILTER_BITS = 1 << 26
# Bits of one of Spark's bitmaps.
_BITMAP = 32_768
# Suffixes sorted by a task, and rows that a task gives out at a time.
ROUTE_ROWS, OUT_ROWS = 2_000_000, 200_000
# Pointers of a segment that is sorted at once.
SMALL = 2048
# A part tells phrases of a share so many times smaller than the limit.
_TOLD = 8


class Part:
    """Words of several texts in a row: ids into ``words``, -1 between pieces."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts).translate(_LETTERS).replace(b"\n ", b"\n")
        data = data.replace(b"\n", f" {_CUT} ".encode())
        # Without white space but the blanks put there, by which words are split.
        split = pc.split_pattern(pa.array([data.decode()], pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        self.words = coded.dictionary.cast(pa.string())
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        empty = pc.index(self.words, "").as_py()
        if empty >= 0:
            self.ids = self.ids[self.ids != empty]
        self.drop([_CUT])
        self.listed = self.words.to_pylist()

    def drop(self, words: list[str]) -> None:
        for word in words:
            at = pc.index(self.words, word).as_py()
            if at >= 0:
                self.ids[self.ids == at] = -1

    def phrases(self, rows: np.ndarray) -> pa.Array:
        """Rows of ids as text; an id below 0 is no word."""
        columns = [
            self.words.take(pa.array(rows[:, j], pa.int32(), mask=rows[:, j] < 0))
            for j in range(rows.shape[1])
        ]
        return pc.binary_join_element_wise(*columns, " ", null_handling="skip")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Part]]:
    """Texts by language, in parts of bounded size but for a single text beyond it."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text.encode())
            size += len(held[lang][-1])
            if size > HELD_BYTES:
                while held:
                    name, texts = held.popitem()
                    yield name, Part(texts)
                size = 0
    while held:
        name, texts = held.popitem()
        yield name, Part(texts)


def _suffixes(ids: np.ndarray, longest: int) -> np.ndarray:
    """Rows of ``longest`` ids: the words from each position to the next cut (an id below 0)."""
    padded = np.concatenate([ids, np.full(longest - 1, -1, np.int32)])
    out = np.stack([padded[j : j + len(ids)] for j in range(longest)], axis=1)
    for j in range(1, longest):
        out[out[:, j - 1] < 0, j] = -1
    return out


def _merged(rows: np.ndarray, values: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs; ids are below ``values``."""
    width = rows.shape[1]
    bits = int(values).bit_length()
    if bits * width <= 64:
        # All ids of a row in one number: ids from 0 on, 0 for none.
        packed = np.zeros(len(rows), np.uint64)
        for j in range(width):
            packed = (packed << np.uint64(bits)) | (rows[:, j] + 1).astype(np.uint64)
        packed, n = np.unique(packed, return_counts=True)
        out = np.empty((len(packed), width), np.int32)
        for j in reversed(range(width)):
            out[:, j] = (packed & np.uint64((1 << bits) - 1)).astype(np.int32) - 1
            packed = packed >> np.uint64(bits)
        return out, n
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    at = np.flatnonzero(new)
    return rows[at], np.diff(np.append(at, len(rows)))


def _of_lang(lang: str, phrases: pa.Array, *numbers: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(phrases), OUT_ROWS):
        part = phrases.slice(at, OUT_ROWS)
        langs = pa.repeat(pa.scalar(lang, pa.string()), len(part))
        columns = [pa.array(n[at : at + OUT_ROWS].astype(np.int64)) for n in numbers]
        yield pa.RecordBatch.from_arrays([langs, part.cast(pa.string()), *columns], names=names)


def word_counts(texts: DataFrame, longest: int, routes: int) -> DataFrame:
    """(lang, words, n) of (lang, text): exact for single words; phrases of two words and more,
    below ``longest``, only where a part tells them, as possible leading words of many suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in _parts(batches):
            counts = np.bincount(part.ids[part.ids >= 0], minlength=len(part.words))
            at = np.flatnonzero(counts)
            names = ["lang", "words", "n"]
            yield from _of_lang(lang, part.words.take(pa.array(at)), counts[at], names=names)
            # Only phrases of frequent words can be frequent.
            limit = counts.sum() / (routes * _TOLD)
            known = np.where(counts >= limit, np.arange(len(counts)), -1).astype(np.int32)
            for words in range(2, longest):
                rows = _suffixes(np.where(part.ids >= 0, known[part.ids], -1), words)
                rows, n = _merged(rows[rows[:, -1] >= 0], len(counts))
                told = n >= limit
                if not told.any():
                    break
                yield from _of_lang(lang, part.phrases(rows[told]), n[told], names=names)

    counted = texts.mapInArrow(run, "lang string, words string, n long")
    return counted.groupBy("lang", "words").agg(F.sum("n").alias("n"))


def _cell(lang: bytes, word: bytes) -> int:
    return crc32(lang + b" " + word) % FILTER_BITS


def frequent_filter(words: DataFrame) -> bytes:
    """A bit per cell that a (lang, words) falls in; of fixed size, whatever the table's."""
    cell = F.crc32(F.encode(F.concat("lang", F.lit(" "), "words"), "UTF-8")) % FILTER_BITS + 1
    maps = (
        words.select(cell.alias("cell"))
        .groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    )
    table = bytearray(FILTER_BITS // 8)
    size = _BITMAP // 8
    for row in maps.toLocalIterator():
        at = (row["bucket"] - 1) * size
        table[at : at + size] = row["bits"]
    return bytes(table)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Leads:
    """The leading words of a part that are too many for one route, by their number."""

    def __init__(self, hot: set[str], part: Part, longest: int):
        place = {w: i for i, w in enumerate(part.listed)} if hot else {}
        known: dict[int, list[list[int]]] = {k: [] for k in range(1, longest)}
        for phrase in hot:
            ids = [place.get(w, -1) for w in phrase.split(" ")]
            if min(ids) >= 0:
                known[len(ids)].append(ids)
        self.values = max(1, len(part.listed))
        self.keys = {k: np.array([self._key(np.array([i]))[0] for i in rows], np.int64) for k, rows in known.items()}

    def _key(self, rows: np.ndarray) -> np.ndarray:
        key = np.zeros(len(rows), np.int64)
        for j in range(rows.shape[1]):
            key = key * self.values + rows[:, j]
        return key

    def depth(self, rows: np.ndarray) -> np.ndarray:
        """By how many words each row is routed."""
        out = np.ones(len(rows), np.int64)
        for k in self.keys:
            at = np.flatnonzero((out == k) & (rows[:, k - 1] >= 0))
            if len(at) and len(self.keys[k]):
                out[at[np.isin(self._key(rows[at, :k]), self.keys[k])]] = k + 1
        return out


def _by_task(
    lang: str, task: np.ndarray, words: pa.Array, n: np.ndarray, first: np.ndarray
) -> pa.RecordBatch:
    """One row per task, with all that goes there in arrays: cheaper to shuffle than rows."""
    order = np.argsort(task, kind="stable")
    task = task[order]
    starts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
    ends = pa.array(np.append(starts, len(task)).astype(np.int32))
    columns = [words.cast(pa.string()).take(pa.array(order)), pa.array(n[order].astype(np.int64)), pa.array(first[order].astype(np.int32))]
    langs = pa.repeat(pa.scalar(lang, pa.string()), len(starts))
    held = [pa.ListArray.from_arrays(ends, c) for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(task[starts].astype(np.int32)), langs, *held], names=["task", "lang", "words", "n", "first"]
    )


def suffixes(
    texts: DataFrame, frequent: bytes, hot: dict[str, set[str]], longest: int, tasks: int
) -> DataFrame:
    """(task, lang, words, n, first), arrays of suffixes of two to ``longest`` frequent words,
    merged within a part. Of a suffix its phrases of ``first`` words and more are counted in the
    task that it is routed to; where ``first`` is 0, ``n`` counts a shorter phrase."""
    shared = texts.sparkSession.sparkContext.broadcast((frequent, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot_of = shared.value
        for lang, part in _parts(batches):
            name = lang.encode()
            cells = np.array([_cell(name, w.encode()) for w in part.listed] or [0], np.int64)
            table = np.frombuffer(bits, np.uint8)
            is_frequent = (table[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
            # Numbered anew: fewer ids make shorter keys to sort.
            number = np.cumsum(is_frequent) - 1
            ids = np.where((part.ids >= 0) & is_frequent[part.ids], number[part.ids], -1).astype(np.int32)
            back = np.append(np.flatnonzero(is_frequent), -1).astype(np.int32)
            rows = _suffixes(ids, longest)
            rows, n = _merged(rows[rows[:, 1] >= 0], len(back))
            if not len(rows):
                continue
            rows = back[rows]
            depth = _Leads(hot_of.get(lang, set()), part, longest).depth(rows)
            route = np.full(len(rows), crc32(name), np.uint64)
            hashes = _mix(cells.astype(np.uint64) + np.uint64(1))
            for k in range(longest):
                used = k < depth
                route[used] = _mix(route[used] * np.uint64(3) + hashes[rows[used, k]])
            task = (route % np.uint64(tasks)).astype(np.int32)
            first = np.maximum(depth, 2)
            at = np.flatnonzero(rows[np.arange(len(rows)), first - 1] >= 0)
            if len(at):
                yield _by_task(lang, task[at], part.phrases(rows[at]), n[at], first[at])
            for k in range(2, longest):
                led = np.flatnonzero(depth > k)
                if not len(led):
                    break
                told, place = np.unique(rows[led, :k], axis=0, return_inverse=True)
                sums = np.bincount(place.ravel(), n[led])
                none = np.zeros(len(told), np.int32)
                yield _by_task(lang, task[led[: len(told)]], part.phrases(told), sums, none)

    kinds = "task int, lang string, words array<string>, n array<long>, first array<int>"
    return texts.mapInArrow(run, kinds)


def quicksort_counts(
    columns: list[np.ndarray], weights: np.ndarray, first: np.ndarray, least: int
) -> Iterator[tuple[int, int, int]]:
    """(pointer, words, count) of every phrase with ``least`` occurrences: ``words`` leading
    words of the suffix that the pointer names. A column holds the ids of the suffixes' words
    at one place, -1 behind their end. Of a pointer's phrases those of fewer than ``first``
    words are sorted on but not told."""
    longest = len(columns)
    everything = np.arange(len(weights), dtype=np.int32)
    stack = [(everything, columns[0], 0)]
    while stack:
        pointers, keys, depth = stack.pop()
        if len(keys) <= SMALL:
            equals = _runs(pointers, keys, weights, least)
        else:
            pivot = keys[len(keys) // 2]
            for side in (keys < pivot, keys > pivot):
                part = pointers[side]
                if len(part) and (len(part) >= least or weights[part].sum() >= least):
                    stack.append((part, keys[side], depth))
            equal = pointers[keys == pivot]
            count = int(weights[equal].sum())
            equals = [(equal, count)] if pivot >= 0 and count >= least else []
        for equal, count in equals:
            if first[equal[0]] <= depth + 1:
                yield int(equal[0]), depth + 1, count
            if depth + 1 < longest:
                stack.append((equal, columns[depth + 1][equal], depth + 1))


def _runs(
    pointers: np.ndarray, keys: np.ndarray, weights: np.ndarray, least: int
) -> list[tuple[np.ndarray, int]]:
    """Small segments are not parted further but sorted at once: their frequent equal parts."""
    order = np.argsort(keys, kind="stable")
    order = order[np.searchsorted(keys[order], 0) :]
    if not len(order):
        return []
    keys, pointers = keys[order], pointers[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums = np.add.reduceat(weights[pointers], starts)
    ends = np.append(starts[1:], len(keys))
    return [(pointers[starts[i] : ends[i]], int(sums[i])) for i in np.flatnonzero(sums >= least)]


def sorted_counts(routed: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, f) of ``suffixes``, one route within one partition; counts of shorter
    phrases pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[pa.Array, ...]]] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            columns = [batch.column(c) for c in ("words", "n", "first")]
            for i, lang in enumerate(langs):
                held.setdefault(lang, []).append(tuple(c[i].values for c in columns))
        while held:
            lang, rows = held.popitem()
            words, n, first = (pa.concat_arrays(c) for c in zip(*rows, strict=True))
            yield from _counts_of(lang, words, n.to_numpy(), first.to_numpy(), longest, least)

    return routed.mapInArrow(run, "lang string, phrase string, f long")


def _counts_of(
    lang: str, words: pa.Array, n: np.ndarray, first: np.ndarray, longest: int, least: int
) -> Iterator[pa.RecordBatch]:
    names = ["lang", "phrase", "f"]
    told = np.flatnonzero(first == 0)
    yield from _of_lang(lang, words.take(pa.array(told)), n[told], names=names)
    at = np.flatnonzero(first)
    if not len(at):
        return
    words, n, first = words.take(pa.array(at)), n[at], first[at]
    split = pc.split_pattern(words, " ")
    coded = split.values.dictionary_encode()
    place, offsets = coded.indices.to_numpy(zero_copy_only=False), split.offsets.to_numpy()
    keys = []
    for j in range(longest):
        where = offsets[:-1] + j
        held = where < offsets[1:]
        keys.append(np.where(held, place[np.where(held, where, 0)], -1).astype(np.int32))
    found = list(quicksort_counts(keys, n, first, least))
    if found:
        pointer, size, count = (np.array(c) for c in zip(*found, strict=True))
        phrases = [
            coded.dictionary.take(pa.array(keys[j][pointer], pa.int32(), mask=size <= j))
            for j in range(longest)
        ]
        joined = pc.binary_join_element_wise(*phrases, " ", null_handling="skip")
        yield from _of_lang(lang, joined, count, names=names)


def phrase_counts(
    texts: DataFrame, scratch: Scratch, longest: int = 4, least: int = 30, routes: int = 4096
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of all phrases of up to ``longest`` words and ``least``
    occurrences, (lang, n) with all words of each language), of (lang, text)."""
    told = scratch.keep(word_counts(texts, longest, routes), "words")
    words = told.where(F.instr("words", " ") == 0)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    occurrences = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # A level's leading words add up to all words, so a level has at most ``routes`` and a seventh.
    limit = max(1, occurrences / routes * (_TOLD - 1) / _TOLD)
    hot: dict[str, set[str]] = {}
    for row in told.where(F.col("n") > limit).toLocalIterator():
        hot.setdefault(row["lang"], set()).add(row["words"])
    tasks = int(max(texts.sparkSession.sparkContext.defaultParallelism, -(-occurrences // ROUTE_ROWS)))
    routed = suffixes(texts, frequent_filter(frequent), hot, longest, tasks)
    counts = sorted_counts(routed.repartitionById(tasks, "task"), longest, least)
    summed = counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    singles = frequent.select("lang", F.col("words").alias("phrase"), F.col("n").alias("f"))
    return scratch.keep(summed.unionByName(singles), "counts"), totals


def score_cuts(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every phrase of two words and more, by its lowest cut."""
    size = F.size(F.split("phrase", " "))
    candidates = counts.where(F.instr("phrase", " ") > 0)
    ways = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), ways).withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - size(split(phrase, ' ')))"),
        }
    )
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Whole numbers of up to 38 digits: exact beyond 64 bits.
    exact = F.expr(f"({SCORE_SCALE}BD * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0))")
    cut = F.struct(exact.alias("score"), "k", "l", "r")
    best = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).groupBy("lang", "phrase", "a")
    return best.agg(F.min(cut).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def held_by_longer(counts: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, longer): the most frequent longer phrase's count, of phrases inside one."""
    # (words of the part, words before it, words of the longer phrase)
    parts = [
        (m, at, n) for n in range(3, longest + 1) for m in range(2, n) for at in range(n - m + 1)
    ]
    words = F.split("phrase", " ")
    inside = [
        F.when(F.size("words") == n, F.array_join(F.slice("words", at + 1, m), " "))
        for m, at, n in parts
    ]
    if not inside:
        return counts.select("lang", "phrase", F.col("f").alias("longer")).limit(0)
    held = counts.withColumn("words", words).select(
        "lang", F.col("f"), F.explode(F.array_compact(F.array(*inside))).alias("phrase")
    )
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    df: DataFrame,
    longest: int = 4,
    least: int = 30,
    covered_percent: int = 80,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
    routes: int = 4096,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    with Scratch(df.sparkSession) as scratch:
        texts = df.select(
            F.coalesce(df[lang_col].cast("string"), F.lit(NO_LANG)).alias("lang"),
            F.coalesce(df[text_col], F.lit("")).alias("text"),
        )
        counts, totals = phrase_counts(texts, scratch, longest, least, routes)
        covered = F.lit(100).cast("decimal(20,0)") * F.col("longer") >= F.lit(covered_percent).cast("decimal(20,0)") * F.col("a")
        scored = score_cuts(counts).join(
            held_by_longer(counts, longest), ["lang", "phrase"], "left"
        )
        kept = scored.where(~F.coalesce(covered, F.lit(False)))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        out = ranked.join(totals, "lang").select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
        )
        return scratch.result(out, "collocations")
