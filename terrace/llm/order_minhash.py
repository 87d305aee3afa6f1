"""Near-duplicate texts by Order MinHash and banded alignment.

A text is its lower-cased words without ASCII punctuation. Its k-mers, runs of ``k`` words,
are labelled with their occurrence, so that repeats count. Each of ``sketches`` hash
functions samples the ``2`` least labelled k-mers and keeps them in text order: two texts
get the same sketch with a probability that falls with their edit distance, also where the
same words stand in another order. Texts that share a sketch are candidates.

A group of candidates is first compared with its least member, which settles large groups of
copies in one pass. Of the other members, all pairs that are not in one component by then are
compared: in small groups as rows of pairs, in larger ones block against block. A pair whose
words alone differ too much needs no alignment; that is told by the texts' bags, counts of words
by hash that are much smaller than the words, and only texts that then still have a partner send
their words. Candidates are verified by a banded alignment of their whole word sequences:
similarity is one minus the edit distance, in words, over the longer length. Classes are the
components of verified pairs. Texts with equal words are one class from the start and are sketched
into groups once.

Pairs of which one text has fewer than 60 words are candidates for certain: they share one of
their rarest words, by a fixed order of words, among as many as may be edited and one more.
From 60 words on recall is that of the sketches. With words exchanged at random places and 64
sketches, of 200 pairs each, it was by words and similarity, before other members of a class help:

    words   0.8    0.85   0.9
    60      0.90   0.985  1
    80      0.89   0.99   1
    120     0.85   1      1
    200     0.86   0.98   1
    400     0.915  1      1

Defined results: null text, and text without words, is a class of its own row; text of other
characters than words, as "!!!", counts its white-space separated parts as words; texts of
fewer than ``k`` words have one k-mer; a null id loses every tie and a class of null ids only
has a null class id; of rows that repeat id and text one is kept; an empty table gives an
empty result; other columns are not looked at, ``survivors`` keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.components import components
from terrace.llm.scratch import Scratch

# ASCII letters, digits and all bytes of other characters stay, the rest become spaces.
WORDS_ONLY = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Bytes of text whose words are hashed, and sketched, at a time.
CHUNK_BYTES = 1 << 20
# Groups of more members are compared in blocks of about so many members and bytes of words.
SMALL, BLOCK, BLOCK_BYTES = 16, 1024, 4 << 20
# Similar texts of which one has fewer words meet for certain, by rare words.
SHORT = 60
# About so many texts are looked at to tell common words.
SAMPLE_TEXTS = 10_000
# Numbers that stand for a text's words when pairs of a block are sifted.
BUCKETS = 256
# Numbers of a text's bag, of four bits each, by which pairs are sifted before words move.
BAG = 128

_RANDOM = np.random.default_rng(20240131)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[32] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MAX = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normalised(text: str | None) -> bytes:
    """The words, each followed by one space."""
    lower = (text or "").lower()
    words = lower.encode().translate(WORDS_ONLY).split() or [w.encode() for w in lower.split()]
    return b"".join(w + b" " for w in words)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of normalised text."""
    out, at = [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= CHUNK_BYTES else data.find(b" ", at + CHUNK_BYTES) + 1
        out.append(_hash_words(np.frombuffer(data[at : end or len(data)], np.uint8)))
        at = end or len(data)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _hash_words(letters: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(letters == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts + 1
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _STEP)
    powers[0] = 1
    values = _BYTE[letters] * np.cumprod(powers)[place]
    return _mix(np.add.reduceat(values, starts))


def _kmers(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers of texts in a row, and how many each text has."""
    ends = np.cumsum(counts)
    starts = ends - counts
    # As many words as stand behind; beyond a text's end a k-mer takes zeros.
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.repeat(starts, n) + _places(n)
    limit = np.repeat(ends, n)
    hashed = np.zeros(len(first), np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j in range(k):
        word = np.where(first + j < limit, padded[first + j], np.uint64(0))
        hashed = (hashed + word) * _STEP
    hashed = _mix(hashed)
    # Repeats within a text are rare: look for them by a sort of values alone.
    text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    own = _mix(hashed + text * np.uint64(0xD1342543DE82EF95))
    ordered = np.sort(own)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        near = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        at = np.flatnonzero(twice[near] == own)
        at = at[np.argsort(own[at], kind="stable")]
        new = np.concatenate([[True], own[at][1:] != own[at][:-1]])
        run = np.flatnonzero(new)
        occurrence = np.arange(len(at)) - np.repeat(run, np.diff(np.concatenate([run, [len(at)]])))
        hashed[at] = _mix(hashed[at] + occurrence.astype(np.uint64) * _STEP)
    return hashed, n


def _places(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n - 1 for each n."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def sketch(words: np.ndarray, counts: np.ndarray, k: int, sketches: int) -> np.ndarray:
    """An order-sensitive key per text and hash function; every text must have words."""
    kmers, n = _kmers(words, counts, k)
    offsets = np.cumsum(n) - n
    factors = np.random.default_rng(99).integers(1, 2**63, sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(n), sketches), np.uint64)
    for i, factor in enumerate(factors):
        order = kmers * factor
        least = _where_least(order, offsets, n)
        order[least] = _MAX
        second = np.where(n > 1, _where_least(order, offsets, n), least)
        left, right = kmers[np.minimum(least, second)], kmers[np.maximum(least, second)]
        out[:, i] = _mix((left * _STEP) ^ _mix(right + np.uint64(i)))
    return out.view(np.int64)


def _where_least(values: np.ndarray, offsets: np.ndarray, n: np.ndarray) -> np.ndarray:
    least = np.minimum.reduceat(values, offsets)
    at = np.flatnonzero(values == np.repeat(least, n))
    return at if len(at) == len(n) else at[np.searchsorted(at, offsets)]


def sketch_texts(texts: Sequence[str | None], k: int, sketches: int) -> tuple[list, list, list]:
    """(digest, 32-bit word hashes as bytes, keys) per text, None for texts without words."""
    digests: list[bytes | None] = [None] * len(texts)
    words: list[bytes | None] = [None] * len(texts)
    keys: list[np.ndarray | None] = [None] * len(texts)
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held:
            counts = np.array([len(h) for _, h in held])
            found = sketch(np.concatenate([h for _, h in held]), counts, k, sketches)
            for (i, _), own in zip(held, found, strict=True):
                keys[i] = own
            held.clear()

    size = 0
    for i, text in enumerate(texts):
        data = normalised(text)
        if not data:
            continue
        hashes = word_hashes(data)
        digests[i] = hashlib.sha256(data).digest()
        words[i] = hashes.astype(np.uint32).tobytes()
        held.append((i, hashes))
        size += len(data)
        if size > CHUNK_BYTES:
            flush()
            size = 0
    flush()
    return digests, words, keys


def bag(words: np.ndarray) -> bytes:
    """How many words have each hash modulo ``BAG``, 15 at most, two to a byte."""
    counts = np.minimum(np.bincount(words % BAG, minlength=BAG), 15).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes()


def unpacked(bags: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A row of counts per bag."""
    packed = np.frombuffer(b"".join(bags.to_pylist()), np.uint8).reshape(len(bags), BAG // 2)
    return np.stack([packed & 15, packed >> 4], axis=2).reshape(len(bags), BAG).astype(np.int8)


def may_be_similar(
    left: np.ndarray, right: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, threshold: float
) -> np.ndarray:
    """Whether sizes in words and bags allow pairs to be similar. One edit takes one word at most
    from a text and adds one at most, and counts that stop at 15 only differ less."""
    limit = ((1 - threshold) * np.maximum(sizes, other_sizes) + 1e-9).astype(np.int64)
    differ = left - right
    fewer = np.maximum(differ, 0).sum(axis=-1, dtype=np.int64)
    more = fewer - differ.sum(axis=-1, dtype=np.int64)
    return (np.abs(sizes - other_sizes) <= limit) & (fewer <= limit) & (more <= limit)


def edit_distance_within(left: Sequence[int], right: Sequence[int], limit: int) -> int | None:
    """The edit distance if it is at most ``limit``, by alignment within a band of that many
    diagonals either side; the differences down the band are held in the bits of integers
    (the bit-parallel method of Myers in Hyyrö's banded form)."""
    if len(left) < len(right):
        left, right = right, left
    rows, columns = len(left), len(right)
    if rows - columns > limit:
        return None
    band = min(limit, rows)
    width = 2 * band + 2
    full, bottom = (1 << width) - 1, 1 << (width - 1)
    where: dict[int, int] = {}
    for i, word in enumerate(left):
        where[word] = where.get(word, 0) | (1 << i)
    # The last bit stands for row column + band; only rows of the text itself rise at first.
    up, down, distance, start = full ^ ((1 << (width - band - 1)) - 1), 0, band, band + 1 - width
    across = bottom >> 1
    for column, word in enumerate(right):
        match = where.get(word, 0)
        match = (match >> start if start > 0 else match << -start) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        rise, fall = down | (full & ~(diagonal | up)), diagonal & up
        if column < rows - band:
            distance += not diagonal & bottom
        else:
            distance += bool(rise & across) - bool(fall & across)
            across >>= 1
        moved = diagonal >> 1
        up, down = fall | (full & ~(moved | rise)), moved & rise
        start += 1
    return distance if distance <= limit else None


def similar(left: np.ndarray, right: np.ndarray, threshold: float) -> bool:
    """Whether one minus the edit distance over the longer length is at least ``threshold``."""
    longer = max(len(left), len(right))
    limit = int((1 - threshold) * longer + 1e-9)
    if longer - min(len(left), len(right)) > limit:
        return False
    left, right = _unlike(left, right)
    if not len(left) or not len(right):
        return max(len(left), len(right)) <= limit
    words, counts = np.unique(left, return_counts=True)
    others, other_counts = np.unique(right, return_counts=True)
    _, a, b = np.intersect1d(words, others, assume_unique=True, return_indices=True)
    shared = int(np.minimum(counts[a], other_counts[b]).sum())
    if max(len(left), len(right)) - shared > limit:
        return False
    return edit_distance_within(left.tolist(), right.tolist(), limit) is not None


def _unlike(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without common start and end."""
    n = min(len(left), len(right))
    differ = np.flatnonzero(left[:n] != right[:n])
    start = int(differ[0]) if len(differ) else n
    left, right = left[start:], right[start:]
    n = min(len(left), len(right))
    differ = np.flatnonzero(left[len(left) - n :][::-1] != right[len(right) - n :][::-1])
    end = int(differ[0]) if len(differ) else n
    return left[: len(left) - end], right[: len(right) - end]


def allowed_edits(n: int, threshold: float) -> int:
    """Edits that a pair may have whose longer text has ``n`` words."""
    return int((1 - threshold) * n + 1e-9)


def shortest_long(threshold: float) -> int:
    """Texts of fewer words can be similar to one of fewer than ``SHORT``."""
    n = SHORT
    while n - allowed_edits(n, threshold) < SHORT:
        n += 1
    return n


def rare_word_keys(words: np.ndarray, ranks: dict[int, int], threshold: float) -> list[int]:
    """Keys of the rarest words of a short text, one more than it may have edits.

    Of a pair whose longer text has n words and e edits, n - e words, with their repeats, are
    in both. In any one order of all words, a text of m words then has one of the common ones
    among its first m - (n - e) + 1, which is never more than its own allowed edits and one."""
    seen: dict[int, int] = {}
    labelled = []
    for word in words.tolist():
        seen[word] = times = seen.get(word, 0) + 1
        labelled.append((ranks.get(word, -1), word, times))
    labelled.sort()
    first = labelled[: allowed_edits(len(words), threshold) + 1]
    codes = np.array([(word << 16) | times for _, word, times in first], np.uint64)
    return _mix(codes + _STEP).view(np.int64).tolist()


def _word_ranks(rows: DataFrame, threshold: float) -> dict[int, int]:
    """Common words of a sample of short texts, the more common the higher. Any order gives the
    same pairs, a rare word first gives small groups."""
    short = rows.select("text").where(F.char_length("text") < 8 * shortest_long(threshold))
    sample = short.where(F.rand(5) * F.lit(rows.count()) < SAMPLE_TEXTS).limit(2 * SAMPLE_TEXTS).collect()
    held = [word_hashes(normalised(r.text)).astype(np.uint32) for r in sample]
    if not held:
        return {}
    found, counts = np.unique(np.concatenate(held), return_counts=True)
    often = np.flatnonzero(counts > 2)
    order = often[np.argsort(counts[often], kind="stable")]
    return {int(word): rank for rank, word in enumerate(found[order])}


def _sketched(rows: DataFrame, k: int, sketches: int, threshold: float) -> DataFrame:
    """Adds digest, words, their number, bag and keys; drops the text."""
    ranks, long = _word_ranks(rows, threshold), 4 * shortest_long(threshold)
    fields = [f for f in rows.schema if f.name != "text"]
    added = "digest binary, words binary, size int, bag binary, keys array<bigint>"
    schema = T.StructType([*fields, *T._parse_datatype_string(added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 512):
                part = batch.slice(at, 512)
                digests, words, keys = sketch_texts(part.column("text").to_pylist(), k, sketches)
                for i, data in enumerate(words):
                    if data is not None and len(data) < long:
                        rare = rare_word_keys(np.frombuffer(data, np.uint32), ranks, threshold)
                        keys[i] = np.concatenate([keys[i], np.array(rare, np.int64)])
                sizes = [None if data is None else len(data) // 4 for data in words]
                bags = [None if data is None else bag(np.frombuffer(data, np.uint32)) for data in words]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in fields), pa.array(digests, pa.binary()),
                     pa.array(words, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bags, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))],
                    names=schema.fieldNames(),
                )

    return rows.mapInArrow(run, schema)


def _groups(texts: DataFrame) -> DataFrame:
    """(key, uid, centre, members): the texts of every key that several have, with the least of them."""
    # Dealt by key once, for the counts and for the rows that they are joined to.
    keys = texts.select("uid", F.explode("keys").alias("key")).repartition("key")
    shared = keys.groupBy("key").agg(F.min("uid").alias("centre"), F.count(F.lit(1)).alias("members"))
    return keys.join(shared.where("members > 1"), "key")


def _open(groups: DataFrame, roots: DataFrame, words: DataFrame) -> DataFrame:
    """(key, uid, root, size, n, words) of the groups whose members, without the centre, are not
    all in one component yet."""
    rest = groups.where("members > 2 AND uid <> centre").select("key", "uid")
    known = words.select("uid", "size").join(roots.withColumnRenamed("node", "uid"), "uid", "left")
    met = rest.join(known.withColumn("root", F.coalesce("root", "uid")), "uid")
    apart = met.groupBy("key").agg(
        F.min("root").alias("one"), F.max("root").alias("other"), F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("words"),
    )
    return met.join(apart.where("one <> other").drop("one", "other"), "key")


def _sift(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs (a, b, size, bag, size_b, bag_b) that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, others = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "size_b"))
            left, right = (unpacked(batch.column(c)) for c in ("bag", "bag_b"))
            may = may_be_similar(left, right, sizes, others, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(may, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _sifted(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sizes and bags allow them to be similar."""
    left = words.select(F.col("uid").alias("a"), "size", "bag")
    right = words.select(F.col("uid").alias("b"), F.col("size").alias("size_b"), F.col("bag").alias("bag_b"))
    return _sift(pairs.join(right, "b").join(left, "a"), threshold)


def _pairs_apart(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): all pairs of a group that are in two components and may be similar."""
    right = members.select(
        "key", F.col("uid").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("size_b"),
        F.col("bag").alias("bag_b"),
    )
    longer, shorter = F.greatest("size", "size_b"), F.least("size", "size_b")
    near = longer - shorter <= longer * (1 - threshold) + 1e-6
    met = members.join(right, "key").where((F.col("uid") < F.col("b")) & (F.col("root") != F.col("root_b")) & near)
    return _sift(met.withColumnRenamed("uid", "a"), threshold).distinct()


def _in_blocks(members: DataFrame) -> DataFrame:
    """(key, i, j, block, uid, root, size, bag): every member once for each pair of blocks that its
    own is in."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(4 * F.col("words") / BLOCK_BYTES))
    own = F.pmod(F.xxhash64("uid"), blocks).cast("int")
    dealt = members.select(
        "key", "uid", "root", "size", "bag", own.alias("block"), blocks.cast("int").alias("blocks")
    )
    every = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return every.select(
        "key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "uid", "root",
        "size", "bag",
    )


def _with_partner(threshold: float):
    """The rows of one block with another, or with itself, that may be similar to one of another
    component."""

    def run(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        block, root = table.column("block").to_numpy(), table.column("root").to_numpy()
        sizes, bags = table.column("size").to_numpy().astype(np.int64), unpacked(table.column("bag"))
        kept = np.zeros(len(sizes), bool)
        for x in range(len(sizes)):
            others = x + 1 + np.flatnonzero(root[x + 1 :] != root[x])
            if i != j:
                others = others[block[others] != block[x]]
            others = others[may_be_similar(bags[others], bags[x], sizes[others], sizes[x], threshold)]
            kept[others] = True
            kept[x] |= len(others) > 0
        return table.select(["key", "i", "j", "block", "uid", "root"]).filter(pa.array(kept, pa.bool_()))

    return run


def _block_links(threshold: float, sketches: int):
    """Links of one block with another, or with itself, that join two components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        words = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("words")]
        uid, block = table.column("uid").to_numpy(), table.column("block").to_numpy()
        keys = np.array([k.as_py()[:sketches] for k in table.column("keys")], np.int64)
        here, i, j = (table.column(c)[0].as_py() for c in ("key", "i", "j"))
        label = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
        sizes = np.array([len(w) for w in words])
        # At least the longer text's words, less those that both have, are edited.
        bags = np.zeros((len(words), BUCKETS), np.uint16 if sizes.max() < 1 << 16 else np.uint32)
        for at, own in enumerate(words):
            bags[at] = np.bincount(own % BUCKETS, minlength=BUCKETS)
        a, b = [], []
        for x in range(len(words)):
            others = np.arange(x + 1, len(words))
            if i != j:
                others = others[block[others] != block[x]]
            others = others[label[others] != label[x]]
            longer = np.maximum(sizes[others], sizes[x])
            limit = ((1 - threshold) * longer + 1e-9).astype(np.int64)
            near = longer - np.minimum(sizes[others], sizes[x]) <= limit
            others, longer, limit = others[near], longer[near], limit[near]
            # A pair is compared in the group of the first sketch that both share.
            first = np.flatnonzero(keys[x] == here)
            if len(first) and len(others):
                new = ~(keys[others, : first[0]] == keys[x, : first[0]]).any(axis=1)
                others, longer, limit = others[new], longer[new], limit[new]
            both = np.minimum(bags[others], bags[x]).sum(axis=1, dtype=np.int64)
            for y in others[longer - both <= limit]:
                if label[y] != label[x] and similar(words[x], words[y], threshold):
                    a.append(uid[x])
                    b.append(uid[y])
                    label[label == label[y]] = label[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _similar_pairs(
    texts: DataFrame, words: DataFrame, scratch: Scratch, sketches: int, threshold: float, n: int
) -> DataFrame:
    """(a, b): similar pairs of ``texts`` (uid, keys), whose ``words`` (uid, words, size, bag, keys) has
    among others. Their components are those of all similar pairs that share a key."""
    groups = scratch.keep(_groups(texts), "groups")
    pairs = groups.where("uid <> centre").select(F.col("centre").alias("a"), F.col("uid").alias("b")).distinct()
    pairs = scratch.keep(_sifted(scratch.keep(pairs, "pairs", n), words, threshold), "candidates", n)
    found = scratch.keep(_verified(pairs, _of(pairs, words, scratch, n), threshold), "similar")
    rest = scratch.keep(_open(groups, components(found, scratch), words), "open-groups")
    if rest.isEmpty():
        return found
    rest = rest.join(words.select("uid", "bag"), "uid")
    small = scratch.keep(_pairs_apart(rest.where(F.col("n") <= SMALL), threshold), "candidates", n)
    more = scratch.keep(_verified(small, _of(small, words, scratch, n), threshold), "similar")
    large = _in_blocks(rest.where(F.col("n") > SMALL)).groupBy("key", "i", "j")
    large = large.applyInArrow(_with_partner(threshold), "key long, i int, j int, block int, uid long, root long")
    large = scratch.keep(large, "blocks", n).join(words.select("uid", "words", "keys"), "uid")
    linked = large.groupBy("key", "i", "j").applyInArrow(_block_links(threshold, sketches), "a long, b long")
    return found.unionByName(more).unionByName(scratch.keep(linked, "similar"))


def _of(pairs: DataFrame, words: DataFrame, scratch: Scratch, n: int) -> DataFrame:
    """(uid, words) of the texts in ``pairs``. Their ids are written first, so that Spark knows how
    few they are before it moves words."""
    ids = pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct()
    return words.select("uid", "words").join(scratch.keep(ids, "ids", n), "uid", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    left = texts.select(F.col("uid").alias("a"), F.col("words").alias("left"))
    right = texts.select(F.col("uid").alias("b"), F.col("words").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts, rights = batch.column("left"), batch.column("right")
            same = [
                similar(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32), threshold)
                for x, y in zip(lefts, rights, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").mapInArrow(run, "a long, b long")


def _classes(
    rows: DataFrame, scratch: Scratch, k: int, sketches: int, threshold: float
) -> tuple[DataFrame, DataFrame, int]:
    """Of ``rows`` (uid, doc_id, text and others): uid and the others; uid, doc_id, class_id,
    class_size and kept; and how many they are."""
    done = scratch.keep(_sketched(rows, k, sketches, threshold), "sketches")
    n = done.count()
    words = done.where("digest IS NOT NULL")
    one = scratch.keep(words.groupBy("digest").agg(F.min("uid").alias("rep")), "distinct", n)
    copies = words.select("uid", "digest").join(one, "digest").where("uid <> rep").select("uid")
    reps = words.select("uid", "keys").join(scratch.keep(copies, "copies", n), "uid", "left_anti")
    edges = _similar_pairs(reps, words, scratch, sketches, threshold, n)
    roots = components(edges, scratch).withColumnRenamed("node", "rep")
    of_digest = one.join(roots, "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"))
    of_digest = scratch.keep(of_digest, "roots", n)
    narrow = done.select("uid", "doc_id", "digest")
    alone = narrow.where("digest IS NULL").withColumn("root", F.col("uid"))
    member = narrow.join(of_digest, "digest").unionByName(alone).drop("digest")
    member = scratch.keep(member, "members", n)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    by_root = member.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_size"))
    by_root = scratch.keep(by_root, "by-root", n)
    met = member.join(by_root, "root").select(
        "uid", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("first.uid") == F.col("uid")).alias("kept"),
    )
    return done.drop("digest", "words", "size", "bag", "keys", "doc_id"), met, n


def near_classes(
    df: DataFrame,
    k: int = 5,
    sketches: int = 64,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, class_id (the class's smallest id), class_size, kept."""
    rows = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    with Scratch(df.sparkSession) as scratch:
        numbered = rows.withColumn("uid", F.monotonically_increasing_id())
        _, found, n = _classes(numbered, scratch, k, sketches, threshold)
        return scratch.result(found.drop("uid"), "near-classes", n)


def survivors(
    df: DataFrame,
    k: int = 5,
    sketches: int = 64,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each class, with all its columns."""
    rows = df.select(
        F.struct("*").alias("row"), df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text")
    )
    with Scratch(df.sparkSession) as scratch:
        numbered = rows.withColumn("uid", F.monotonically_increasing_id())
        full, found, _ = _classes(numbered, scratch, k, sketches, threshold)
        kept = full.join(found.where("kept").select("uid"), "uid", "left_semi")
        return scratch.result(kept.select("row.*"), "near-survivors")
