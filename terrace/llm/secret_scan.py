"""Secret scan with a random forest that removes false positives.

A finding is a run of at least ``MIN_LENGTH`` characters that keys and tokens are made of.
Labelled findings train a random forest on

* the length, and the shares of digits and of changes between kinds of characters,
* the surprise of its character transitions, in bits a character, under the transitions of
  the corpus's words,
* the share of it that words of the corpus's dictionary cover,
* how often labelled findings of the same path and beside the same words were secrets.

Dictionary and transitions are counted over all documents: a word is in the dictionary if it
has 3 to 24 letters and is in ``ENOUGH`` documents, or where there are few in at least one of
``1 / RARE``. Transitions have 28 * 28 rows. The forest is fitted on at most ``sample`` labelled
findings, those with the least digest; rates count all labelled findings.
Everything runs as built-in expressions and Spark's own machine learning.

Defined results: null and empty texts have no findings; a run of any length is one finding;
equal findings at other places are findings of their own, and repeated rows repeat them; null
ids and null paths are kept, a null path is a path; with no labelled findings of both kinds
nothing is removed, scores are null; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.scratch import Scratch

MIN_LENGTH = 16
RUN = r"[A-Za-z0-9+/_\-]{16,}"
# From the end of the last match up to a run, and the run.
UP_TO_RUN = rf"(?s)\G.*?{RUN}"
# Characters beside a finding, up to the finding before it, in which neighbouring words are
# looked for.
BESIDE = 64
# Letters of a dictionary word, and characters of a finding that are looked up together.
LETTERS = (3, 24)
CHUNK = 1024
RARE = 0.001
# So many documents with a word are enough, however many there are.
ENOUGH = 20
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0#"
# Bits for a transition that the corpus never makes.
UNSEEN = 16.0
# A neighbouring word or path counts as this many findings of the average rate besides its own.
PRIOR = 4.0
# Rows of a table of words or rates that is broadcast.
FEW = 10_000
FEATURES = ["length", "digits", "changes", "surprise", "coverage", "path_rate", "before_rate", "after_rate"]


def _sum_of(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n)


def findings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Per candidate: doc_id, path, start, candidate, before and after (neighbouring words)."""
    text = df[text_col]
    rows = df.where(text.rlike(RUN)).select(
        df[id_col].cast("long").alias("doc_id"), df[path_col].cast("string").alias("path"), text.alias("text"),
        F.regexp_extract_all(text, F.lit(UP_TO_RUN), F.lit(0)).alias("parts"),
    )
    rows = rows.withColumn("lengths", F.transform("parts", lambda p: F.char_length(p)))
    total = _sum_of(F.col("lengths"))
    rows = rows.withColumn("rest", F.substring("text", total + 1, F.lit(BESIDE)))
    # Sums over stretches of about as many lengths as there are stretches: a text with very many
    # findings costs their number times its root, not its square.
    stretch = F.ceil(F.sqrt(F.size("lengths"))).cast("int")
    rows = rows.withColumn("stretch", F.greatest(stretch, F.lit(1)))
    last = F.floor((F.size("lengths") - 1) / F.col("stretch")).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), last),
        lambda s: _sum_of(F.slice("lengths", s * F.col("stretch") + 1, F.col("stretch"))),
    )
    rows = rows.withColumn("sums", sums)
    starts = F.transform(F.sequence(F.lit(0), last), lambda s: _sum_of(F.slice("sums", 1, s)))
    rows = rows.withColumn("starts", starts)

    def found(part: Column, n: Column) -> Column:
        s = F.floor(n / F.col("stretch")).cast("int")
        first = s * F.col("stretch")
        end = F.get("starts", s) + _sum_of(F.slice("lengths", first + 1, n - first + 1))
        following = F.coalesce(F.left(F.get("parts", n + 1), F.lit(BESIDE)), F.col("rest"))
        run = F.regexp_extract(part, rf"{RUN}$", 0)
        ahead = F.right(F.left(part, F.char_length(part) - F.char_length(run)), F.lit(BESIDE))
        return F.struct(end.alias("end"), run.alias("candidate"), ahead.alias("ahead"), following.alias("following"))

    # Only short stretches are sent along with a finding, never the text.
    each = rows.select("doc_id", "path", F.explode(F.transform("parts", found)).alias("f")).select("doc_id", "path", "f.*")
    return each.select(
        "doc_id", "path", (F.col("end") - F.char_length("candidate")).cast("long").alias("start"), "candidate",
        F.lower(F.regexp_extract("ahead", r"(\p{L}+)[^\p{L}]*$", 1)).alias("before"),
        F.lower(F.regexp_extract("following", r"^[^\p{L}]*(\p{L}+)", 1)).alias("after"),
    )


def dictionary(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, documents) of the words that are common enough."""
    words = F.array_distinct(F.split(F.lower(df[text_col]), r"[^\p{L}]+"))
    found = df.select(F.explode(words).alias("word"))
    counted = found.where(F.char_length("word").between(*LETTERS)).groupBy("word").agg(
        F.count(F.lit(1)).alias("documents")
    )
    least = min(max(df.count() * RARE, 2), ENOUGH)
    return counted.where(F.col("documents") >= least)


def _symbols(text: Column) -> Column:
    """Each character as the number of its symbol."""
    one = F.regexp_replace(F.regexp_replace(F.lower(text), r"[0-9]", "0"), r"[^a-z0]", "#")
    return F.transform(F.split(one, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)


def _steps(symbols: Column) -> Column:
    """The number of each transition."""
    size = len(SYMBOLS)
    pairs = F.zip_with(symbols, F.slice(symbols, 2, F.greatest(F.size(symbols) - 1, F.lit(0))), lambda a, b: a * size + b)
    return F.filter(pairs, lambda p: p.isNotNull())


def transitions(words: DataFrame) -> list[float]:
    """Bits of each transition, by its number, in the words as often as documents have them."""
    from math import log2

    spelled = words.withColumn("symbols", _steps(_symbols(F.concat(F.lit("#"), F.col("word"), F.lit("#")))))
    rows = spelled.select(F.explode("symbols").alias("step"), "documents").groupBy("step").agg(F.sum("documents").alias("n")).collect()
    size, seen = len(SYMBOLS), {r.step: r.n for r in rows}
    bits = []
    for left in range(size):
        total = sum(seen.get(left * size + right, 0) for right in range(size))
        for right in range(size):
            n = seen.get(left * size + right, 0)
            bits.append(min(UNSEEN, -log2(n / total)) if n else UNSEEN)
    return bits


def _measured(table: DataFrame) -> DataFrame:
    """Broadcast in a join if it is measured to be small, else sorted and merged."""
    return table.hint("broadcast" if table.limit(FEW + 1).count() <= FEW else "merge")


def coverage(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """(key, coverage) by the digest of a candidate: the share of its characters that
    dictionary words cover, at each place the longest one."""
    least, most = LETTERS
    # Candidates are ASCII, so bytes are characters.
    low, size = F.lower("candidate").cast("binary"), F.char_length("candidate")

    def slices(of: Column, starts: Column, length: int) -> Column:
        return F.transform(starts, lambda at: F.struct(at.alias("at"), F.substring(of, at, F.lit(length)).alias("slice")))

    chunks = candidates.select(
        F.sha2("candidate", 256).alias("key"), size.alias("size"),
        F.explode(slices(low, F.sequence(F.lit(1), size, F.lit(CHUNK)), CHUNK + most - 1)).alias("chunk"),
    )
    inner = F.sequence(F.lit(1), F.least(F.lit(CHUNK), F.col("size") - F.col("chunk.at") + 1))
    places = chunks.select("key", "size", F.col("chunk.at").alias("base"), F.explode(slices(F.col("chunk.slice"), inner, most)).alias("p"))
    ahead = places.select(
        "key", "size", (F.col("base") + F.col("p.at") - 1).alias("at"),
        F.regexp_extract(F.col("p.slice").cast("string"), r"^[a-z]+", 0).alias("letters"),
    )
    pieces = ahead.where(F.char_length("letters") >= least).select(
        "key", "size", "at", F.explode(F.sequence(F.lit(least), F.char_length("letters"))).alias("n"), "letters"
    )
    met = pieces.select("key", "size", "at", "n", F.left("letters", F.col("n")).alias("word")).join(_measured(words.select("word")), "word")
    longest = met.groupBy("key", "size", "at").agg(F.max("n").alias("n"))
    covered = longest.select("key", "size", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("place"))
    counted = covered.distinct().groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("key", (F.col("n") / F.col("size")).alias("coverage"))


def described(found: DataFrame, words: DataFrame, bits: list[float]) -> DataFrame:
    """Adds the features that need no labels."""
    text = F.col("candidate")
    size = F.char_length(text)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    steps = _steps(_symbols(text))
    table = F.array(*[F.lit(b) for b in bits])
    surprise = F.aggregate(F.transform(steps, lambda s: F.get(table, s)), F.lit(0.0), lambda t, b: t + b)
    covered = coverage(found.select("candidate").distinct(), words)
    return found.withColumn("key", F.sha2(text, 256)).join(covered, "key", "left").drop("key").withColumns(
        {
            "coverage": F.coalesce("coverage", F.lit(0.0)),
            "length": size.cast("double"),
            "digits": F.char_length(F.regexp_replace(text, "[^0-9]", "")) / size,
            "changes": (F.char_length(kinds) - 1) / size,
            "surprise": surprise / F.greatest(F.size(steps), F.lit(1)),
        }
    )


def with_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds the rates of secrets by path and neighbouring word among ``labelled`` findings."""
    mean = labelled.agg(F.avg("label")).first()[0]
    for name, column in (("path_rate", "path"), ("before_rate", "before"), ("after_rate", "after")):
        known = labelled.groupBy(F.col(column).alias("key")).agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n"))
        known = _measured(known)
        rate = (F.coalesce("s", F.lit(0.0)) + PRIOR * mean) / (F.coalesce("n", F.lit(0)) + PRIOR)
        rows = rows.join(known, F.col(column).eqNullSafe(F.col("key")), "left").withColumn(name, rate).drop("key", "s", "n")
    return rows


def scan(
    df: DataFrame,
    label: Column,
    sample: int = 20_000,
    trees: int = 40,
    depth: int = 8,
    threshold: float = 0.5,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
) -> DataFrame:
    """Per finding: doc_id, start, length, candidate, before, after, path, label, score,
    is_secret. ``label`` is an expression over the columns of ``findings``: true or false for
    labelled findings, null for the others."""
    with Scratch(df.sparkSession) as scratch:
        found = scratch.keep(findings(df, id_col, text_col, path_col), "findings")
        words = scratch.keep(dictionary(df, text_col), "dictionary")
        known = scratch.keep(
            described(found, words, transitions(words)).withColumn("label", label.cast("double")), "described"
        )
        named = F.xxhash64("doc_id", "start", "candidate")
        labelled = known.where("label IS NOT NULL")
        chosen = labelled.orderBy(named, "doc_id", "start", "candidate").limit(sample)
        chosen = scratch.keep(chosen, "labelled")
        out = ["doc_id", "start", F.col("length").cast("long").alias("length"), "candidate", "before", "after",
               "path", F.col("label").cast("boolean").alias("label"), "score", "is_secret"]
        if chosen.select("label").distinct().count() < 2:
            plain = known.withColumns({"score": F.lit(None).cast("double"), "is_secret": F.lit(True)})
            return scratch.result(plain.select(*out), "secrets")
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        # A finding's own label is kept out of its rates: two halves supply each other's.
        half = F.pmod(named, F.lit(2)) == 0
        # Rates count all labelled findings, only the fit is of a sample.
        one, two = labelled.where(half), labelled.where(~half)
        if _both(one, two):
            rated = with_rates(chosen.where(half), two).unionByName(with_rates(chosen.where(~half), one))
        else:
            rated = with_rates(chosen, labelled)
        # A bounded sample in one sorted partition, so that the forest is the same each time.
        ready = scratch.keep(rated.repartition(1).sortWithinPartitions("doc_id", "start", "candidate"), "training")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(assembler.transform(ready))
        scored = forest.transform(assembler.transform(with_rates(known, labelled)))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
        return scratch.result(scored.withColumn("is_secret", F.col("score") >= threshold).select(*out), "secrets")


def _both(one: DataFrame, two: DataFrame) -> bool:
    return not (one.isEmpty() or two.isEmpty())


def known_formats() -> Column:
    """Labels by what needs no guess: true for a provider's key format and for what is assigned
    to the name of a credential, false for plain numbers and plain letters elsewhere, null for
    the rest."""
    # A public key format and common names of credentials.
    text, named = F.col("candidate"), F.col("before").isin("token", "password", "passwd", "secret", "apikey", "key")
    mixed = text.rlike("[0-9]") & text.rlike("[A-Za-z]")
    return (
        F.when(text.rlike(r"^AKIA[0-9A-Z]{16}$") | (named & mixed), True)
        .when(text.rlike(r"^[0-9]+$") | text.rlike(r"^[A-Za-z]+$"), False)
        .otherwise(F.lit(None))
    )
