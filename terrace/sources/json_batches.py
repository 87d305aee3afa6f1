"""Bronze: reading and landing JSON batches."""

from __future__ import annotations

from datetime import date, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.columns import batch_stamp, day_stamp
from terrace.schemas import CORRUPT_COLUMN
from terrace.sources.guards import require_rows

SOURCE_DAY_COLUMN = "_source_day"
# The file that a record came from.
SOURCE_PATH_COLUMN = "_source_path"
# Daily master extracts carry their day in the path: <name>_YYYYMMDD
SOURCE_DAY_PATTERN = r"_(\d{8})(?=[/.])"
# What may stand between a separator and the end of its line.
_BLANKS = " \t\n\x0b\f\r\x85\u2028\u2029"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


def _is_array(line: Column) -> Column:
    return F.ltrim(line).startswith("[")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of all files that are not blank, read in splits of any file's size."""
    text = spark.read.text(path, recursiveFileLookup=True)
    named = text.select("value", F.col("_metadata.file_path").alias(SOURCE_PATH_COLUMN))
    return named.where(F.trim("value") != "")


def array_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files that hold one array, on one line or over several: their first line opens an array
    and no other line does. A pass over the lines that parses nothing; of a file its name comes
    to the driver, as it did when the folder was listed."""
    text = spark.read.text(path, recursiveFileLookup=True)
    # Blocks of a file start where the one before ends, and a task reads lines in their order.
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.when(F.trim("value") != "", place).alias("place"),
        _is_array(F.col("value")).alias("opens"),
    )
    opening = lines.groupBy("file").agg(F.count_if("opens").alias("n"), F.min_by("opens", "place").alias("first"))
    return [row["file"] for row in opening.where("n = 1 and first").select("file").collect()]


def _from_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of lines that each hold a record or an array of records. A separator after a
    record belongs to the array around it.

    Every line is read and parsed once: no condition on a record's fields passes the generator, where
    it would be one on the text and parse it again for each field."""
    full = with_corrupt_column(schema)
    options = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    # The pattern tries every comma of a line, so only lines that end with one meet it.
    separated = F.rtrim("value", F.lit(_BLANKS)).endswith(",")
    record = F.from_json(
        F.when(separated, F.regexp_replace("value", r",\s*$", "")).otherwise(F.col("value")), full, options
    )
    array = _is_array(F.col("value"))
    parsed = lines.select(
        F.when(~array, record).alias("one"),
        F.when(array, F.from_json("value", T.ArrayType(schema))).alias("items"),
        array.alias("array"), "value", SOURCE_PATH_COLUMN,
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    unparsed = F.array(F.struct(*missing, F.col("value").alias(CORRUPT_COLUMN)))
    held = F.transform(
        F.filter("items", lambda r: r.isNotNull()),
        lambda r: F.struct(*[r[c].alias(c) for c in schema.names], F.lit(None).cast("string").alias(CORRUPT_COLUMN)),
    )
    records = F.when(~F.col("array"), F.array("one")).when(F.col("items").isNull(), unparsed).otherwise(held)
    return parsed.select(F.inline(records), SOURCE_PATH_COLUMN).select(*full.names, SOURCE_PATH_COLUMN)


def _from_arrays(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Records of files that hold one array. One that does not parse is read by its lines, so
    that what can be read is kept and the rest is quarantined."""
    reader = spark.read.schema(with_corrupt_column(schema)).option("multiLine", True)
    read = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json([unquote(f) for f in files])
    rows = read.withColumn(SOURCE_PATH_COLUMN, F.col("_metadata.file_path"))
    # The parser refuses to be asked for unparsed text alone, so a field is always read with it.
    beside = F.substring(F.coalesce(F.col(schema.names[0]).cast("string"), F.lit("")), 1, 0)
    rows = rows.withColumn(CORRUPT_COLUMN, F.concat(CORRUPT_COLUMN, beside))
    whole = rows.where(F.col(CORRUPT_COLUMN).isNull())
    text = rows.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.explode(F.split(CORRUPT_COLUMN, r"\r?\n")).alias("value"), SOURCE_PATH_COLUMN
    )
    return whole.unionByName(_from_lines(text.where(F.trim("value") != ""), schema))


def read_json_batches(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    required: bool = True,
    with_path: bool = False,
) -> DataFrame:
    """Every record of the files below ``path``, plus the text of records that do not parse.

    Decided per file, when this is called: a file that is one array goes to Spark's parser of
    whole files; in any other each line is a record or an array of records, and a file of any size
    is read in splits. A missing path raises unless ``required`` is False, which gives an empty
    table. ``with_path`` adds each record's file.
    """
    try:
        arrays = array_files(spark, path)
        lines = _lines(spark, path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        full = with_corrupt_column(schema).add(SOURCE_PATH_COLUMN, T.StringType())
        found = spark.createDataFrame([], full)
    else:
        if arrays:
            # A condition on the file's name: the others are not opened.
            lines = lines.where(~F.col(SOURCE_PATH_COLUMN).isin(arrays))
        found = _from_lines(lines, schema)
        if arrays:
            found = found.unionByName(_from_arrays(spark, arrays, schema))
    return found if with_path else found.drop(SOURCE_PATH_COLUMN)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed records, quarantined records)."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return df.where(~bad).drop(CORRUPT_COLUMN), df.where(bad)


def with_source_day(df: DataFrame) -> DataFrame:
    """Replaces each record's file by the day of the daily extract that the file belongs to."""
    day = F.regexp_extract(SOURCE_PATH_COLUMN, SOURCE_DAY_PATTERN, 1)
    return df.withColumn(SOURCE_DAY_COLUMN, day).drop(SOURCE_PATH_COLUMN)


def _land(df: DataFrame, path: str, mode: str, label: str, max_records_per_file: int) -> str:
    """Rows that pass one file are landed gzipped, which readers tell by the files' names. A file
    is then read by one task; it holds ``max_records_per_file`` records at most."""
    require_rows(df, label)
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    # A bounded look: each task stops at the limit.
    if df.limit(max_records_per_file + 1).count() > max_records_per_file:
        writer = writer.option("compression", "gzip")
    writer.json(path)
    return path


def land_daily_snapshot(
    df: DataFrame,
    prefix: str,
    day: date,
    max_records_per_file: int = 100_000,
) -> str:
    """One full master extract per day; landing the same day again replaces it."""
    name = prefix.rstrip("/").rsplit("/", 1)[-1]
    path = f"{prefix}/{name}_{day_stamp(day)}"
    return _land(df, path, "overwrite", name, max_records_per_file)


def land_batch(
    df: DataFrame,
    prefix: str,
    batch_ts: datetime,
    max_records_per_file: int = 100_000,
) -> str:
    """One new, immutable batch; a second batch with the same stamp is refused."""
    path = f"{prefix}/batch_{batch_stamp(batch_ts)}"
    return _land(df, path, "errorifexists", prefix, max_records_per_file)
