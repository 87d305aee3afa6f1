"""Optional relational source and sink. The caller's session supplies the driver jar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Bounds that turn a table scan into ``partitions`` range queries."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def write_options(
    url: str,
    table: str,
    mode: str,
    properties: dict[str, str] | None = None,
    batch_size: int = 10_000,
    connections: int = 16,
) -> dict[str, str]:
    """``overwrite`` truncates, so the table keeps its definition and grants."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode: {mode}")
    return {
        "url": url,
        "dbtable": table,
        "truncate": str(mode == "overwrite").lower(),
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **(properties or {}),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, properties, split)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str,
    properties: dict[str, str] | None = None,
) -> None:
    df.write.format("jdbc").options(**write_options(url, table, mode, properties)).mode(mode).save()
