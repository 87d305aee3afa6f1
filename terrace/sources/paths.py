"""File-system questions asked through the session's own Hadoop configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (used for folders with a bounded number of entries)."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


@dataclass(frozen=True)
class FileFacts:
    """What tells one writing of a file from another."""

    path: str
    modified: int
    length: int


def facts_below(spark: SparkSession, path: str) -> list[FileFacts]:
    """Data files at any depth, without the hidden ones (a run's new files, not a history)."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    found, walk = [], fs.listFiles(target, True)
    root = fs.makeQualified(target).toString().rstrip("/")
    while walk.hasNext():
        status = walk.next()
        name = status.getPath().toString()
        inner = name.removeprefix(root).strip("/")
        if not any(part.startswith(("_", ".")) for part in inner.split("/")):
            found.append(FileFacts(name, status.getModificationTime(), status.getLen()))
    return sorted(found, key=lambda f: f.path)


def files_below(spark: SparkSession, path: str) -> list[str]:
    return [f.path for f in facts_below(spark, path)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target)


def move(spark: SparkSession, file: str, target: str) -> None:
    """Rename a file, making the folders it needs."""
    fs, source = _locate(spark, file)
    _, goal = _locate(spark, target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"{file} could not be moved to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)
