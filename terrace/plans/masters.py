"""Raw masters from daily extracts, folded extract day by extract day.

The newest version of each key counts, by the day of its extract. What a run keeps besides the
master is the *settled* part: the newest version per key, with its day, of all days before the
newest one, and the files that it was made from. The newest day's extract is landed again and again,
so a run parses that day and later ones only. If a file of a settled day came, went or
changed, everything is parsed again, which gives the same table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import Layout
from terrace.operators.dedup import latest_version
from terrace.plans.silver import clean, with_types
from terrace.schemas import CORRUPT_COLUMN, Entity
from terrace.session import drops_shuffles
from terrace.sources.json_batches import (
    SOURCE_DAY_COLUMN,
    SOURCE_DAY_PATTERN,
    read_json_batches,
    split_corrupt,
    with_source_day,
)
from terrace.sources.paths import FileFacts, exists, facts_below
from terrace.sources.versioned import is_published, publish, read_current, read_version

_SEEN_SCHEMA = "path string, modified long, length long, settled string, settled_to string"


@dataclass(frozen=True)
class _Settled:
    """The files of the settled days (before ``day``) and the version that holds their rows."""

    files: frozenset[FileFacts]
    version: str
    day: str


def _day(file: FileFacts) -> str:
    found = re.search(SOURCE_DAY_PATTERN, file.path)
    return found.group(1) if found else ""


def _read_settled(spark: SparkSession, layout: Layout, entity: Entity) -> _Settled | None:
    path = layout.state(f"{entity.name}_seen")
    if not is_published(spark, path):
        return None
    # One row per extract file.
    rows = read_current(spark, path).collect()
    if not rows:
        return None
    files = frozenset(FileFacts(r["path"], r["modified"], r["length"]) for r in rows)
    return _Settled(files, rows[0]["settled"], rows[0]["settled_to"])


def _parse(
    spark: SparkSession, entity: Entity, path: str, files: Sequence[FileFacts]
) -> tuple[DataFrame, DataFrame]:
    """(records, unparsed records), both with their extract's day."""
    landed = read_json_batches(
        spark, [f.path for f in files] or path, entity.bronze_schema, with_path=True
    )
    parsed, bad = split_corrupt(with_source_day(landed))
    # Typed before versions are compared, so that ties of a day end as they do in the master.
    typed = with_types(parsed, entity.integers, entity.floats, entity.timestamps)
    return typed, bad.select(CORRUPT_COLUMN, SOURCE_DAY_COLUMN)


@drops_shuffles
def build_master(
    spark: SparkSession,
    layout: Layout,
    entity: Entity,
    run_ts: datetime | None = None,
    full: bool = False,
) -> bool:
    """Bring one raw master in line with its daily extracts. Records that do not parse go to the
    master's quarantine; extracts without a readable record change nothing. ``full`` parses all
    extracts again."""
    path = layout.bronze(entity.name)
    if not exists(spark, path):
        raise FileNotFoundError(f"no folder {path}")
    files = facts_below(spark, path)
    settled = None if full else _read_settled(spark, layout, entity)
    if settled is not None and {f for f in files if _day(f) < settled.day} != settled.files:
        settled = None
    open_files = files if settled is None else [f for f in files if _day(f) >= settled.day]
    parsed, bad = _parse(spark, entity, path, open_files)
    quarantine = layout.quarantine(entity.name)
    if settled is not None and is_published(spark, quarantine):
        earlier = read_current(spark, quarantine).where(F.col(SOURCE_DAY_COLUMN) < settled.day)
        bad = earlier.unionByName(bad)
    if not bad.isEmpty() or is_published(spark, quarantine):
        publish(bad, quarantine)
    if settled is not None:
        root = layout.state(f"{entity.name}_settled")
        parsed = parsed.unionByName(read_version(spark, root, settled.version))
    if parsed.isEmpty():
        return False
    publish(clean(parsed, entity, run_ts), layout.raw(entity.name))
    newest = max(map(_day, files))
    if settled is None or newest > settled.day:
        _settle(spark, layout, entity, parsed, files, newest, settled)
    return True


def _settle(
    spark: SparkSession,
    layout: Layout,
    entity: Entity,
    parsed: DataFrame,
    files: Sequence[FileFacts],
    newest: str,
    before: _Settled | None,
) -> None:
    """Fold all days before ``newest``. The list of files is published last: it is the commit."""
    earlier = parsed.where(F.col(SOURCE_DAY_COLUMN) < newest)
    rows = latest_version(earlier, [entity.key], [SOURCE_DAY_COLUMN])
    version = publish(rows, layout.state(f"{entity.name}_settled"), protect=before.version if before else None)
    listed = [(f.path, f.modified, f.length, version, newest) for f in files if _day(f) < newest]
    # With one day only there is nothing to list, and the next run parses it again.
    publish(spark.createDataFrame(listed, _SEEN_SCHEMA).coalesce(1), layout.state(f"{entity.name}_seen"))
