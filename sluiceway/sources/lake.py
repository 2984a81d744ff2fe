"""Parquet tables of the lake: snapshots replaced as a whole, and time-window partitions.

A snapshot table is a folder with one data folder per version and small numbered pointers::

    t.pq/snapshot-<id>/part-*.parquet
    t.pq/_pointers/000000000007        {"snapshot": .., "files": .., "bytes": ..} and a checksum

A version exists from the moment its pointer does. Pointers are created, never changed or
moved, so nothing needs the atomic rename of a folder, which object stores do not have. Readers
take the highest pointer that is complete; a writer that dies before or while it writes the
pointer leaves the table as it was.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.sources.storage import (
    FileTaken,
    create_file,
    delete_path,
    list_files,
    read_file,
)

WINDOW_COLUMN = "window_id"
_WINDOW_FORMAT = "%Y%m%d%H%M%S"

#: How long a replaced version stays, for readers that are still at it.
KEEP = timedelta(days=1)
_POINTERS, _DATA = "_pointers", "snapshot-"
_DIGITS = 12


def lake_path(root: str, database: str, layer: str, table: str) -> str:
    """``<root>/<database>/<layer>/<table>.pq``; the database is not repeated in the table."""
    return f"{root.rstrip('/')}/{database}/{layer}/{table.replace(f'{database}_', '')}.pq"


@dataclass(frozen=True)
class Snapshot:
    """A version of a table: its number, folder, and the Parquet files of that folder."""

    number: int
    folder: str
    files: int
    bytes: int


def _sealed(content: str) -> str:
    return f"{content}\n{zlib.crc32(content.encode()):08x}"


def _opened(text: str) -> dict | None:
    """The content of a pointer; None if it is not complete."""
    content, _, seal = text.rpartition("\n")
    return json.loads(content) if seal and _sealed(content) == text else None


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """The versions of a table that have a complete pointer, newest first."""
    names = sorted((f.name for f in list_files(spark, f"{path}/{_POINTERS}")), reverse=True)
    return [s for s in (_snapshot(spark, path, name) for name in names if name.isdigit()) if s]


def _snapshot(spark: SparkSession, path: str, name: str) -> Snapshot | None:
    found = _opened(read_file(spark, f"{path}/{_POINTERS}/{name}"))
    if found is None:
        return None
    return Snapshot(int(name), f"{path}/{found['snapshot']}", found["files"], found["bytes"])


def current_snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The version readers get; None if there is none."""
    names = sorted((f.name for f in list_files(spark, f"{path}/{_POINTERS}")), reverse=True)
    return next(filter(None, (_snapshot(spark, path, n) for n in names if n.isdigit())), None)


def write_table(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, keep: timedelta = KEEP
) -> Snapshot:
    """Replace the table at ``path``, with the declared ``columns`` only if given.

    The new version lies in a folder of its own, so a failed job leaves the previous one in
    place and a plan may read the table it replaces. Of two writers at once the later pointer
    wins. Versions replaced longer ago than ``keep`` are removed.
    """
    spark = df.sparkSession
    name = f"{_DATA}{uuid4().hex}"
    (df if columns is None else df.select(*columns)).write.parquet(f"{path}/{name}")
    written = commit_snapshot(spark, path, name)
    expire_snapshots(spark, path, keep)
    return written


def commit_snapshot(spark: SparkSession, path: str, name: str) -> Snapshot:
    """Point readers of ``path`` to the data folder ``name`` below it."""
    files = [f for f in list_files(spark, f"{path}/{name}") if f.name.endswith(".parquet")]
    size = sum(f.size for f in files)
    content = json.dumps({"snapshot": name, "files": len(files), "bytes": size})
    while True:
        taken = [int(f.name) for f in list_files(spark, f"{path}/{_POINTERS}") if f.name.isdigit()]
        number = max(taken, default=0) + 1
        try:
            create_file(spark, f"{path}/{_POINTERS}/{number:0{_DIGITS}d}", _sealed(content))
        except FileTaken:
            # Another writer was faster; the next number is free or taken by a third.
            continue
        return Snapshot(number, f"{path}/{name}", len(files), size)


def expire_snapshots(spark: SparkSession, path: str, keep: timedelta = KEEP) -> None:
    """Remove versions replaced longer ago than ``keep``, and what failed writers left by then.

    A version's time is that of the pointer after it; of a folder without a pointer its own.
    """
    limit = datetime.now(UTC) - keep
    current = current_snapshot(spark, path)
    if current is None:
        return
    held = {current.folder.rsplit("/", 1)[1]}
    pointers = sorted(
        (f for f in list_files(spark, f"{path}/{_POINTERS}") if f.name.isdigit()),
        key=lambda f: f.name,
    )
    for pointer, after in zip(pointers, pointers[1:], strict=False):
        if after.modified >= limit or int(pointer.name) >= current.number:
            found = _opened(read_file(spark, f"{path}/{_POINTERS}/{pointer.name}"))
            held |= {found["snapshot"]} if found else set()
        else:
            delete_path(spark, f"{path}/{_POINTERS}/{pointer.name}")
    for folder in list_files(spark, path):
        old = folder.modified < limit
        if folder.name.startswith(_DATA) and folder.name not in held and old:
            delete_path(spark, f"{path}/{folder.name}")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """The current version of a table, or the one given; a plain Parquet folder as it is."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    chosen = snapshot or current_snapshot(spark, path)
    return reader.parquet(path if chosen is None else chosen.folder)


def window_id(start: datetime, end: datetime) -> str:
    """``<start>_<end>`` to the second, the name of one time window."""
    return f"{start.strftime(_WINDOW_FORMAT)}_{end.strftime(_WINDOW_FORMAT)}"


def write_window(df: DataFrame, path: str, start: datetime, end: datetime) -> None:
    """Replace one time window of a table and leave its other windows alone."""
    write_windows(df.withColumn(WINDOW_COLUMN, F.lit(window_id(start, end))), path)


def write_windows(df: DataFrame, path: str) -> None:
    """Replace every window that occurs in ``df`` (column ``window_id``).

    A row-size aware rebalance by window writes large files per window and splits a
    window that holds most of the rows over several tasks.
    """
    (
        df.hint("rebalance", WINDOW_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(WINDOW_COLUMN)
        .parquet(path)
    )


def read_windows(
    spark: SparkSession, path: str, windows: list[tuple[datetime, datetime]] | None = None
) -> DataFrame:
    """Read all windows, or only the folders of the given ones."""
    # Without the option, a one-window table would have its id read as a number.
    df = spark.read.option("basePath", path).parquet(path)
    df = df.withColumn(WINDOW_COLUMN, F.col(WINDOW_COLUMN).cast("string"))
    if windows is None:
        return df
    return df.where(F.col(WINDOW_COLUMN).isin([window_id(s, e) for s, e in windows]))

