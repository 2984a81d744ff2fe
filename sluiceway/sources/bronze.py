"""One loader per source table, over files or a relational database."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions import enforce
from sluiceway.schemas import BRONZE
from sluiceway.sources import files, jdbc

TABLES = tuple(BRONZE)


@dataclass(frozen=True)
class FileSource:
    """Source extracts as delimited files below ``root``.

    ``multi_line`` is for files with line ends in quoted values. ``checked`` sets records that
    do not fit the contract aside, instead of keeping what can be read of them.
    """

    root: str
    multi_line: bool = False
    checked: bool = False

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return files.read_source_file(spark, self.root, table, self.multi_line)

    def read_checked(self, spark: SparkSession, table: str) -> files.Checked:
        path = files.source_path(self.root, table)
        return files.read_checked(spark, path, BRONZE[table], self.multi_line)


@dataclass(frozen=True)
class DatabaseSource:
    """Source tables in a relational database, read whole.

    ``slices`` names the tables to be read in parallel and how to cut them.
    """

    database: jdbc.Database
    slices: Mapping[str, jdbc.Slices | jdbc.DepthSlices] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table in self.slices:
            return jdbc.read_table(spark, self.database, table, self.slices[table])
        return jdbc.read_query(spark, self.database, f"SELECT * FROM {table}")


Source = FileSource | DatabaseSource


def declared(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the contract of ``table``; an error names columns that came or went.

    A renamed or dropped source column would otherwise be found layers later, as nulls.
    """
    expected, got = BRONZE[table].names, df.columns
    missing = [c for c in expected if c not in got]
    surplus = [c for c in got if c not in expected]
    if missing or surplus:
        raise ValueError(f"{table}: missing columns {missing}, unknown columns {surplus}")
    return enforce(df, BRONZE[table])


def bronze_loader(table: str) -> Callable[[SparkSession, Source], DataFrame]:
    """The loader of one source table; its result has the bronze contract."""
    if table not in BRONZE:
        raise KeyError(f"unknown source table {table!r}")

    def load(spark: SparkSession, source: Source) -> DataFrame:
        return declared(source.read(spark, table), table)

    return load


LOADERS = {table: bronze_loader(table) for table in TABLES}
