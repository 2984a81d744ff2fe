"""Databases and tables in the Spark catalog."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.schemas import sql_columns
from sluiceway.sources.storage import delete_path, list_files

# Between a table's first folder and the number of a later one.
_GENERATION = "-generation-"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it does not exist, by default in the warehouse folder."""
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_table(spark: SparkSession, database: str, table: str, schema: T.StructType) -> None:
    """Create an empty Parquet table from its contract."""
    columns = sql_columns(schema, "STRING")
    spark.sql(f"CREATE TABLE `{database}`.`{table}` ({columns}) USING PARQUET")


def create_tables(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, T.StructType],
    location: str | None = None,
) -> None:
    """Drop and create empty Parquet tables from their contracts."""
    create_database(spark, database, location)
    for table, schema in tables.items():
        name = f"`{database}`.`{table}`"
        if spark.catalog.tableExists(name):
            folder = _location(spark, name)
            spark.sql(f"DROP TABLE {name}")
            _drop_generations(spark, folder, keep=set())
        create_table(spark, database, table, schema)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def _drop_generations(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Remove the generations of the table that ``folder`` belongs to, but for those to keep."""
    parent, _, stem = folder.partition(_GENERATION)[0].rpartition("/")
    kept = {path.rpartition("/")[2] for path in keep}
    for entry in list_files(spark, parent):
        if entry.name.startswith(f"{stem}{_GENERATION}") and entry.name not in kept:
            delete_path(spark, f"{parent}/{entry.name}")


def refresh_catalog_table(df: DataFrame, database: str, table: str) -> int:
    """Full refresh of an existing table; its definition stays. Returns the number of rows.

    The rows are loaded into a new folder beside the table's first one, counted there again,
    and then the table is pointed to that folder. A load that fails, or that does not hold what
    was sent, leaves the table with its old rows, and no reader ever meets it empty. The folder
    before stays for readers that are still at it; older ones go.
    """
    spark = df.sparkSession
    name = f"`{database}`.`{table}`"
    declared = spark.table(name).schema
    lacking = [c for c in declared.names if c not in df.columns]
    if lacking:
        raise ValueError(f"{database}.{table} needs the columns {lacking}")
    before = _location(spark, name)
    first = before.partition(_GENERATION)[0]
    folder = f"{first}{_GENERATION}{uuid4().hex}"
    sent = Observation(f"rows for {database}.{table}")
    rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])
    rows.observe(sent, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    loaded = spark.read.schema(declared).parquet(folder).count()
    if loaded != sent.get["rows"]:
        delete_path(spark, folder)
        raise ValueError(f"{database}.{table}: {sent.get['rows']} rows sent, {loaded} loaded")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)

    _drop_generations(spark, folder, keep={folder, before})
    return loaded
