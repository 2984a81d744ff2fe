"""Relational sources and sinks through Spark's JDBC data source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from sluiceway.schemas import sql_columns

# Fixed values of the warehouse loader.
INSERT_BATCH = 10_000
MAX_CONNECTIONS = 15


@dataclass(frozen=True)
class Database:
    """Where a database is and how to log in."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        named = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {k: v for k, v in named.items() if v is not None} | dict(self.extra)


@dataclass(frozen=True)
class Slices:
    """Split a table read into ``count`` range queries on a numeric or date column.

    The bounds only place the cuts; rows outside them and nulls are read as well.
    """

    column: str
    lower: str | int
    upper: str | int
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def histogram_query(table: str, column: str, count: int) -> str:
    """SQL for the smallest value of each of ``count`` buckets of equally many rows.

    The database sorts and counts; ``count`` short rows come back, whatever the table's size.
    """
    return (
        f"SELECT bucket, MIN({column}) AS low, COUNT(*) AS n FROM "
        f"(SELECT {column}, NTILE({count}) OVER (ORDER BY {column}) AS bucket "
        f"FROM {table} WHERE {column} IS NOT NULL) counted GROUP BY bucket"
    )


def literal(value: object) -> str:
    """A value of a histogram as SQL."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def depth_predicates(column: str, lows: Sequence[object]) -> list[str]:
    """Conditions that cut a table at the buckets' smallest values; every row meets one.

    Equal values begin several buckets where one value fills them; such buckets are one slice,
    as no condition on the column can part them. Nulls and values below the first, written
    after the histogram was taken, are in the first slice.
    """
    cuts = [literal(low) for low in sorted(set(lows))[1:]]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


@dataclass(frozen=True)
class DepthSlices:
    """Split a table read into about ``count`` queries of equally many rows on any column.

    Unlike ``Slices`` it needs no bounds and gives even reads for a skewed column.
    """

    column: str
    count: int


def query_options(db: Database, query: str) -> dict[str, str]:
    return db.options() | {"query": query, "fetchsize": str(INSERT_BATCH)}


def table_options(db: Database, table: str, slices: Slices | None = None) -> dict[str, str]:
    options = db.options() | {"dbtable": table, "fetchsize": str(INSERT_BATCH)}
    return options | (slices.options() if slices else {})


def refresh_options(db: Database, table: str) -> dict[str, str]:
    """Empty the table, keep its definition, append in batches over few connections."""
    return db.options() | {
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(INSERT_BATCH),
        "numPartitions": str(MAX_CONNECTIONS),
    }


def replace_options(db: Database, table: str, df: DataFrame) -> dict[str, str]:
    """Drop and recreate the table, text columns as VARCHAR(50)."""
    text = [f for f in df.schema if f.dataType.typeName() == "string"]
    types = {"createTableColumnTypes": sql_columns(type(df.schema)(text))} if text else {}
    return db.options() | types | {
        "dbtable": table,
        "truncate": "false",
        "batchsize": str(INSERT_BATCH),
        "numPartitions": str(MAX_CONNECTIONS),
    }


def read_query(spark: SparkSession, db: Database, query: str) -> DataFrame:
    """Result of one SQL query, read over one connection."""
    return spark.read.format("jdbc").options(**query_options(db, query)).load()


def read_table(
    spark: SparkSession, db: Database, table: str, slices: Slices | DepthSlices | None = None
) -> DataFrame:
    """A whole table. With ``slices`` the executors read it in parallel, and column
    selections and filters are pushed to the database either way."""
    if isinstance(slices, DepthSlices):
        query = histogram_query(table, slices.column, slices.count)
        lows = [row["low"] for row in read_query(spark, db, query).collect()]
        named = {k: v for k, v in table_options(db, table).items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(
            db.url, table, predicates=depth_predicates(slices.column, lows), properties=named
        )
    return spark.read.format("jdbc").options(**table_options(db, table, slices)).load()


def refresh_table(df: DataFrame, db: Database, table: str) -> None:
    """Full refresh that keeps the table definition.

    Emptying and appending are separate transactions in the database: a job that
    fails between them leaves the table short, and is put right by running it again.
    """
    df.write.format("jdbc").mode("overwrite").options(**refresh_options(db, table)).save()


def replace_table(df: DataFrame, db: Database, table: str, columns: Sequence[str]) -> None:
    """Replace the table with the declared columns of ``df`` only."""
    declared = df.select(*columns)
    declared.write.format("jdbc").mode("overwrite").options(
        **replace_options(db, table, declared)
    ).save()
