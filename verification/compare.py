"""Run queries against their SQL statement and report differences.

    python -m verification.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators import release_scratch
from verification.catalogue import QUERIES
from verification.oracle import statements

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(con: duckdb.DuckDBPyConnection, name: str, df: DataFrame) -> str:
    """Empty when columns, types and the multiset of rows agree with the query's SQL."""
    columns = sorted(df.columns)
    mine = {c: TYPE_NAMES[t] for c, t in df.dtypes}
    expected = con.sql(statements()[name])
    theirs = {c: str(t) for c, t in zip(expected.columns, expected.types)}
    if mine != theirs:
        return f"schema {mine} expected {theirs}"
    got = Counter(tuple(r) for r in df.select(columns).collect())
    want = Counter(expected.select(*columns).fetchall())
    if got == want:
        return ""
    return (
        f"{(got - want).total()} unexpected rows, e.g. {list(got - want)[:3]}; "
        f"{(want - got).total()} missing rows, e.g. {list(want - got)[:3]}"
    )


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Run one query of the catalogue and compare it."""
    return compare(con, name, QUERIES[name](spark, sf_dir))


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        begin = time.perf_counter()
        found = differences(spark, con, name, sf_dir)
        failed += bool(found)
        print(f"{name:28s} {time.perf_counter() - begin:6.2f}s {found or 'ok'}", flush=True)
    release_scratch(spark)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
