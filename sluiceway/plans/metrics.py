"""Run metrics: table name, record count and column types of every written table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = (
    "table_name string, records bigint, column_dtypes map<string,string>, dwh_run_date timestamp"
)


def dtype_text(df: DataFrame) -> str:
    """``name:type`` list of a frame."""
    return ",".join(f"{name}:{dtype}" for name, dtype in df.dtypes)


def write_measured(df: DataFrame, table: str, write: Callable[[DataFrame], None]) -> dict:
    """Write ``df`` and count its rows in the same pass."""
    counter = Observation(f"records of {table}")
    write(df.observe(counter, F.count(F.lit(1)).alias("records")))
    return {
        "table_name": table,
        "records": counter.get["records"],
        "column_dtypes": dict(df.dtypes),
    }


def append_metrics(
    spark: SparkSession, path: str, metrics: list[dict], batch_ts: datetime
) -> None:
    rows = [
        (m["table_name"], m["records"], m["column_dtypes"], batch_ts) for m in metrics
    ]
    spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def table_metrics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same figures for tables that already exist, as one frame."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(name).alias("table_name"),
                "records",
                F.lit(dtype_text(df)).alias("column_dtypes"),
            )
            for name, df in tables.items()
        ],
    )
