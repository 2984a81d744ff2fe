"""Every query by name: (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import configure
from sluiceway.operators import stage
from sluiceway.operators.staging import scratch_dir
from sluiceway.plans import gold, pipeline, quality, silver, views, warehouse
from sluiceway.plans.concurrent import together
from sluiceway.plans.metrics import table_metrics
from sluiceway.schemas import AUDIT_COLUMN, BRONZE, WAREHOUSE
from sluiceway.sources.bronze import FileSource
from sluiceway.sources.catalog import create_tables, refresh_catalog_table
from sluiceway.sources.files import CSV_OPTIONS, read_delimited, source_path
from sluiceway.sources.lake import (
    lake_path,
    read_table,
    read_windows,
    write_table,
    write_window,
    write_windows,
)
from verification.oracle import AS_OF
from verification.source_shapes import SHAPES

Query = Callable[[SparkSession, str], DataFrame]

# Fixed clock, so that no result depends on the time of the run.
BATCH_TS = datetime(2026, 1, 1)

_CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "crm_cust_info": lambda df: silver.clean_customers(df, BATCH_TS),
    "crm_prd_info": lambda df: silver.clean_products(df, BATCH_TS),
    "crm_sales_details": lambda df: silver.clean_sales(df, BATCH_TS),
    "erp_cust_az12": lambda df: silver.clean_demographics(
        df, BATCH_TS, as_of=datetime.fromisoformat(AS_OF)
    ),
    "erp_loc_a101": lambda df: silver.clean_locations(df, BATCH_TS),
    "erp_px_cat_g1v2": lambda df: silver.clean_categories(df, BATCH_TS),
}


def _bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return SHAPES[table](configure(spark), sf_dir)


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _CLEANERS[table](_bronze(spark, sf_dir, table))


def _silver_query(table: str) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, table).drop(AUDIT_COLUMN)


def _coalesced_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _bronze(spark, sf_dir, "crm_cust_info")
    return silver.clean_customers(raw, BATCH_TS, mode="coalesce").drop(AUDIT_COLUMN)


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_dim_customer(
        _silver(spark, sf_dir, "crm_cust_info"),
        _silver(spark, sf_dir, "erp_cust_az12"),
        _silver(spark, sf_dir, "erp_loc_a101"),
        BATCH_TS,
    )


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_dim_product(
        _silver(spark, sf_dir, "crm_prd_info"),
        _silver(spark, sf_dir, "erp_px_cat_g1v2"),
        BATCH_TS,
    )


def _fact_sales(
    spark: SparkSession, sf_dir: str, products: DataFrame, customers: DataFrame
) -> DataFrame:
    sales = _silver(spark, sf_dir, "crm_sales_details")
    return gold.build_fact_sales(sales, products, customers, BATCH_TS)


def _gold_tables(spark: SparkSession, sf_dir: str, fact: bool = True) -> dict[str, DataFrame]:
    """The star schema, dimensions written once as in a gold load; the fact only if wanted."""
    customers, products = together(
        spark,
        [
            lambda: stage(_dim_customer(spark, sf_dir), "dim_customer"),
            lambda: stage(_dim_product(spark, sf_dir), "dim_product"),
        ],
    )
    tables = {"dim_customer": customers, "dim_product": products}
    if fact:
        tables["fact_sales"] = _fact_sales(spark, sf_dir, products, customers)
    return tables


_DIMENSIONS = {"dim_customer": _dim_customer, "dim_product": _dim_product}


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table in _DIMENSIONS:
        return _DIMENSIONS[table](spark, sf_dir)
    return _gold_tables(spark, sf_dir)[table]


def _gold_query(table: str) -> Query:
    return lambda spark, sf_dir: _gold(spark, sf_dir, table).drop(AUDIT_COLUMN)


def _warehouse_query(table: str) -> Query:
    return lambda spark, sf_dir: warehouse.LOADS[table](_gold(spark, sf_dir, table))


def _typed_query(table: str) -> Query:
    return lambda spark, sf_dir: views.typed_view(
        table, warehouse.LOADS[table](_gold(spark, sf_dir, table))
    )


def _view_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sql_dim_customers(
        _silver(spark, sf_dir, "crm_cust_info"),
        _silver(spark, sf_dir, "erp_cust_az12"),
        _silver(spark, sf_dir, "erp_loc_a101"),
    )


def _view_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sql_dim_products(
        _silver(spark, sf_dir, "crm_prd_info"), _silver(spark, sf_dir, "erp_px_cat_g1v2")
    )


def _view_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the registered views, the way a reader of the gold schema gets it."""
    views.register_gold_views({t: _silver(spark, sf_dir, t) for t in SHAPES})
    return spark.table("gold_fact_sales")


def _typed_tables(spark: SparkSession, sf_dir: str, fact: bool = True) -> dict[str, DataFrame]:
    return {
        table: views.typed_view(table, warehouse.LOADS[table](df))
        for table, df in _gold_tables(spark, sf_dir, fact).items()
    }


def _checks_of(kind: type[quality.Check]) -> Query:
    chosen = {
        table: [c for c in declared if isinstance(c, kind)]
        for table, declared in quality.CHECKS.items()
    }
    fact = bool(chosen["fact_sales"])
    return lambda spark, sf_dir: quality.quality_report(
        _typed_tables(spark, sf_dir, fact), chosen
    ).drop("passed")


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_typed_tables(spark, sf_dir))


def _new_lake(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/lake-{uuid4().hex}"


def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products written as a delimited file, then ingested by position."""
    path = f"{_new_lake(spark)}/prd_info.csv"
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    export = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"} | keep_blanks
    _bronze(spark, sf_dir, "crm_prd_info").write.options(**export).csv(path)
    return read_delimited(spark, path, BRONZE["crm_prd_info"])


def _lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver sales written twice to one lake path: the second write replaces the first."""
    path = lake_path(_new_lake(spark), "shop", "silver", "shop_sales")
    write_table(_silver(spark, sf_dir, "crm_sales_details"), path)
    write_table(read_table(spark, path).drop(AUDIT_COLUMN), path)
    return read_table(spark, path)


def _lake_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in yearly windows; one window is then written again."""
    path = lake_path(_new_lake(spark), "shop", "silver", "sales_by_year")
    sales = _silver(spark, sf_dir, "crm_sales_details").select(
        "sls_ord_num", "sls_sales", "sls_ship_dt"
    )
    year = F.year("sls_ship_dt")
    yearly = F.concat(
        year.cast("string"), F.lit("0101000000_"), (year + 1).cast("string"), F.lit("0101000000")
    )
    write_windows(sales.withColumn("window_id", yearly), path)
    turned = sales.where(year == 1998).withColumn("sls_sales", -F.col("sls_sales"))
    write_window(turned, path, datetime(1998, 1, 1), datetime(1999, 1, 1))
    return read_windows(spark, path)


def _warehouse_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension replaced with three declared columns."""
    path = lake_path(_new_lake(spark), "shop", "warehouse", "dim_customer")
    loaded = warehouse.warehouse_dim_customer(_dim_customer(spark, sf_dir))
    write_table(loaded, path, ["customer_key", "customer_id", "country"])
    return read_table(spark, path)


def _warehouse_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension loaded twice into a table created from its contract."""
    location = _new_lake(spark)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    create_tables(spark, database, {"dim_product": WAREHOUSE["dim_product"]}, location)
    loaded = warehouse.warehouse_dim_product(stage(_dim_product(spark, sf_dir), "dim_product"))
    for _ in range(2):
        refresh_catalog_table(loaded, database, "dim_product")
    return spark.table(f"{database}.dim_product")


_METRIC_NAMES = {
    "customers": "crm_cust_info",
    "products": "crm_prd_info",
    "sales": "crm_sales_details",
    "demographics": "erp_cust_az12",
    "locations": "erp_loc_a101",
    "categories": "erp_px_cat_g1v2",
}


def _run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_metrics(
        {
            name: _silver(spark, sf_dir, table).drop(AUDIT_COLUMN)
            for name, table in _METRIC_NAMES.items()
        }
    )


def _dtypes(types: str) -> Column:
    """The recorded column types as text; a map has no order, so by name."""
    pair = F.transform(F.map_entries(types), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return F.array_join(F.sort_array(pair), ",")


def _run_metrics_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables written to a lake, their figures taken during the write and read back."""
    lake = pipeline.Lake.open(spark, _new_lake(spark), "shop", BATCH_TS)
    lake.record(
        together(
            spark,
            [
                lambda name=name, table=table: lake.write(
                    "silver", name, _silver(spark, sf_dir, table).drop(AUDIT_COLUMN)
                )
                for name, table in _METRIC_NAMES.items()
            ],
        )
    )
    return lake.read("metrics", "run_metrics").select(
        "table_name", "records", _dtypes("column_dtypes").alias("column_dtypes")
    )


def _exported(table: DataFrame, path: str) -> None:
    """A table as a delimited file with every value quoted, as an extract of a shop system."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    export = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"} | keep | {"quoteAll": "true"}
    table.write.options(**export).csv(path)


def _profile(df: DataFrame, table: str) -> DataFrame:
    """Per column the numbers of rows, values and different values, and the extremes as text."""
    figures = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(c).alias("n_values"),
            F.count_distinct(c).alias("n_distinct"),
            F.min(c).cast("string").alias("least"),
            F.max(c).cast("string").alias("greatest"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*figures).alias("figures")).select(F.inline("figures"))


def _bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six extracts as files, landed by the bronze loaders, profiled as landed."""
    lake = pipeline.Lake.open(spark, _new_lake(spark), "shop", BATCH_TS)
    root = _new_lake(spark)
    together(
        spark,
        [
            lambda t=table: _exported(_bronze(spark, sf_dir, t), source_path(root, t))
            for table in BRONZE
        ],
    )
    pipeline.load_bronze(lake, FileSource(root, multi_line=True))
    return reduce(
        DataFrame.unionByName, [_profile(lake.read("bronze", table), table) for table in BRONZE]
    )


# Column of each table that gets a text its type cannot hold, where there is one.
_UNFIT = {
    "crm_cust_info": "cst_id",
    "crm_prd_info": "prd_cost",
    "crm_sales_details": "sls_cust_id",
    "erp_cust_az12": "bdate",
}


def _faulty_lines(df: DataFrame, table: str) -> DataFrame:
    """Lines of a delimited file, some with faults set by the length of the line."""

    def text(name: str) -> Column:
        value = F.regexp_replace(F.col(name).cast("string"), "[\r\t]", "")
        return F.coalesce(value, F.lit("\\N"))

    fine = F.concat_ws(",", *map(text, df.columns))
    unfit = F.concat_ws(
        ",", *[F.lit("n/a") if c == _UNFIT.get(table) else text(c) for c in df.columns]
    )
    fault = F.length(fine) % 16
    return df.select(
        F.when(fault == 3, F.concat(fine, F.lit(",surplus")))
        .when(fault == 5, F.regexp_replace(fine, ",[^,]*$", ""))
        .when(fault == 7, unfit)
        .when(fault == 9, F.concat(fine, F.lit('"')))
        .otherwise(fine)
        .alias("line")
    )


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of all six extracts, with what was landed of each."""
    lake = pipeline.Lake.open(spark, _new_lake(spark), "shop", BATCH_TS)
    root = _new_lake(spark)
    plain = {"header": "true", "quote": "", "sep": "\x01", "escapeQuotes": "false"}
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    together(
        spark,
        [
            lambda t=table: _faulty_lines(_bronze(spark, sf_dir, t), t)
            .write.options(**plain, **blanks)
            .csv(source_path(root, t))
            for table in BRONZE
        ],
    )
    metrics = pipeline.load_bronze(lake, FileSource(root, checked=True))
    landed = {m["table_name"]: m["records"] for m in metrics}
    return reduce(
        DataFrame.unionByName,
        [
            lake.read("bronze", f"{table}{pipeline.REJECTED_SUFFIX}").select(
                F.lit(table).alias("table_name"),
                "reason",
                "record",
                F.lit(landed[table]).cast("bigint").alias("landed"),
            )
            for table in BRONZE
            if f"{table}{pipeline.REJECTED_SUFFIX}" in landed
        ],
    )


def _lake_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three yearly windows, written at the same time, two of them read back by time range."""
    path = lake_path(_new_lake(spark), "shop", "silver", "sales_by_year")
    sales = _silver(spark, sf_dir, "crm_sales_details").select("sls_ord_num", "sls_ship_dt")
    sales = stage(sales, "sales")

    def window(year: int) -> tuple[datetime, datetime]:
        return datetime(year, 1, 1), datetime(year + 1, 1, 1)

    together(
        spark,
        [
            lambda y=y: write_window(sales.where(F.year("sls_ship_dt") == y), path, *window(y))
            for y in (1995, 1996, 1997)
        ],
    )
    return read_windows(spark, path, [window(1995), window(1997)])


def _audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped rows of every silver and gold table."""
    tables = {table: _silver(spark, sf_dir, table) for table in _CLEANERS}
    tables |= _gold_tables(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [
            df.groupBy(F.date_format(AUDIT_COLUMN, "yyyy-MM-dd HH:mm:ss").alias("stamp"))
            .agg(F.count(F.lit(1)).alias("records"))
            .select(F.lit(table).alias("table_name"), "stamp", "records")
            for table, df in tables.items()
        ],
    )


def _catalog_view_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold schema's fact view as another session of the application reads it."""
    location = _new_lake(spark)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    tables = {t: _silver(spark, sf_dir, t) for t in SHAPES}
    views.create_catalog_views(tables, database, location)
    return spark.newSession().table(f"{database}.fact_sales")


QUERIES: dict[str, Query] = {
    "silver_customers": _silver_query("crm_cust_info"),
    "silver_customers_coalesced": _coalesced_customers,
    "silver_products": _silver_query("crm_prd_info"),
    "silver_sales": _silver_query("crm_sales_details"),
    "silver_demographics": _silver_query("erp_cust_az12"),
    "silver_locations": _silver_query("erp_loc_a101"),
    "silver_categories": _silver_query("erp_px_cat_g1v2"),
    "dim_customer": _gold_query("dim_customer"),
    "dim_product": _gold_query("dim_product"),
    "fact_sales": _gold_query("fact_sales"),
    "view_dim_customers": _view_dim_customers,
    "view_dim_products": _view_dim_products,
    "view_fact_sales": _view_fact_sales,
    "wh_dim_customer": _warehouse_query("dim_customer"),
    "wh_dim_product": _warehouse_query("dim_product"),
    "wh_fact_sales": _warehouse_query("fact_sales"),
    "typed_dim_customer": _typed_query("dim_customer"),
    "typed_dim_product": _typed_query("dim_product"),
    "typed_fact_sales": _typed_query("fact_sales"),
    "dq_not_null": _checks_of(quality.NotNull),
    "dq_unique": _checks_of(quality.Unique),
    "dq_relationships": _checks_of(quality.Relationship),
    "dq_report": _dq_report,
    "csv_ingest": _csv_ingest,
    "lake_roundtrip": _lake_roundtrip,
    "lake_partition_overwrite": _lake_partition_overwrite,
    "warehouse_replace": _warehouse_replace,
    "warehouse_refresh": _warehouse_refresh,
    "run_metrics": _run_metrics,
    "run_metrics_observed": _run_metrics_observed,
    "bronze_ingest": _bronze_ingest,
    "csv_rejects": _csv_rejects,
    "lake_window_read": _lake_window_read,
    "audit_stamp": _audit_stamp,
    "catalog_view_fact_sales": _catalog_view_fact_sales,
}
