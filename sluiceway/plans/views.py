"""Views: typed presentation of the warehouse, and the SQL definition of gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import clip_text
from sluiceway.operators import Scratch, fits_broadcast, row_key
from sluiceway.operators.skew import HEAVY_ROWS
from sluiceway.plans.concurrent import together
from sluiceway.plans.gold import (
    CUSTOMER_NAMES,
    PRODUCT_NAMES,
    current_products,
    integrate_customers,
    link_sales,
    renamed,
)
from sluiceway.schemas import VIEWS
from sluiceway.sources.catalog import create_database, create_table, refresh_catalog_table


def typed_view(table: str, df: DataFrame) -> DataFrame:
    """Every column cast to its declared view type; text is cut to 50 characters."""
    return df.select(
        [
            (
                clip_text(F.col(f.name))
                if f.dataType.typeName() == "string"
                else F.col(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in VIEWS[table]
        ]
    )


def register_typed_views(warehouse: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Create or replace one temporary view per warehouse table."""
    views = {table: typed_view(table, df) for table, df in warehouse.items()}
    for table, view in views.items():
        view.createOrReplaceTempView(table)
    return views


def sql_dim_customers(
    customers: DataFrame,
    demographics: DataFrame,
    locations: DataFrame,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """SQL variant of the customer dimension: one-based row number, copies kept."""
    merged = integrate_customers(customers, demographics, locations, heavy_rows)
    return row_key(
        renamed(merged, CUSTOMER_NAMES),
        ["customer_id"],
        "customer_key",
        label="sql_customers",
    )


def sql_dim_products(
    products: DataFrame, categories: DataFrame, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """SQL variant of the product dimension: one-based row number by (start, key)."""
    merged = current_products(products, categories, heavy_rows)
    return row_key(
        renamed(merged, PRODUCT_NAMES),
        ["start_date", "product_number"],
        "product_key",
        label="sql_products",
    )


def sql_fact_sales(
    sales: DataFrame,
    dim_products: DataFrame,
    dim_customers: DataFrame,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """SQL variant of the sales fact, in the types of the silver table."""
    return link_sales(sales, dim_products, dim_customers, heavy_rows)


def register_gold_views(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Create or replace the three SQL-variant views from the silver tables.

    The row numbers of both dimensions are fixed, and staged, at this moment, in the caller's
    scope or, outside of any, with the application. No other run removes them.
    """
    customers, products = together(
        silver["crm_cust_info"].sparkSession,
        [
            lambda: sql_dim_customers(
                silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"]
            ),
            lambda: sql_dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"]),
        ],
    )
    views = {
        "dim_customers": customers,
        "dim_products": products,
        "fact_sales": sql_fact_sales(silver["crm_sales_details"], products, customers),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(f"gold_{name}")
    return views


#: Key tables behind the catalog views, beside the sales they are looked up for.
KEY_TABLES = ("customers_keyed", "products_keyed", "sales_cleaned")

_CATALOG_VIEWS = {
    "dim_customers": "SELECT * FROM `{database}`.customers_keyed",
    "dim_products": "SELECT * FROM `{database}`.products_keyed",
    "fact_sales": """
        SELECT {hint}s.sls_ord_num AS order_number, p.product_key, c.customer_key,
               s.sls_order_dt AS order_date, s.sls_ship_dt AS ship_date, s.sls_due_dt AS due_date,
               s.sls_sales AS sales_amount, s.sls_quantity AS quantity, s.sls_price AS price
        FROM `{database}`.sales_cleaned s
        LEFT JOIN `{database}`.products_keyed p ON s.sls_prd_key = p.product_number
        LEFT JOIN `{database}`.customers_keyed c ON s.sls_cust_id = c.customer_id""",
}


# Alias of each key table in the fact view, and the columns that a lookup takes.
_LOOKUPS = {
    "p": ("products_keyed", ("product_number", "product_key")),
    "c": ("customers_keyed", ("customer_id", "customer_key")),
}


def _lookup_hint(spark: SparkSession, database: str) -> str:
    """Hint for the fact view that keeps key tables too large for it from being broadcast.

    The planner goes by the size of compressed files; here the rows are counted, as in ``sized``.
    """
    large = []
    for alias, (table, columns) in _LOOKUPS.items():
        keys = spark.table(f"`{database}`.`{table}`").select(*columns)
        if not fits_broadcast(keys, keys.count()):
            large.append(alias)
    return f"/*+ MERGE({', '.join(large)}) */ " if large else ""


def create_catalog_views(
    silver: Mapping[str, DataFrame], database: str, location: str | None = None
) -> None:
    """Define the three SQL-variant views in the catalog, for every session that shares it.

    The database is created at ``location``, by default in the warehouse folder.

    A row number over the whole table is not a matter for each reader, so both dimensions are
    numbered now and kept as tables; a second run refreshes them in place and the views follow.
    The fact is a join that runs when the view is read. Unlike ``register_gold_views`` nothing
    hangs on this session or on what it staged.
    """
    spark = silver["crm_cust_info"].sparkSession
    create_database(spark, database, location)
    with Scratch(spark, "catalog-views"):
        numbered = together(
            spark,
            [
                lambda: sql_dim_customers(
                    silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"]
                ),
                lambda: sql_dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"]),
            ],
        )
        for table, df in zip(KEY_TABLES, (*numbered, silver["crm_sales_details"]), strict=True):
            if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
                create_table(spark, database, table, df.schema)
            refresh_catalog_table(df, database, table)
    hint = _lookup_hint(spark, database)
    for view, body in _CATALOG_VIEWS.items():
        statement = body.format(database=database, hint=hint)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS {statement}")
