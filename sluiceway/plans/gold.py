"""Silver to gold: two dimensions with surrogate keys and the sales fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import enforce, fallback_label, stamp
from sluiceway.operators import dense_key, left_join
from sluiceway.operators.skew import HEAVY_ROWS
from sluiceway.schemas import GOLD

# Source column -> business name, in the order of the gold tables.
CUSTOMER_NAMES = {
    "cst_id": "customer_id",
    "cst_key": "customer_number",
    "cst_firstname": "first_name",
    "cst_lastname": "last_name",
    "cntry": "country",
    "cst_marital_status": "marital_status",
    "cst_gndr": "gender",
    "bdate": "birthday",
    "cst_create_date": "create_date",
}
PRODUCT_NAMES = {
    "prd_id": "product_id",
    "prd_key": "product_number",
    "prd_nm": "product_name",
    "cat_id": "category_id",
    "cat": "category",
    "subcat": "subcategory",
    "maintenance": "maintenance",
    "prd_cost": "cost",
    "prd_line": "product_line",
    "prd_start_dt": "start_date",
}
SALES_NAMES = {
    "sls_ord_num": "order_number",
    "product_key": "product_key",
    "customer_key": "customer_key",
    "sls_order_dt": "order_date",
    "sls_ship_dt": "ship_date",
    "sls_due_dt": "due_date",
    "sls_sales": "sales_amount",
    "sls_quantity": "quantity",
    "sls_price": "price",
}


def renamed(df: DataFrame, names: dict[str, str], *leading: str) -> DataFrame:
    """Select the ``leading`` columns, then the mapped ones under their business names."""
    return df.select(*leading, *[F.col(old).alias(new) for old, new in names.items()])


def integrate_customers(
    customers: DataFrame,
    demographics: DataFrame,
    locations: DataFrame,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Customers with the matching demographics and locations; CRM gender comes first."""
    demographic = demographics.select(F.col("cid").alias("_demo_cid"), "bdate", "gen")
    location = locations.select(F.col("cid").alias("_loc_cid"), "cntry")
    joined = left_join(customers, demographic, "cst_key", "_demo_cid", heavy_rows)
    joined = left_join(joined, location, "cst_key", "_loc_cid", heavy_rows)
    return joined.withColumn("cst_gndr", fallback_label(F.col("cst_gndr"), F.col("gen")))


def current_products(
    products: DataFrame, categories: DataFrame, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Product versions still open, with the category they belong to."""
    category = categories.select(
        F.col("id").alias("_category_id"), "cat", "subcat", "maintenance"
    )
    current = products.where(F.col("prd_end_dt").isNull())
    return left_join(current, category, "cat_id", "_category_id", heavy_rows)


def link_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Sales with the surrogate keys of their product and customer.

    The dimensions are cut to a business id and a key first, so what is broadcast or
    shuffled on their side is two narrow columns. A missing partner leaves a null key.
    """
    product = products.select("product_key", F.col("product_number").cast("string"))
    customer = customers.select("customer_key", F.col("customer_id").cast("bigint"))
    joined = left_join(sales, product, "sls_prd_key", "product_number", heavy_rows)
    joined = left_join(joined, customer, "sls_cust_id", "customer_id", heavy_rows)
    return renamed(joined, SALES_NAMES)


def build_dim_customer(
    customers: DataFrame,
    demographics: DataFrame,
    locations: DataFrame,
    batch_ts: datetime | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Customer dimension; the key is the zero-based dense rank of the customer id.

    The rank is taken before the joins: a left join keeps every id, and the joins can
    only repeat rows. Copies among the demographics are dropped before they meet the
    customers, as they could only produce copies, which the final distinct removes.
    """
    keyed = dense_key(
        customers, ["cst_id"], "customer_key", null_safe=False, label="customer_key"
    )
    merged = integrate_customers(
        keyed,
        demographics.select("cid", "bdate", "gen").dropDuplicates(),
        locations,
        heavy_rows,
    )
    distinct = renamed(merged, CUSTOMER_NAMES, "customer_key").dropDuplicates()
    return stamp(enforce(distinct, GOLD["dim_customer"]), batch_ts)


def build_dim_product(
    products: DataFrame,
    categories: DataFrame,
    batch_ts: datetime | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Current products; the key is the zero-based dense rank of (start date, key)."""
    current = products.where(F.col("prd_end_dt").isNull())
    keyed = dense_key(current, ["prd_start_dt", "prd_key"], "product_key", label="product_key")
    merged = current_products(keyed, categories, heavy_rows)
    result = renamed(merged, PRODUCT_NAMES, "product_key")
    return stamp(enforce(result, GOLD["dim_product"]), batch_ts)


def build_fact_sales(
    sales: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    batch_ts: datetime | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Sales fact: one row per sale as long as the dimensions' business ids are unique."""
    linked = link_sales(sales, dim_product, dim_customer, heavy_rows)
    return stamp(enforce(linked, GOLD["fact_sales"]), batch_ts)
