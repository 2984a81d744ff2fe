"""Gold to warehouse: final types, dates cut to the day, no technical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluiceway.functions import enforce
from sluiceway.schemas import AUDIT_COLUMN, WAREHOUSE


def warehouse_dim_customer(dim_customer: DataFrame) -> DataFrame:
    return enforce(dim_customer.drop(AUDIT_COLUMN), WAREHOUSE["dim_customer"])


def warehouse_dim_product(dim_product: DataFrame) -> DataFrame:
    return enforce(dim_product.drop(AUDIT_COLUMN), WAREHOUSE["dim_product"])


def warehouse_fact_sales(fact_sales: DataFrame) -> DataFrame:
    return enforce(fact_sales.drop(AUDIT_COLUMN), WAREHOUSE["fact_sales"])


LOADS = {
    "dim_customer": warehouse_dim_customer,
    "dim_product": warehouse_dim_product,
    "fact_sales": warehouse_fact_sales,
}
