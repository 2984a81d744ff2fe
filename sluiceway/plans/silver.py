"""Bronze to silver: one cleaner per source table.

Each takes the raw frame and returns the cleaned one plus the audit stamp. Three of
the six are a single projection; only deduplication and version ranges shuffle.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import (
    code_label,
    digits_to_date,
    enforce,
    lenient_date,
    lenient_timestamp,
    not_in_future,
    repaired_price,
    repaired_sales,
    stamp,
    strip,
    without_prefix,
)
from sluiceway.operators import keep_latest, next_in_key
from sluiceway.schemas import SILVER

# The code lists of the source systems and the labels they stand for.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
ERP_GENDER = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States", "": "n/a"}
CUSTOMER_PREFIX = "NAS"
CATEGORY_LENGTH = 5


def clean_customers(
    crm_cust_info: DataFrame,
    batch_ts: datetime | None = None,
    mode: Literal["row", "coalesce"] = "row",
) -> DataFrame:
    """Newest record of every customer, names trimmed, codes spelled out."""
    identified = crm_cust_info.withColumns(
        {
            "cst_id": F.col("cst_id").try_cast("bigint"),
            "cst_create_date": lenient_date(F.col("cst_create_date")),
        }
    ).where(F.col("cst_id").isNotNull() & (F.col("cst_id") != 0))
    latest = keep_latest(identified, "cst_id", "cst_create_date", mode)
    cleaned = latest.withColumns(
        {
            "cst_firstname": strip(F.col("cst_firstname")),
            "cst_lastname": strip(F.col("cst_lastname")),
            "cst_marital_status": code_label(
                F.upper(strip(F.col("cst_marital_status"))), MARITAL_STATUS
            ),
            "cst_gndr": code_label(F.upper(strip(F.col("cst_gndr"))), CRM_GENDER),
        }
    )
    return stamp(enforce(cleaned, SILVER["crm_cust_info"]), batch_ts)


def clean_products(
    crm_prd_info: DataFrame,
    batch_ts: datetime | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Split the category from the product key and date the versions of each product.

    A version ends the day before the next one starts. The stored end date is not
    used. Equal start dates are ordered by ``prd_id``.
    """
    full_key = strip(F.col("prd_key"))
    named = crm_prd_info.select(
        F.col("prd_id").cast("bigint").alias("prd_id"),
        F.replace(full_key.substr(1, CATEGORY_LENGTH), F.lit("-"), F.lit("_")).alias("cat_id"),
        full_key.substr(F.lit(CATEGORY_LENGTH + 2), F.length(full_key)).alias("prd_key"),
        F.col("prd_nm"),
        F.coalesce(F.col("prd_cost").try_cast("bigint"), F.lit(0)).alias("prd_cost"),
        code_label(F.upper(strip(F.col("prd_line"))), PRODUCT_LINE).alias("prd_line"),
        lenient_timestamp(F.col("prd_start_dt")).alias("prd_start_dt"),
    )
    dated = next_in_key(
        named,
        key="prd_key",
        order_by=["prd_start_dt", "prd_id"],
        value="prd_start_dt",
        out="_next_start",
        partitions=partitions,
    ).withColumn("prd_end_dt", F.date_sub(F.col("_next_start").cast("date"), 1))
    return stamp(enforce(dated, SILVER["crm_prd_info"]), batch_ts)


def clean_sales(crm_sales_details: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """Decode the date numbers and repair amount and price. No shuffle."""
    # BIGINT before the arithmetic: INT products overflow, and ANSI mode raises.
    quantity, price = (F.col(c).try_cast("bigint") for c in ("sls_quantity", "sls_price"))
    sales = repaired_sales(F.col("sls_sales").try_cast("bigint"), quantity, price)
    cleaned = crm_sales_details.select(
        F.col("sls_ord_num"),
        F.col("sls_prd_key"),
        F.col("sls_cust_id").try_cast("bigint").alias("sls_cust_id"),
        *[
            digits_to_date(F.col(c)).alias(c)
            for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
        ],
        sales.alias("sls_sales"),
        quantity.alias("sls_quantity"),
        repaired_price(sales, quantity, price).alias("sls_price"),
    )
    return stamp(enforce(cleaned, SILVER["crm_sales_details"]), batch_ts)


def clean_demographics(
    erp_cust_az12: DataFrame,
    batch_ts: datetime | None = None,
    as_of: date | datetime | None = None,
) -> DataFrame:
    """Plain customer numbers, birth dates up to ``as_of``, gender spelled out."""
    cleaned = erp_cust_az12.select(
        without_prefix(F.col("cid"), CUSTOMER_PREFIX).alias("cid"),
        not_in_future(lenient_date(F.col("bdate")), as_of).alias("bdate"),
        code_label(F.upper(strip(F.col("gen"))), ERP_GENDER).alias("gen"),
    )
    return stamp(enforce(cleaned, SILVER["erp_cust_az12"]), batch_ts)


def clean_locations(erp_loc_a101: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """Customer numbers without dashes, country names, distinct rows.

    The country codes are case-sensitive; an unknown value stays as it is.
    """
    country = strip(F.col("cntry"))
    cleaned = erp_loc_a101.select(
        F.replace(strip(F.col("cid")), F.lit("-"), F.lit("")).alias("cid"),
        code_label(country, COUNTRY, default=F.coalesce(country, F.lit("n/a"))).alias("cntry"),
    ).dropDuplicates()
    return stamp(enforce(cleaned, SILVER["erp_loc_a101"]), batch_ts)


def clean_categories(erp_px_cat_g1v2: DataFrame, batch_ts: datetime | None = None) -> DataFrame:
    """Trim the three descriptive columns."""
    cleaned = erp_px_cat_g1v2.select(
        F.col("id"), *[strip(F.col(c)).alias(c) for c in ("cat", "subcat", "maintenance")]
    )
    return stamp(enforce(cleaned, SILVER["erp_px_cat_g1v2"]), batch_ts)
