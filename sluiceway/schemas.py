"""Table contracts of every layer: names, column order and types.

``StructType`` objects are the single source for readers, DDL, layer-exit casts
and tests. Technical columns start with ``dwh_``, surrogate keys end in ``_key``.
"""

from __future__ import annotations

from pyspark.sql import types as T

AUDIT_COLUMN = "dwh_create_date"
VARCHAR_LIMIT = 50

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _DATE, _NTZ = T.DoubleType(), T.DateType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


BRONZE: dict[str, T.StructType] = {
    "crm_cust_info": _struct(
        ("cst_id", _INT),
        ("cst_key", _STRING),
        ("cst_firstname", _STRING),
        ("cst_lastname", _STRING),
        ("cst_marital_status", _STRING),
        ("cst_gndr", _STRING),
        ("cst_create_date", _DATE),
    ),
    "crm_prd_info": _struct(
        ("prd_id", _INT),
        ("prd_key", _STRING),
        ("prd_nm", _STRING),
        ("prd_cost", _INT),
        ("prd_line", _STRING),
        ("prd_start_dt", _NTZ),
        ("prd_end_dt", _NTZ),
    ),
    "crm_sales_details": _struct(
        ("sls_ord_num", _STRING),
        ("sls_prd_key", _STRING),
        ("sls_cust_id", _INT),
        ("sls_order_dt", _INT),
        ("sls_ship_dt", _INT),
        ("sls_due_dt", _INT),
        ("sls_sales", _INT),
        ("sls_quantity", _INT),
        ("sls_price", _INT),
    ),
    "erp_cust_az12": _struct(("cid", _STRING), ("bdate", _DATE), ("gen", _STRING)),
    "erp_loc_a101": _struct(("cid", _STRING), ("cntry", _STRING)),
    "erp_px_cat_g1v2": _struct(
        ("id", _STRING),
        ("cat", _STRING),
        ("subcat", _STRING),
        ("maintenance", _STRING),
    ),
}

# File name of each source extract below the ingest root.
SOURCE_FILES: dict[str, str] = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}

# Business columns only; the audit stamp is appended by ``stamp``.
SILVER: dict[str, T.StructType] = {
    "crm_cust_info": _struct(
        ("cst_id", _LONG),
        ("cst_key", _STRING),
        ("cst_firstname", _STRING),
        ("cst_lastname", _STRING),
        ("cst_marital_status", _STRING),
        ("cst_gndr", _STRING),
        ("cst_create_date", _DATE),
    ),
    "crm_prd_info": _struct(
        ("prd_id", _LONG),
        ("cat_id", _STRING),
        ("prd_key", _STRING),
        ("prd_nm", _STRING),
        ("prd_cost", _LONG),
        ("prd_line", _STRING),
        ("prd_start_dt", _DATE),
        ("prd_end_dt", _DATE),
    ),
    "crm_sales_details": _struct(
        ("sls_ord_num", _STRING),
        ("sls_prd_key", _STRING),
        ("sls_cust_id", _LONG),
        ("sls_order_dt", _DATE),
        ("sls_ship_dt", _DATE),
        ("sls_due_dt", _DATE),
        ("sls_sales", _LONG),
        ("sls_quantity", _LONG),
        ("sls_price", _LONG),
    ),
    "erp_cust_az12": BRONZE["erp_cust_az12"],
    "erp_loc_a101": BRONZE["erp_loc_a101"],
    "erp_px_cat_g1v2": BRONZE["erp_px_cat_g1v2"],
}

GOLD: dict[str, T.StructType] = {
    "dim_customer": _struct(
        ("customer_key", _LONG),
        ("customer_id", _LONG),
        ("customer_number", _STRING),
        ("first_name", _STRING),
        ("last_name", _STRING),
        ("country", _STRING),
        ("marital_status", _STRING),
        ("gender", _STRING),
        ("birthday", _DATE),
        ("create_date", _DATE),
    ),
    "dim_product": _struct(
        ("product_key", _LONG),
        ("product_id", _LONG),
        ("product_number", _STRING),
        ("product_name", _STRING),
        ("category_id", _STRING),
        ("category", _STRING),
        ("subcategory", _STRING),
        ("maintenance", _STRING),
        ("cost", _DOUBLE),
        ("product_line", _STRING),
        ("start_date", _DATE),
    ),
    "fact_sales": _struct(
        ("order_number", _STRING),
        ("product_key", _LONG),
        ("customer_key", _LONG),
        ("order_date", _DATE),
        ("ship_date", _DATE),
        ("due_date", _DATE),
        ("sales_amount", _DOUBLE),
        ("quantity", _LONG),
        ("price", _DOUBLE),
    ),
}


def _retyped(base: T.StructType, **changes: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, changes.get(f.name, f.dataType), True) for f in base]
    )


# The warehouse stores the business ids of both dimensions as text.
WAREHOUSE: dict[str, T.StructType] = {
    "dim_customer": _retyped(GOLD["dim_customer"], customer_id=_STRING),
    "dim_product": _retyped(GOLD["dim_product"], product_id=_STRING),
    "fact_sales": GOLD["fact_sales"],
}

# The presentation views narrow two columns to INT; text is cut to VARCHAR(50).
VIEWS: dict[str, T.StructType] = {
    "dim_customer": WAREHOUSE["dim_customer"],
    "dim_product": _retyped(GOLD["dim_product"], product_id=_INT),
    "fact_sales": _retyped(GOLD["fact_sales"], quantity=_INT),
}


def sql_columns(schema: T.StructType, text_type: str = f"VARCHAR({VARCHAR_LIMIT})") -> str:
    """``name TYPE`` list for DDL, with text columns declared as ``text_type``."""
    return ", ".join(
        f"{f.name} {text_type if f.dataType == _STRING else f.dataType.simpleString().upper()}"
        for f in schema
    )
