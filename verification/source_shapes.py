"""The six source tables, derived by Spark from the driver's clean tables.

The dirt (padding, code variants, broken dates, wrong amounts, repeated rows) comes
from arithmetic on the business keys, so that ``oracle.py`` can state the same
derivation in the other engine's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluiceway.operators import sized

# Schemas already read from the files' footers, by path.
_schemas: dict[str, T.StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order of a customer; the order date is the record's date."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "CAST(o_orderdate AS DATE) AS d"
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers = sized(customers, customers.count())
    return orders.join(customers, orders.c == customers.c_custkey).selectExpr(
        "CAST(CASE WHEN k % 97 = 1 THEN NULL ELSE c END AS INT) AS cst_id",
        "concat('AW', lpad(CAST(c AS STRING), 10, '0')) AS cst_key",
        """CASE WHEN k % 7 = 3 THEN NULL
                ELSE concat(' ', c_name, CASE WHEN k % 3 = 0 THEN '' ELSE '  ' END) END
           AS cst_firstname""",
        "concat(CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END, c_mktsegment, ' ') AS cst_lastname",
        """CASE k % 6 WHEN 0 THEN ' s ' WHEN 1 THEN 'M' WHEN 2 THEN 'S' WHEN 3 THEN 'm'
                WHEN 4 THEN 'X' END AS cst_marital_status""",
        """CASE k % 8 WHEN 0 THEN 'f' WHEN 1 THEN ' M' WHEN 2 THEN 'F ' WHEN 3 THEN 'M'
                WHEN 4 THEN '' WHEN 5 THEN 'U' WHEN 6 THEN 'm' END AS cst_gndr""",
        "CASE WHEN k % 31 = 0 THEN NULL ELSE d END AS cst_create_date",
    )


# Two letters of the type and two of the name, e.g. EC-SM.
_CATEGORY = "concat(upper(substring(p_type, 1, 2)), '-', upper(substring(p_name, 1, 2)))"


def crm_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three consecutive parts are versions of one product; some start on one day."""
    start = "date_add(DATE '2010-01-01', CAST((p_partkey div 2) % 3650 AS INT))"
    return _table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS INT) AS prd_id",
        f"""concat(CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE '' END, {_CATEGORY}, '-R-',
                   lpad(CAST(p_partkey div 3 AS STRING), 10, '0')) AS prd_key""",
        "p_name AS prd_nm",
        "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) END"
        " AS prd_cost",
        """CASE p_size % 6 WHEN 0 THEN 'R ' WHEN 1 THEN 'm' WHEN 2 THEN 'S' WHEN 3 THEN 'T'
                WHEN 4 THEN '' END AS prd_line""",
        f"CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST({start} AS TIMESTAMP_NTZ) END"
        " AS prd_start_dt",
        f"CAST(date_sub({start}, 10) AS TIMESTAMP_NTZ) AS prd_end_dt",
    )


def crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order line, with broken dates, amounts, prices and references."""
    digits = "(year({0}) * 10000 + month({0}) * 100 + day({0}))"
    mixed = "(k * 7 + p * 3 + n)"
    lines = (
        _table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey AS k",
            "l_partkey AS p",
            "l_linenumber AS n",
            "CAST(l_shipdate AS DATE) AS s",
            "CAST(l_quantity AS BIGINT) AS q",
            "CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS u",
        )
        .selectExpr(
            "k",
            """concat(CASE WHEN p % 53 = 0 THEN 'X-' ELSE 'R-' END,
                      lpad(CAST(p div 3 AS STRING), 10, '0')) AS sls_prd_key""",
            f"{digits.format('s')} AS sls_ship_dt",
            f"CASE WHEN k % 37 = 0 THEN NULL ELSE {digits.format('date_add(s, 7)')} END"
            " AS sls_due_dt",
            f"""CAST(CASE WHEN {mixed} % 7 = 2 THEN NULL WHEN {mixed} % 11 = 3 THEN -(q * u)
                          WHEN {mixed} % 5 = 1 THEN q * u + 1 ELSE q * u END AS INT)
                AS sls_sales""",
            f"CAST(CASE WHEN {mixed} % 23 = 0 THEN 0 ELSE q END AS INT) AS sls_quantity",
            f"""CAST(CASE WHEN {mixed} % 17 = 5 THEN NULL WHEN {mixed} % 19 = 6 THEN 0
                          WHEN {mixed} % 13 = 4 THEN -u ELSE u END AS INT) AS sls_price""",
        )
    )
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CAST(CASE WHEN o_orderkey % 89 = 5 THEN NULL ELSE o_custkey END AS INT) AS sls_cust_id",
        f"""CASE WHEN o_orderkey % 41 = 0 THEN 0 WHEN o_orderkey % 43 = 0 THEN 5489
                 WHEN o_orderkey % 47 = 0 THEN 20101301
                 ELSE {digits.format('o_orderdate')} END AS sls_order_dt""",
    )
    orders = sized(orders, orders.count())
    return (
        lines.join(orders, lines.k == orders.o_orderkey)
        .selectExpr(
            "concat('SO', CAST(k AS STRING)) AS sls_ord_num",
            "sls_prd_key",
            "sls_cust_id",
            "sls_order_dt",
            "sls_ship_dt",
            "sls_due_dt",
            "sls_sales",
            "sls_quantity",
            "sls_price",
        )
    )


def erp_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most customers once, some not at all, some twice with another gender."""
    entries = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS c",
        "explode(CASE WHEN c_custkey % 13 = 5 THEN array() WHEN c_custkey % 200 = 7"
        " THEN array(0, 1, 1) ELSE array(0) END) AS copy",
    )
    return entries.selectExpr(
        """concat(CASE WHEN c % 2 = 0 THEN 'NAS' ELSE '' END, 'AW',
                  lpad(CAST(c AS STRING), 10, '0')) AS cid""",
        """CASE WHEN c % 29 = 0 THEN DATE '2999-01-01' WHEN c % 31 = 0 THEN NULL
                ELSE date_add(DATE '1940-01-01', CAST(c * 37 % 25000 AS INT)) END AS bdate""",
        r"""CASE (c + copy) % 8 WHEN 0 THEN 'M' WHEN 1 THEN ' male ' WHEN 2 THEN 'FEMALE'
                 WHEN 3 THEN 'f' WHEN 4 THEN 'x' WHEN 5 THEN '' WHEN 6 THEN 'Female\r' END
            AS gen""",
    )


def erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashed customer numbers; some rows are copies once cleaned."""
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS c",
        "c_nationkey",
        "explode(CASE WHEN c_custkey % 17 = 4 THEN array() WHEN c_custkey % 10 = 3"
        " THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).selectExpr(
        """concat(CASE WHEN copy = 0 THEN ' ' ELSE '' END, 'AW-',
                  lpad(CAST(c AS STRING), 10, '0')) AS cid""",
        r"""CASE n_nationkey WHEN 0 THEN 'DE' WHEN 1 THEN ' US ' WHEN 2 THEN 'USA'
                 WHEN 3 THEN 'usa' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN ' \t'
                 ELSE n_name END AS cntry""",
    )


def erp_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per category code of the parts; EC_SM is left out."""
    coded = _table(spark, sf_dir, "part").selectExpr(
        f"replace({_CATEGORY}, '-', '_') AS id", "p_type", "p_name"
    )
    grouped = coded.where("id <> 'EC_SM'").groupBy("id").agg({"p_type": "min", "p_name": "min"})
    return grouped.selectExpr(
        "id",
        "concat(' ', `min(p_type)`, ' ') AS cat",
        "concat(`min(p_name)`, '  ') AS subcat",
        r"CASE WHEN id < 'M' THEN ' Yes\r' ELSE 'No' END AS maintenance",
    )


SHAPES = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}
