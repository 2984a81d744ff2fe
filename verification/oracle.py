"""The expected result of every query, in the SQL of the comparing engine.

Each statement is a chain of common table expressions: the six source tables, their
cleaned forms, the dimensions, then the query itself.
"""

from __future__ import annotations

from sluiceway.schemas import BRONZE

_CATEGORY = "upper(substr(p_type, 1, 2)) || '-' || upper(substr(p_name, 1, 2))"
_START = "(DATE '2010-01-01' + CAST((p_partkey // 2) % 3650 AS INTEGER))"
_MIXED = "(k * 7 + p * 3 + n)"
_BLANKS = r"E' \t\r\n\f\v'"

AS_OF = "2026-01-01"


def _digits(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _decoded(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return (
        f"CASE WHEN {text} <> '0' AND length({text}) = 8"
        f" THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) END AS {c}"
    )


def _trim(c: str) -> str:
    return f"trim({c}, {_BLANKS})"


SOURCES: dict[str, str] = {
    "crm_cust_info": """
        SELECT CAST(CASE WHEN k % 97 = 1 THEN NULL ELSE c END AS INTEGER) AS cst_id,
               'AW' || lpad(CAST(c AS VARCHAR), 10, '0') AS cst_key,
               CASE WHEN k % 7 = 3 THEN NULL
                    ELSE ' ' || c_name || CASE WHEN k % 3 = 0 THEN '' ELSE '  ' END END
                    AS cst_firstname,
               CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END || c_mktsegment || ' ' AS cst_lastname,
               CASE k % 6 WHEN 0 THEN ' s ' WHEN 1 THEN 'M' WHEN 2 THEN 'S' WHEN 3 THEN 'm'
                    WHEN 4 THEN 'X' END AS cst_marital_status,
               CASE k % 8 WHEN 0 THEN 'f' WHEN 1 THEN ' M' WHEN 2 THEN 'F ' WHEN 3 THEN 'M'
                    WHEN 4 THEN '' WHEN 5 THEN 'U' WHEN 6 THEN 'm' END AS cst_gndr,
               CASE WHEN k % 31 = 0 THEN NULL ELSE d END AS cst_create_date
        FROM (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d FROM orders)
        JOIN customer ON c = c_custkey""",
    "crm_prd_info": f"""
        SELECT CAST(p_partkey AS INTEGER) AS prd_id,
               CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE '' END || {_CATEGORY} || '-R-'
                    || lpad(CAST(p_partkey // 3 AS VARCHAR), 10, '0') AS prd_key,
               p_name AS prd_nm,
               CASE WHEN p_partkey % 11 = 0 THEN NULL
                    ELSE CAST(floor(p_retailprice) AS INTEGER) END AS prd_cost,
               CASE p_size % 6 WHEN 0 THEN 'R ' WHEN 1 THEN 'm' WHEN 2 THEN 'S' WHEN 3 THEN 'T'
                    WHEN 4 THEN '' END AS prd_line,
               CASE WHEN p_partkey % 101 = 0 THEN NULL
                    ELSE CAST({_START} AS TIMESTAMP) END AS prd_start_dt,
               CAST({_START} - 10 AS TIMESTAMP) AS prd_end_dt
        FROM part""",
    "crm_sales_details": f"""
        SELECT 'SO' || CAST(k AS VARCHAR) AS sls_ord_num,
               CASE WHEN p % 53 = 0 THEN 'X-' ELSE 'R-' END
                    || lpad(CAST(p // 3 AS VARCHAR), 10, '0') AS sls_prd_key,
               CAST(CASE WHEN k % 89 = 5 THEN NULL ELSE o_custkey END AS INTEGER) AS sls_cust_id,
               CASE WHEN k % 41 = 0 THEN 0 WHEN k % 43 = 0 THEN 5489
                    WHEN k % 47 = 0 THEN 20101301 ELSE {_digits("o_orderdate")} END
                    AS sls_order_dt,
               {_digits("s")} AS sls_ship_dt,
               CASE WHEN k % 37 = 0 THEN NULL ELSE {_digits("CAST(s AS DATE) + 7")} END
                    AS sls_due_dt,
               CAST(CASE WHEN {_MIXED} % 7 = 2 THEN NULL WHEN {_MIXED} % 11 = 3 THEN -(q * u)
                         WHEN {_MIXED} % 5 = 1 THEN q * u + 1 ELSE q * u END AS INTEGER)
                    AS sls_sales,
               CAST(CASE WHEN {_MIXED} % 23 = 0 THEN 0 ELSE q END AS INTEGER) AS sls_quantity,
               CAST(CASE WHEN {_MIXED} % 17 = 5 THEN NULL WHEN {_MIXED} % 19 = 6 THEN 0
                         WHEN {_MIXED} % 13 = 4 THEN -u ELSE u END AS INTEGER) AS sls_price
        FROM (SELECT l_orderkey AS k, l_partkey AS p, l_linenumber AS n, l_shipdate AS s,
                     CAST(l_quantity AS BIGINT) AS q,
                     CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS u FROM lineitem)
        JOIN orders ON k = o_orderkey""",
    "erp_cust_az12": r"""
        SELECT CASE WHEN c % 2 = 0 THEN 'NAS' ELSE '' END || 'AW'
                    || lpad(CAST(c AS VARCHAR), 10, '0') AS cid,
               CASE WHEN c % 29 = 0 THEN DATE '2999-01-01' WHEN c % 31 = 0 THEN NULL
                    ELSE DATE '1940-01-01' + CAST(c * 37 % 25000 AS INTEGER) END AS bdate,
               CASE (c + copy) % 8 WHEN 0 THEN 'M' WHEN 1 THEN ' male ' WHEN 2 THEN 'FEMALE'
                    WHEN 3 THEN 'f' WHEN 4 THEN 'x' WHEN 5 THEN '' WHEN 6 THEN E'Female\r' END
                    AS gen
        FROM (SELECT c_custkey AS c,
                     unnest(CASE WHEN c_custkey % 13 = 5 THEN [] WHEN c_custkey % 200 = 7
                            THEN [0, 1, 1] ELSE [0] END) AS copy FROM customer)""",
    "erp_loc_a101": r"""
        SELECT CASE WHEN copy = 0 THEN ' ' ELSE '' END || 'AW-'
                    || lpad(CAST(c AS VARCHAR), 10, '0') AS cid,
               CASE n_nationkey WHEN 0 THEN 'DE' WHEN 1 THEN ' US ' WHEN 2 THEN 'USA'
                    WHEN 3 THEN 'usa' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN E' \t'
                    ELSE n_name END AS cntry
        FROM (SELECT c_custkey AS c, c_nationkey,
                     unnest(CASE WHEN c_custkey % 17 = 4 THEN [] WHEN c_custkey % 10 = 3
                            THEN [0, 1] ELSE [0] END) AS copy FROM customer)
        JOIN nation ON c_nationkey = n_nationkey""",
    "erp_px_cat_g1v2": rf"""
        SELECT id, ' ' || min(p_type) || ' ' AS cat, min(p_name) || '  ' AS subcat,
               CASE WHEN id < 'M' THEN E' Yes\r' ELSE 'No' END AS maintenance
        FROM (SELECT replace({_CATEGORY}, '-', '_') AS id, p_type, p_name FROM part)
        WHERE id <> 'EC_SM' GROUP BY id""",
}

_CUSTOMER_COLUMNS = (
    "cst_key",
    "cst_firstname",
    "cst_lastname",
    "cst_marital_status",
    "cst_gndr",
)
_NEWEST = "cst_create_date DESC NULLS LAST, " + ", ".join(
    f"{c} DESC NULLS LAST" for c in _CUSTOMER_COLUMNS
)
_IDENTIFIED = "crm_cust_info WHERE cst_id IS NOT NULL AND cst_id <> 0"
_CLEAN_CUSTOMER = f"""
        SELECT CAST(cst_id AS BIGINT) AS cst_id, cst_key,
               {_trim("cst_firstname")} AS cst_firstname, {_trim("cst_lastname")} AS cst_lastname,
               CASE upper({_trim("cst_marital_status")}) WHEN 'S' THEN 'Single'
                    WHEN 'M' THEN 'Married' ELSE 'n/a' END AS cst_marital_status,
               CASE upper({_trim("cst_gndr")}) WHEN 'F' THEN 'Female'
                    WHEN 'M' THEN 'Male' ELSE 'n/a' END AS cst_gndr,
               cst_create_date"""


def _newest_value(c: str) -> str:
    return (
        f"first({c} ORDER BY {_NEWEST}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    )


SILVER: dict[str, str] = {
    "customers": f"""{_CLEAN_CUSTOMER}
        FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY {_NEWEST}) AS rn
              FROM {_IDENTIFIED}) WHERE rn = 1""",
    "customers_coalesced": f"""{_CLEAN_CUSTOMER}
        FROM (SELECT cst_id, {", ".join(map(_newest_value, _CUSTOMER_COLUMNS))},
                     max(cst_create_date) AS cst_create_date
              FROM {_IDENTIFIED} GROUP BY cst_id)""",
    "products": f"""
        SELECT prd_id, cat_id, prd_key, prd_nm, prd_cost, prd_line,
               CAST(prd_start_dt AS DATE) AS prd_start_dt,
               CAST(lead(prd_start_dt) OVER (PARTITION BY prd_key
                    ORDER BY prd_start_dt NULLS LAST, prd_id) AS DATE) - 1 AS prd_end_dt
        FROM (SELECT CAST(prd_id AS BIGINT) AS prd_id,
                     replace(substr({_trim("prd_key")}, 1, 5), '-', '_') AS cat_id,
                     substr({_trim("prd_key")}, 7) AS prd_key, prd_nm,
                     CAST(coalesce(prd_cost, 0) AS BIGINT) AS prd_cost,
                     CASE upper({_trim("prd_line")}) WHEN 'M' THEN 'Mountain'
                          WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                          WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
                     prd_start_dt FROM crm_prd_info)""",
    "sales": f"""
        SELECT sls_ord_num, sls_prd_key, CAST(sls_cust_id AS BIGINT) AS sls_cust_id,
               {_decoded("sls_order_dt")}, {_decoded("sls_ship_dt")}, {_decoded("sls_due_dt")},
               fixed AS sls_sales, q AS sls_quantity,
               CASE WHEN (p IS NULL OR p <= 0) AND q <> 0
                    THEN CAST(trunc(fixed / q) AS BIGINT) ELSE p END AS sls_price
        FROM (SELECT *, CASE WHEN s IS NULL OR s <= 0 OR s <> abs(p) * q
                             THEN abs(p) * q ELSE s END AS fixed
              FROM (SELECT *, CAST(sls_sales AS BIGINT) AS s, CAST(sls_quantity AS BIGINT) AS q,
                           CAST(sls_price AS BIGINT) AS p FROM crm_sales_details))""",
    "demographics": f"""
        SELECT CASE WHEN starts_with(cid, 'NAS') THEN substr(cid, 4) ELSE cid END AS cid,
               CASE WHEN bdate <= DATE '{AS_OF}' THEN bdate END AS bdate,
               CASE WHEN upper({_trim("gen")}) IN ('M', 'MALE') THEN 'Male'
                    WHEN upper({_trim("gen")}) IN ('F', 'FEMALE') THEN 'Female'
                    ELSE 'n/a' END AS gen
        FROM erp_cust_az12""",
    "locations": f"""
        SELECT DISTINCT replace({_trim("cid")}, '-', '') AS cid,
               CASE {_trim("cntry")} WHEN 'DE' THEN 'Germany' WHEN 'US' THEN 'United States'
                    WHEN 'USA' THEN 'United States' WHEN '' THEN 'n/a'
                    ELSE coalesce({_trim("cntry")}, 'n/a') END AS cntry
        FROM erp_loc_a101""",
    "categories": f"""
        SELECT id, {_trim("cat")} AS cat, {_trim("subcat")} AS subcat,
               {_trim("maintenance")} AS maintenance FROM erp_px_cat_g1v2""",
}

_CUSTOMER_JOIN = """
        FROM customers
        LEFT JOIN demographics AS demo ON cst_key = demo.cid
        LEFT JOIN locations AS loc ON cst_key = loc.cid"""
_CUSTOMER_SELECT = """
               cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
               cst_lastname AS last_name, cntry AS country, cst_marital_status AS marital_status,
               CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr ELSE coalesce(gen, 'n/a') END AS gender,
               bdate AS birthday, cst_create_date AS create_date"""
_PRODUCT_SELECT = """
               prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name,
               cat_id AS category_id, cat AS category, subcat AS subcategory, maintenance"""
_PRODUCT_JOIN = """
        FROM products LEFT JOIN categories ON cat_id = id WHERE prd_end_dt IS NULL"""

GOLD: dict[str, str] = {
    "dim_customer": f"""
        SELECT DISTINCT dense_rank() OVER (ORDER BY cst_id) - 1 AS customer_key,
               {_CUSTOMER_SELECT} {_CUSTOMER_JOIN}""",
    # Ranked by the text "<timestamp>_<key>", an independent form of (start, key).
    "dim_product": f"""
        SELECT dense_rank() OVER (ORDER BY CASE WHEN prd_start_dt IS NOT NULL
                    AND prd_key IS NOT NULL
                    THEN strftime(CAST(prd_start_dt AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
                         || '_' || prd_key END NULLS LAST,
                    prd_start_dt NULLS LAST, prd_key NULLS LAST) - 1 AS product_key,
               {_PRODUCT_SELECT}, CAST(prd_cost AS DOUBLE) AS cost, prd_line AS product_line,
               prd_start_dt AS start_date {_PRODUCT_JOIN}""",
    "fact_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key,
               sls_order_dt AS order_date, sls_ship_dt AS ship_date, sls_due_dt AS due_date,
               CAST(sls_sales AS DOUBLE) AS sales_amount, sls_quantity AS quantity,
               CAST(sls_price AS DOUBLE) AS price
        FROM sales LEFT JOIN dim_product ON sls_prd_key = product_number
        LEFT JOIN dim_customer ON sls_cust_id = customer_id""",
}

_CUSTOMER_OUT = (
    "customer_id",
    "customer_number",
    "first_name",
    "last_name",
    "country",
    "marital_status",
    "gender",
    "birthday",
    "create_date",
)
_PRODUCT_OUT = (
    "start_date",
    "product_number",
    "product_id",
    "product_name",
    "category_id",
    "category",
    "subcategory",
    "maintenance",
    "cost",
    "product_line",
)


def _total_order(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)


SQL_VIEWS: dict[str, str] = {
    "view_dim_customers": f"""
        SELECT row_number() OVER (ORDER BY {_total_order(_CUSTOMER_OUT)}) AS customer_key, *
        FROM (SELECT {_CUSTOMER_SELECT} {_CUSTOMER_JOIN})""",
    "view_dim_products": f"""
        SELECT row_number() OVER (ORDER BY {_total_order(_PRODUCT_OUT)}) AS product_key, *
        FROM (SELECT {_PRODUCT_SELECT}, prd_cost AS cost, prd_line AS product_line,
                     prd_start_dt AS start_date {_PRODUCT_JOIN})""",
    "view_fact_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key,
               sls_order_dt AS order_date, sls_ship_dt AS ship_date, sls_due_dt AS due_date,
               sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
        FROM sales LEFT JOIN view_dim_products ON sls_prd_key = product_number
        LEFT JOIN view_dim_customers ON sls_cust_id = customer_id""",
}


def _text(columns: tuple[str, ...]) -> str:
    return ", ".join(f'left(CAST({c} AS VARCHAR), 50) AS {c}' for c in columns)


WAREHOUSE: dict[str, str] = {
    "wh_dim_customer": """
        SELECT customer_key, CAST(customer_id AS VARCHAR) AS customer_id, customer_number,
               first_name, last_name, country, marital_status, gender,
               CAST(date_trunc('day', birthday) AS DATE) AS birthday,
               CAST(date_trunc('day', create_date) AS DATE) AS create_date
        FROM dim_customer""",
    "wh_dim_product": """
        SELECT product_key, CAST(product_id AS VARCHAR) AS product_id, product_number,
               product_name, category_id, category, subcategory, maintenance, cost,
               product_line, CAST(date_trunc('day', start_date) AS DATE) AS start_date
        FROM dim_product""",
    "wh_fact_sales": """
        SELECT order_number, CAST(product_key AS BIGINT) AS product_key,
               CAST(customer_key AS BIGINT) AS customer_key,
               CAST(date_trunc('day', order_date) AS DATE) AS order_date,
               CAST(date_trunc('day', ship_date) AS DATE) AS ship_date,
               CAST(date_trunc('day', due_date) AS DATE) AS due_date,
               sales_amount, quantity, price FROM fact_sales""",
    "typed_dim_customer": f"""
        SELECT CAST(customer_key AS BIGINT) AS customer_key,
               {_text(("customer_id", "customer_number", "first_name", "last_name", "country",
                       "marital_status", "gender"))},
               CAST(birthday AS DATE) AS birthday, CAST(create_date AS DATE) AS create_date
        FROM wh_dim_customer""",
    "typed_dim_product": f"""
        SELECT CAST(product_key AS BIGINT) AS product_key,
               CAST(product_id AS INTEGER) AS product_id,
               {_text(("product_number", "product_name", "category_id", "category",
                       "subcategory", "maintenance", "product_line"))},
               CAST(cost AS DOUBLE) AS cost, CAST(start_date AS DATE) AS start_date
        FROM wh_dim_product""",
    "typed_fact_sales": f"""
        SELECT {_text(("order_number",))}, CAST(product_key AS BIGINT) AS product_key,
               CAST(customer_key AS BIGINT) AS customer_key,
               CAST(order_date AS DATE) AS order_date, CAST(ship_date AS DATE) AS ship_date,
               CAST(due_date AS DATE) AS due_date, CAST(sales_amount AS DOUBLE) AS sales_amount,
               CAST(quantity AS INTEGER) AS quantity, CAST(price AS DOUBLE) AS price
        FROM wh_fact_sales""",
}


def _missing(table: str, column: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, 'not_null' AS test, '{column}' AS column_name,
               count(*) AS failures FROM typed_{table} WHERE {column} IS NULL"""


def _repeated(table: str, column: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, 'unique' AS test, '{column}' AS column_name,
               count(*) AS failures
        FROM (SELECT {column} FROM typed_{table} WHERE {column} IS NOT NULL
              GROUP BY {column} HAVING count(*) > 1)"""


def _unrelated(table: str, column: str, parent: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, 'relationships' AS test, '{column}' AS column_name,
               count(*) AS failures FROM typed_{table} AS child
        WHERE {column} IS NOT NULL AND NOT EXISTS (
              SELECT 1 FROM typed_{parent} AS known WHERE known.{column} = child.{column})"""


_NOT_NULL = " UNION ALL ".join(
    _missing(t, c)
    for t, c in (
        ("dim_customer", "customer_key"),
        ("dim_customer", "customer_id"),
        ("dim_product", "product_key"),
        ("dim_product", "product_id"),
        ("fact_sales", "order_number"),
        ("fact_sales", "product_key"),
        ("fact_sales", "customer_key"),
    )
)
_UNIQUE = " UNION ALL ".join(
    (_repeated("dim_customer", "customer_key"), _repeated("dim_product", "product_key"))
)
_RELATED = " UNION ALL ".join(
    (
        _unrelated("fact_sales", "product_key", "dim_product"),
        _unrelated("fact_sales", "customer_key", "dim_customer"),
    )
)

QUALITY: dict[str, str] = {
    "dq_not_null": _NOT_NULL,
    "dq_unique": _UNIQUE,
    "dq_relationships": _RELATED,
    "dq_report": f"""
        SELECT *, failures = 0 AS passed
        FROM ({_NOT_NULL} UNION ALL {_UNIQUE} UNION ALL {_RELATED})""",
}

# Column types as the engine reports them in its run metrics.
_DTYPES = {
    "customers": "cst_id:bigint,cst_key:string,cst_firstname:string,cst_lastname:string,"
    "cst_marital_status:string,cst_gndr:string,cst_create_date:date",
    "products": "prd_id:bigint,cat_id:string,prd_key:string,prd_nm:string,prd_cost:bigint,"
    "prd_line:string,prd_start_dt:date,prd_end_dt:date",
    "sales": "sls_ord_num:string,sls_prd_key:string,sls_cust_id:bigint,sls_order_dt:date,"
    "sls_ship_dt:date,sls_due_dt:date,sls_sales:bigint,sls_quantity:bigint,sls_price:bigint",
    "demographics": "cid:string,bdate:date,gen:string",
    "locations": "cid:string,cntry:string",
    "categories": "id:string,cat:string,subcat:string,maintenance:string",
}



def _figures(dtypes: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS records, '{d}' AS column_dtypes FROM {t}"
        for t, d in dtypes.items()
    )


_METRICS = _figures(_DTYPES)
_METRICS_BY_NAME = _figures({t: ",".join(sorted(d.split(","))) for t, d in _DTYPES.items()})

# Columns of the source extracts, in the order of the files.
_SOURCE_COLUMNS = {table: schema.names for table, schema in BRONZE.items()}

_BRONZE_PROFILE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows,"
    f" count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct,"
    f" CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM {t}"
    for t, columns in _SOURCE_COLUMNS.items()
    for c in columns
)

_UNFIT = {
    "crm_cust_info": "cst_id",
    "crm_prd_info": "prd_cost",
    "crm_sales_details": "sls_cust_id",
    "erp_cust_az12": "bdate",
}


def _rejects(table: str, columns: list[str]) -> str:
    def text(c: str) -> str:
        return f"coalesce(regexp_replace(CAST({c} AS VARCHAR), '[\r\t]', '', 'g'), '\\N')"

    fine = " || ',' || ".join(map(text, columns))
    bad = _UNFIT.get(table)
    unfit = " || ',' || ".join("'n/a'" if c == bad else text(c) for c in columns)
    reason = f"WHEN 7 THEN 'value: {bad}'" if bad else ""
    return f"""
        SELECT '{table}' AS table_name, reason, record, landed FROM (
            SELECT CASE length(fine) % 16 WHEN 3 THEN 'fields' WHEN 5 THEN 'fields'
                        {reason} WHEN 9 THEN 'quote' END AS reason,
                   CASE length(fine) % 16 WHEN 3 THEN fine || ',surplus'
                        WHEN 5 THEN regexp_replace(fine, ',[^,]*$', '')
                        WHEN 7 THEN unfit WHEN 9 THEN fine || '"' ELSE fine END AS record,
                   count(*) FILTER (reason IS NULL) OVER () AS landed
            FROM (SELECT {fine} AS fine, {unfit} AS unfit FROM {table}))
        WHERE reason IS NOT NULL"""


_STAMPED = {
    "crm_cust_info": "customers",
    "crm_prd_info": "products",
    "crm_sales_details": "sales",
    "erp_cust_az12": "demographics",
    "erp_loc_a101": "locations",
    "erp_px_cat_g1v2": "categories",
    "dim_customer": "dim_customer",
    "dim_product": "dim_product",
    "fact_sales": "fact_sales",
}

_STATEMENTS = {**SOURCES, **SILVER, **GOLD, **SQL_VIEWS, **WAREHOUSE}

# Query name -> its final SELECT, where the name is not itself a table above.
_QUERIES: dict[str, str] = {
    **{f"silver_{name}": f"SELECT * FROM {name}" for name in SILVER},
    **{name: f"SELECT * FROM {name}" for name in (*GOLD, *SQL_VIEWS, *WAREHOUSE)},
    **QUALITY,
    "csv_ingest": "SELECT * FROM crm_prd_info",
    "lake_roundtrip": "SELECT * FROM sales",
    # The first write has every window; 1998 is then written again with its sign turned.
    "lake_partition_overwrite": """
        SELECT sls_ord_num, CASE WHEN year(sls_ship_dt) = 1998 THEN -sls_sales
               ELSE sls_sales END AS sls_sales, sls_ship_dt,
               CAST(year(sls_ship_dt) AS VARCHAR) || '0101000000_'
                    || CAST(year(sls_ship_dt) + 1 AS VARCHAR) || '0101000000' AS window_id
        FROM sales""",
    "warehouse_replace": "SELECT customer_key, customer_id, country FROM wh_dim_customer",
    "warehouse_refresh": "SELECT * FROM wh_dim_product",
    "run_metrics": _METRICS,
    "run_metrics_observed": _METRICS_BY_NAME,
    "bronze_ingest": _BRONZE_PROFILE,
    "csv_rejects": " UNION ALL ".join(_rejects(t, c) for t, c in _SOURCE_COLUMNS.items()),
    "lake_window_read": """
        SELECT sls_ord_num, sls_ship_dt,
               CAST(year(sls_ship_dt) AS VARCHAR) || '0101000000_'
                    || CAST(year(sls_ship_dt) + 1 AS VARCHAR) || '0101000000' AS window_id
        FROM sales WHERE year(sls_ship_dt) IN (1995, 1997)""",
    "audit_stamp": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '2026-01-01 00:00:00' AS stamp, count(*) AS records FROM {c}"
        for t, c in _STAMPED.items()
    ),
    "catalog_view_fact_sales": "SELECT * FROM view_fact_sales",
}


def _with_chain(final: str) -> str:
    chain = ",\n".join(f"{name} AS ({body})" for name, body in _STATEMENTS.items())
    return f"WITH {chain}\n{final}"


def statements() -> dict[str, str]:
    return {name: _with_chain(final) for name, final in _QUERIES.items()}
