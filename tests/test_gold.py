from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import BATCH_TS
from pyspark.sql import functions as F

from sluiceway.functions import enforce
from sluiceway.plans import gold, views, warehouse
from sluiceway.schemas import AUDIT_COLUMN, GOLD, SILVER, VIEWS, WAREHOUSE

DAY = date(2020, 1, 1)


def silver(spark, table, rows):
    return spark.createDataFrame(rows, SILVER[table])


@pytest.fixture
def customers(spark):
    return silver(
        spark,
        "crm_cust_info",
        [
            (30, "AW30", "Cy", "Z", "n/a", "n/a", DAY),
            (10, "AW10", "Al", "X", "Single", "n/a", DAY),
            (20, "AW20", "Bo", "Y", "Married", "Female", DAY),
            (40, None, "Di", "W", "n/a", "Male", None),
        ],
    )


@pytest.fixture
def demographics(spark):
    return silver(
        spark, "erp_cust_az12", [("AW10", DAY, "Male"), ("AW20", None, "Male"), (None, DAY, "Male")]
    )


@pytest.fixture
def locations(spark):
    return silver(spark, "erp_loc_a101", [("AW10", "Germany"), ("AW20", "France")])


@pytest.fixture
def products(spark):
    return silver(
        spark,
        "crm_prd_info",
        [
            (1, "AC_HE", "HL", "old", 1, "Road", date(2011, 7, 1), date(2012, 6, 30)),
            (2, "AC_HE", "HL", "new", 2, "Road", date(2012, 7, 1), None),
            (3, "XX_XX", "AB", "lost", 3, "n/a", date(2012, 7, 1), None),
            (4, "AC_HE", "ZZ", "early", 4, "n/a", date(2001, 1, 1), None),
            (5, "AC_HE", "NN", "undated", 5, "n/a", None, None),
        ],
    )


@pytest.fixture
def categories(spark):
    return silver(spark, "erp_px_cat_g1v2", [("AC_HE", "Accessories", "Helmets", "Yes")])


@pytest.fixture
def sales(spark):
    return silver(
        spark,
        "crm_sales_details",
        [
            ("SO1", "HL", 10, DAY, DAY, DAY, 10, 2, 5),
            ("SO2", "??", 20, DAY, DAY, DAY, 10, 2, 5),
            ("SO3", "ZZ", 99, None, DAY, DAY, None, 2, None),
            ("SO4", None, None, DAY, DAY, DAY, 10, 2, 5),
        ],
    )


def test_customer_dimension(customers, demographics, locations, rows_of):
    dim = gold.build_dim_customer(customers, demographics, locations, BATCH_TS)
    columns = ("customer_key", "customer_id", "gender", "country", "birthday")
    assert rows_of(dim, *columns) == [
        (0, 10, "Male", "Germany", DAY),
        (1, 20, "Female", "France", None),
        (2, 30, "n/a", None, None),
        (3, 40, "Male", None, None),
    ]
    assert dim.columns == [*GOLD["dim_customer"].names, AUDIT_COLUMN]


@pytest.mark.parametrize("heavy_rows", [10**9, 1], ids=["plain", "salted"])
def test_repeated_partner_repeats_the_key(spark, customers, locations, heavy_rows, rows_of):
    twice = silver(
        spark,
        "erp_cust_az12",
        [("AW10", DAY, "Male"), ("AW10", DAY, "Female"), ("AW10", DAY, "Male")],
    )
    dim = gold.build_dim_customer(customers, twice, locations, BATCH_TS, heavy_rows)
    assert rows_of(dim, "customer_key", "gender") == [
        (0, "Female"), (0, "Male"), (1, "Female"), (2, "n/a"), (3, "Male")
    ]


def test_product_dimension(products, categories, rows_of):
    dim = gold.build_dim_product(products, categories, BATCH_TS)
    assert rows_of(dim, "product_key", "product_id", "category", "cost") == [
        (0, 4, "Accessories", 4.0),
        (1, 3, None, 3.0),
        (2, 2, "Accessories", 2.0),
        (3, 5, "Accessories", 5.0),
    ]
    assert [(f.name, f.dataType) for f in dim.drop(AUDIT_COLUMN).schema] == [
        (f.name, f.dataType) for f in GOLD["dim_product"]
    ]


def star(customers, demographics, locations, products, categories, sales):
    customer = gold.build_dim_customer(customers, demographics, locations, BATCH_TS)
    product = gold.build_dim_product(products, categories, BATCH_TS)
    fact = gold.build_fact_sales(sales, product, customer, BATCH_TS)
    return {"dim_customer": customer, "dim_product": product, "fact_sales": fact}


@pytest.fixture
def star_schema(customers, demographics, locations, products, categories, sales):
    return star(customers, demographics, locations, products, categories, sales)


def test_fact_keeps_every_sale(star_schema, rows_of):
    fact = star_schema["fact_sales"]
    assert rows_of(fact, "order_number", "product_key", "customer_key", "sales_amount") == [
        ("SO1", 2, 0, 10.0),
        ("SO2", None, 1, 10.0),
        ("SO3", 0, None, None),
        ("SO4", None, None, 10.0),
    ]
    assert fact.columns == [*GOLD["fact_sales"].names, AUDIT_COLUMN]


def test_business_id_types_are_aligned(spark, sales, star_schema, rows_of):
    """The dimensions may come back from the warehouse with their ids as text."""
    text = {t: warehouse.LOADS[t](star_schema[t]) for t in ("dim_product", "dim_customer")}
    again = gold.build_fact_sales(sales, text["dim_product"], text["dim_customer"], BATCH_TS)
    assert rows_of(again) == rows_of(star_schema["fact_sales"])


def test_warehouse_loads(star_schema, rows_of):
    for table, load in warehouse.LOADS.items():
        out = load(star_schema[table])
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in WAREHOUSE[table]
        ]
        # Loading again, from a table without the audit column, changes nothing.
        assert rows_of(load(out)) == rows_of(out)


def test_typed_views(spark, star_schema):
    loaded = {t: load(star_schema[t]) for t, load in warehouse.LOADS.items()}
    long_name = loaded["dim_customer"].withColumn("first_name", F.repeat(F.lit("x"), 60))
    registered = views.register_typed_views(loaded | {"dim_customer": long_name})
    for table in registered:
        assert [(f.name, f.dataType) for f in spark.table(table).schema] == [
            (f.name, f.dataType) for f in VIEWS[table]
        ]
    assert {r.first_name for r in spark.table("dim_customer").collect()} == {"x" * 50}


def test_sql_variant_counts_rows_from_one(
    spark, customers, demographics, locations, products, categories, sales, rows_of
):
    twice = demographics.union(demographics.where("cid = 'AW10'"))
    out = views.register_gold_views(
        {
            "crm_cust_info": customers,
            "erp_cust_az12": twice,
            "erp_loc_a101": locations,
            "crm_prd_info": products,
            "erp_px_cat_g1v2": categories,
            "crm_sales_details": sales,
        }
    )
    assert rows_of(out["dim_customers"], "customer_key", "customer_id") == [
        (1, 10), (2, 10), (3, 20), (4, 30), (5, 40)
    ]
    assert rows_of(spark.table("gold_dim_products"), "product_key", "product_number") == [
        (1, "ZZ"), (2, "AB"), (3, "HL"), (4, "NN")
    ]
    assert rows_of(spark.table("gold_fact_sales"), "order_number", "product_key", "customer_key") == [
        ("SO1", 3, 1), ("SO1", 3, 2), ("SO2", None, 3), ("SO3", 1, None), ("SO4", None, None)
    ]


def test_enforce_projects_to_the_contract(spark):
    df = spark.createDataFrame([(1, "7", datetime(2020, 1, 1))], "extra int, id string, d timestamp")
    schema = spark.createDataFrame([], "d date, id bigint").schema
    assert enforce(df, schema).collect() == [(DAY, 7)]


def test_history_filter_is_below_the_category_join(products, categories):
    plan = gold.current_products(products, categories)._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.index("Join LeftOuter") < text.index("isnull(prd_end_dt")
