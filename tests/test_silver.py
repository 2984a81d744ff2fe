from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import BATCH_TS
from pyspark.sql import functions as F

from sluiceway.plans import silver
from sluiceway.schemas import AUDIT_COLUMN, BRONZE, SILVER


def bronze(spark, table, rows):
    return spark.createDataFrame(rows, BRONZE[table])


def customers(spark, *rows):
    return bronze(spark, "crm_cust_info", list(rows))


def test_customers_without_id_are_dropped(spark):
    day = date(2020, 1, 1)
    raw = customers(
        spark,
        (None, "AW0", "a", "b", "S", "F", day),
        (0, "AW0", "a", "b", "S", "F", day),
        (1, "AW1", "a", "b", "S", "F", day),
    )
    assert [r.cst_id for r in silver.clean_customers(raw, BATCH_TS).collect()] == [1]


def test_customer_ids_as_text(spark):
    raw = customers(spark, (1, "AW1", "a", "b", "S", "F", None)).drop("cst_id")
    ids = spark.createDataFrame([("7",), (" ",), ("0",), (None,)], "cst_id string")
    out = silver.clean_customers(ids.crossJoin(raw), BATCH_TS)
    assert [r.cst_id for r in out.collect()] == [7]


def test_newest_customer_record_wins(spark):
    raw = customers(
        spark,
        (1, "AW1", "Ann", "b", "S", "F", date(2020, 1, 1)),
        (1, "AW1", None, "c", "M", "F", date(2020, 1, 3)),
        (2, "AW2", "undated", "b", "S", "F", None),
        (2, "AW2", "dated", "b", "S", "F", date(2020, 1, 2)),
    )
    by_row = {r.cst_id: r for r in silver.clean_customers(raw, BATCH_TS).collect()}
    assert by_row[1].cst_create_date == date(2020, 1, 3)
    assert by_row[1].cst_firstname is None
    assert by_row[2].cst_firstname == "dated"
    merged = silver.clean_customers(raw, BATCH_TS, mode="coalesce")
    assert merged.where("cst_id = 1").first().cst_firstname == "Ann"
    assert merged.where("cst_id = 1").first().cst_lastname == "c"


def test_customer_codes_and_names(spark):
    codes = [(" s ", "f"), ("M", " M"), ("X", ""), (None, None)]
    raw = customers(
        spark,
        *[
            (i, f"AW{i}", " Jon ", "\tYang\r", status, gender, None)
            for i, (status, gender) in enumerate(codes, 1)
        ],
    )
    out = silver.clean_customers(raw, BATCH_TS).orderBy("cst_id").collect()
    assert [r.cst_marital_status for r in out] == ["Single", "Married", "n/a", "n/a"]
    assert [r.cst_gndr for r in out] == ["Female", "Male", "n/a", "n/a"]
    assert {(r.cst_firstname, r.cst_lastname) for r in out} == {("Jon", "Yang")}


def test_broken_create_date_is_null(spark):
    raw = customers(spark, (1, "AW1", "a", "b", "S", "F", None)).withColumn(
        "cst_create_date", F.lit("0000-00-00")
    )
    assert silver.clean_customers(raw, BATCH_TS).first().cst_create_date is None


def products(spark, *rows):
    return bronze(
        spark,
        "crm_prd_info",
        [(i, key, "name", cost, line, start, None) for i, key, cost, line, start in rows],
    )


def test_product_key_cost_and_line(spark):
    raw = products(
        spark,
        *[
            (i, " CO-RF-FR-R92B-58 ", None if i == 1 else 12, line, datetime(2011, 7, i))
            for i, line in enumerate(["R ", "m", "S", "T", "", None], 1)
        ],
    )
    out = silver.clean_products(raw, BATCH_TS).orderBy("prd_id").collect()
    assert {(r.cat_id, r.prd_key) for r in out} == {("CO_RF", "FR-R92B-58")}
    assert [r.prd_cost for r in out] == [0, 12, 12, 12, 12, 12]
    assert [r.prd_line for r in out] == [
        "Road", "Mountain", "Other Sales", "Touring", "n/a", "n/a"
    ]


@pytest.mark.parametrize("partitions", [None, 40], ids=["chosen", "many"])
def test_product_versions(spark, partitions):
    raw = products(
        spark,
        (1, "AC-HE-HL", 1, "S", datetime(2011, 7, 1)),
        (3, "AC-HE-HL", 1, "S", datetime(2013, 7, 1)),
        (2, "AC-HE-HL", 1, "S", datetime(2012, 7, 1)),
        (4, "AC-HE-XX", 1, "S", None),
        (5, "AC-HE-XX", 1, "S", datetime(2012, 7, 1)),
        (6, None, 1, "S", datetime(2012, 7, 1)),
        (7, None, 1, "S", datetime(2013, 7, 1)),
        (9, "AC-HE-TT", 1, "S", datetime(2012, 7, 1)),
        (8, "AC-HE-TT", 1, "S", datetime(2012, 7, 1)),
    )
    out = silver.clean_products(raw, BATCH_TS, partitions).collect()
    assert {r.prd_id: r.prd_end_dt for r in out} == {
        1: date(2012, 6, 30),
        2: date(2013, 6, 30),
        3: None,
        4: None,
        5: None,
        6: None,
        7: None,
        8: date(2012, 6, 30),
        9: None,
    }


def test_versions_of_a_product_do_not_overlap(spark):
    raw = products(
        spark,
        *[(i, f"AC-HE-{i % 7}", 1, "S", datetime(2000 + i % 20, 1, 1 + i % 9)) for i in range(300)],
    )
    out = silver.clean_products(raw, BATCH_TS)
    a, b = out.alias("a"), out.alias("b")
    overlapping = a.join(b, "prd_key").where(
        "a.prd_start_dt < b.prd_start_dt AND a.prd_end_dt >= b.prd_start_dt"
    )
    assert overlapping.count() == 0
    assert out.where("prd_end_dt IS NULL").count() == 7


SALES = [
    ((10, 2, 5), (10, 2, 5)),
    ((10, 2, -5), (10, 2, 5)),
    ((-5, 2, 5), (10, 2, 5)),
    ((None, 2, 5), (10, 2, 5)),
    ((30, 2, 7), (14, 2, 7)),
    ((10, 2, 0), (0, 2, 0)),
    ((10, 0, 5), (0, 0, 5)),
    ((10, 0, -5), (0, 0, -5)),
    ((7, 2, None), (7, 2, 3)),
    ((7, None, 5), (7, None, 5)),
    ((None, 2, None), (None, 2, None)),
    ((-7, 2, None), (None, 2, None)),
    ((10, -2, 5), (-10, -2, 5)),
    ((2**31 - 1, 2**31 - 1, 2**31 - 1), ((2**31 - 1) ** 2, 2**31 - 1, 2**31 - 1)),
]


@pytest.mark.parametrize(("given", "expected"), SALES)
def test_sales_repair(spark, given, expected):
    raw = bronze(
        spark, "crm_sales_details", [("SO1", "P", 1, 20101229, 20101230, 20110105, *given)]
    )
    row = silver.clean_sales(raw, BATCH_TS).first()
    assert (row.sls_sales, row.sls_quantity, row.sls_price) == expected


def test_sales_dates(spark):
    dates = [20101229, 0, 5489, 20101301, None]
    raw = bronze(
        spark,
        "crm_sales_details",
        [(f"SO{i}", "P", 1, d, d, d, 10, 2, 5) for i, d in enumerate(dates)],
    )
    out = silver.clean_sales(raw, BATCH_TS).orderBy("sls_ord_num").collect()
    for column in ("sls_order_dt", "sls_ship_dt", "sls_due_dt"):
        assert [r[column] for r in out] == [date(2010, 12, 29), None, None, None, None]


def test_demographics(spark):
    as_of = date(2026, 1, 1)
    raw = bronze(
        spark,
        "erp_cust_az12",
        [
            ("NASAW01", date(2026, 1, 2), "M"),
            ("AW02", as_of, " male "),
            ("nasAW03", None, "FEMALE"),
            ("NASAW04", date(1980, 1, 1), "x"),
            ("AW05", date(1980, 1, 1), None),
            ("AW06", date(1980, 1, 1), "f\r"),
        ],
    )
    out = silver.clean_demographics(raw, BATCH_TS, as_of).drop(AUDIT_COLUMN).collect()
    assert {tuple(r) for r in out} == {
        ("AW01", None, "Male"),
        ("AW02", as_of, "Male"),
        ("nasAW03", None, "Female"),
        ("AW04", date(1980, 1, 1), "n/a"),
        ("AW05", date(1980, 1, 1), "n/a"),
        ("AW06", date(1980, 1, 1), "Female"),
    }


def test_locations(spark, rows_of):
    countries = ["DE", " US ", "USA", "usa", "", " \t", None, "France"]
    raw = bronze(
        spark, "erp_loc_a101", [(f" AW-0{i} ", c) for i, c in enumerate(countries)] + [("AW00", "DE ")]
    )
    assert rows_of(silver.clean_locations(raw, BATCH_TS), "cid", "cntry") == [
        ("AW00", "Germany"),
        ("AW01", "United States"),
        ("AW02", "United States"),
        ("AW03", "usa"),
        ("AW04", "n/a"),
        ("AW05", "n/a"),
        ("AW06", "n/a"),
        ("AW07", "France"),
    ]


def test_categories(spark, rows_of):
    raw = bronze(spark, "erp_px_cat_g1v2", [(" AC_BR", " Bikes ", "Racks\t", "Yes\r")])
    assert rows_of(silver.clean_categories(raw, BATCH_TS).drop(AUDIT_COLUMN)) == [
        (" AC_BR", "Bikes", "Racks", "Yes")
    ]


CLEANERS = {
    "crm_cust_info": silver.clean_customers,
    "crm_prd_info": silver.clean_products,
    "crm_sales_details": silver.clean_sales,
    "erp_cust_az12": silver.clean_demographics,
    "erp_loc_a101": silver.clean_locations,
    "erp_px_cat_g1v2": silver.clean_categories,
}


@pytest.mark.parametrize("table", CLEANERS)
def test_silver_contract(spark, table):
    out = CLEANERS[table](bronze(spark, table, []), BATCH_TS)
    assert [(f.name, f.dataType) for f in out.drop(AUDIT_COLUMN).schema] == [
        (f.name, f.dataType) for f in SILVER[table]
    ]
    assert out.columns[-1] == AUDIT_COLUMN
    assert out.count() == 0


@pytest.mark.parametrize("table", ["crm_sales_details", "erp_cust_az12", "erp_px_cat_g1v2"])
def test_projection_only_cleaners_do_not_shuffle(spark, table):
    plan = CLEANERS[table](bronze(spark, table, []))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    assert "Python" not in plan.toString()
