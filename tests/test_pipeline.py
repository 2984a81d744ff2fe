from __future__ import annotations

from conftest import BATCH_TS

from sluiceway.operators import release_scratch
from sluiceway.plans import pipeline, views
from sluiceway.schemas import SOURCE_FILES
from sluiceway.sources.bronze import FileSource

FILES = {
    "crm_cust_info": """cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date
11,AW11, Jon ,Yang,M,M,2025-10-06
11,AW11,Jon,Young,S,M,2025-10-07
12,AW12,Eve,Huang,S,,2025-10-06
,AW13,None,None,S,F,2025-10-06
""",
    "crm_prd_info": """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
1,AC-HE-HL,Helmet,12,S ,2011-07-01,2007-12-28
2,AC-HE-HL,Helmet,14,S ,2012-07-01,
3,CO-PE-PD,Pedal,,R ,2013-07-01,
""",
    "crm_sales_details": """sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price
SO1,HL,11,20101229,20110105,20110110,,2,14
SO2,PD,12,0,20110105,20110110,10,1,-10
SO3,??,12,20101229,20110105,20110110,5,1,5
""",
    "erp_cust_az12": "CID,BDATE,GEN\nNASAW11,1971-10-06,Male\nAW12,2999-01-01,F\n",
    "erp_loc_a101": "CID,CNTRY\nAW-11,DE\nAW-12,\nAW-12,\n",
    "erp_px_cat_g1v2": "ID,CAT,SUBCAT,MAINTENANCE\nAC_HE,Accessories,Helmets,Yes\n",
}


def source(root):
    for table, text in FILES.items():
        path = root / SOURCE_FILES[table]
        path.parent.mkdir(exist_ok=True, parents=True)
        path.write_text(text)
    return FileSource(str(root))


def test_run_all_twice(spark, tmp_path, rows_of):
    lake = pipeline.Lake.open(spark, str(tmp_path / "lake"), "shop", BATCH_TS)
    extracts = source(tmp_path / "in")
    for _ in range(2):
        report = pipeline.run_all(lake, extracts)

    failed = {(r.table_name, r.test, r.column_name, r.failures) for r in report.collect() if not r.passed}
    assert failed == {("fact_sales", "not_null", "product_key", 1)}

    assert rows_of(spark.table("dim_customer"), "customer_key", "last_name", "country", "gender") == [
        (0, "Young", "Germany", "Male"),
        (1, "Huang", "n/a", "Female"),
    ]
    assert rows_of(spark.table("fact_sales"), "order_number", "product_key", "sales_amount", "price") == [
        ("SO1", 0, 28.0, 14.0),
        ("SO2", 1, 10.0, 10.0),
        ("SO3", None, 5.0, 5.0),
    ]
    stamped = lake.read("silver", "silver_crm_cust_info").select("dwh_create_date").distinct()
    assert [r[0] for r in stamped.collect()] == [BATCH_TS]
    assert "dwh_create_date" not in lake.read("warehouse", "fact_sales").columns

    metrics = lake.read("metrics", "run_metrics")
    assert metrics.count() == 2 * (6 + 6 + 3 + 3)
    records = {r.table_name: r.records for r in metrics.collect()}
    assert records["crm_cust_info"] == 4
    assert records["silver_crm_cust_info"] == 2
    assert records["gold_fact_sales"] == records["fact_sales"] == 3


def test_checked_source_lands_rejects_and_counts_them(spark, tmp_path, rows_of):
    lake = pipeline.Lake.open(spark, str(tmp_path / "lake"), "shop", BATCH_TS)
    extracts = source(tmp_path / "in")
    loc = tmp_path / "in" / SOURCE_FILES["erp_loc_a101"]
    loc.write_text(loc.read_text() + "AW-13\nAW-14,DE,more\n")
    metrics = pipeline.load_bronze(lake, FileSource(extracts.root, checked=True))
    records = {m["table_name"]: m["records"] for m in metrics}
    assert records["erp_loc_a101"] == 3 and records["erp_loc_a101_rejects"] == 2
    assert len(records) == 7
    assert rows_of(lake.read("bronze", "erp_loc_a101_rejects"), "reason", "record") == [
        ("fields", "AW-13"), ("fields", "AW-14,DE,more")
    ]


def test_catalog_views_outlive_the_session_and_its_scratch(spark, tmp_path, rows_of):
    lake = pipeline.Lake.open(spark, str(tmp_path / "lake"), "shop", BATCH_TS)
    pipeline.load_bronze(lake, source(tmp_path / "in"))
    pipeline.load_silver(lake)
    for _ in range(2):
        pipeline.create_gold_views(lake, "shop_gold")
        release_scratch(spark)
        other = spark.newSession()
        assert rows_of(other.table("shop_gold.fact_sales"), "order_number", "customer_key") == [
            ("SO1", 1), ("SO2", 2), ("SO3", 2)
        ]
        assert other.table("shop_gold.dim_products").count() == 2


def test_warehouse_with_declared_columns_only(spark, tmp_path):
    lake = pipeline.Lake.open(spark, str(tmp_path / "lake"), "shop", BATCH_TS)
    pipeline.run_all(lake, source(tmp_path / "in"))
    pipeline.load_warehouse(lake, columns={"dim_customer": ["customer_key", "country"]})
    assert lake.read("warehouse", "dim_customer").columns == ["customer_key", "country"]
    assert len(lake.read("warehouse", "dim_product").columns) > 5


def test_catalog_fact_view_does_not_build_large_key_tables_in_the_driver(spark, tmp_path):
    """Key tables whose counted rows exceed the broadcast limit are merged, small ones are not."""
    database, limit = "large_keys", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/keys'")
    spark.range(20_000).selectExpr(
        "CAST(id DIV 400 AS STRING) AS product_number", "id DIV 400 AS product_key"
    ).write.saveAsTable(f"{database}.products_keyed")
    spark.range(5).selectExpr("id AS customer_id", "id AS customer_key").write.saveAsTable(
        f"{database}.customers_keyed"
    )
    try:
        spark.conf.set(limit, "100k")
        assert views._lookup_hint(spark, database) == "/*+ MERGE(p) */ "
        spark.conf.set(limit, "-1")
        assert views._lookup_hint(spark, database) == "/*+ MERGE(p, c) */ "
        spark.conf.set(limit, "100m")
        assert views._lookup_hint(spark, database) == ""
    finally:
        spark.conf.set(limit, before)
        spark.sql(f"DROP DATABASE {database} CASCADE")
