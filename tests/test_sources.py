from __future__ import annotations

from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from sluiceway.schemas import BRONZE, SOURCE_FILES, WAREHOUSE, sql_columns
from sluiceway.plans.concurrent import together
from sluiceway.sources import catalog, jdbc, lake, storage
from sluiceway.sources.bronze import (
    LOADERS,
    TABLES,
    DatabaseSource,
    FileSource,
    bronze_loader,
    declared,
)
from sluiceway.sources.files import read_checked, read_delimited

PRODUCT_FILE = (
    'ID,"any, header",NM,COST,LINE,START,END\r\n'
    '210,CO-RF-FR-R92B-58,"Frame, ""58""",,R ,2003-07-01,\r\n'
    "x,AC-HE, padded ,12,\\N,2011-07-01 10:30:00,not a date\r\n"
)


def test_delimited_file(spark, tmp_path):
    (tmp_path / "prd.csv").write_bytes(PRODUCT_FILE.encode())
    df = read_delimited(spark, str(tmp_path / "prd.csv"), BRONZE["crm_prd_info"])
    assert df.schema == BRONZE["crm_prd_info"]
    assert [tuple(r) for r in df.orderBy(F.col("prd_id").asc_nulls_last()).collect()] == [
        (210, "CO-RF-FR-R92B-58", 'Frame, "58"', None, "R ", datetime(2003, 7, 1), None),
        (None, "AC-HE", " padded ", 12, None, datetime(2011, 7, 1, 10, 30), None),
    ]


def test_carriage_return_does_not_stay_in_the_last_column(spark, tmp_path):
    (tmp_path / "cat.csv").write_bytes(b"ID,CAT,SUBCAT,MAINTENANCE\r\nAC_BR,Bikes,Racks,Yes\r\n")
    df = read_delimited(spark, str(tmp_path / "cat.csv"), BRONZE["erp_px_cat_g1v2"])
    assert [tuple(r) for r in df.collect()] == [("AC_BR", "Bikes", "Racks", "Yes")]


def test_only_the_needed_columns_are_read(spark, tmp_path):
    (tmp_path / "prd.csv").write_bytes(PRODUCT_FILE.encode())
    df = read_delimited(spark, str(tmp_path / "prd.csv"), BRONZE["crm_prd_info"])
    plan = df.select("prd_nm")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<prd_nm:string>" in plan


def test_one_loader_per_source_table(spark, tmp_path):
    assert set(LOADERS) == set(TABLES) == set(SOURCE_FILES)
    path = tmp_path / SOURCE_FILES["erp_loc_a101"]
    path.parent.mkdir()
    path.write_text("CID,CNTRY\nAW-1,DE\n")
    out = LOADERS["erp_loc_a101"](spark, FileSource(str(tmp_path)))
    assert [tuple(r) for r in out.collect()] == [("AW-1", "DE")]
    with pytest.raises(KeyError):
        bronze_loader("crm_unknown")


def test_lake_path():
    assert lake.lake_path("s3a://b/", "shop", "silver", "shop_sales") == "s3a://b/shop/silver/sales.pq"
    assert lake.lake_path("/l", "shop", "gold", "dim_x") == "/l/shop/gold/dim_x.pq"


def test_lake_write_replaces_and_may_read_itself(spark, tmp_path, rows_of):
    path = str(tmp_path / "shop" / "silver" / "t.pq")
    lake.write_table(spark.range(5), path)
    lake.write_table(lake.read_table(spark, path).where("id > 1"), path)
    assert rows_of(lake.read_table(spark, path)) == [(2,), (3,), (4,)]
    assert [p.name for p in (tmp_path / "shop" / "silver").iterdir()] == ["t.pq"]


def test_failed_lake_write_keeps_the_old_table(spark, tmp_path, rows_of):
    path = str(tmp_path / "t.pq")
    lake.write_table(spark.range(2), path)
    with pytest.raises(Exception, match="(?i)broken"):
        lake.write_table(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert rows_of(lake.read_table(spark, path)) == [(0,), (1,)]


def test_a_write_killed_before_its_pointer_leaves_the_old_table(
    spark, tmp_path, rows_of, monkeypatch
):
    path = str(tmp_path / "t.pq")
    lake.write_table(spark.range(2), path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(lake, "commit_snapshot", killed)
        with pytest.raises(KeyboardInterrupt):
            lake.write_table(spark.range(9), path)
    assert rows_of(lake.read_table(spark, path)) == [(0,), (1,)]
    # A pointer that was cut off in the middle does not count either.
    (tmp_path / "t.pq" / "_pointers" / "000000000002").write_text('{"snapshot": "snap')
    assert rows_of(lake.read_table(spark, path)) == [(0,), (1,)]
    lake.write_table(spark.range(3), path)
    assert rows_of(lake.read_table(spark, path)) == [(0,), (1,), (2,)]
    assert [s.number for s in lake.snapshots(spark, path)] == [3, 1]


def test_readers_of_a_replaced_version_are_not_disturbed(spark, tmp_path, rows_of):
    path = str(tmp_path / "t.pq")
    first = lake.write_table(spark.range(2), path)
    reader = lake.read_table(spark, path)
    second = lake.write_table(spark.range(5), path)
    assert rows_of(reader) == [(0,), (1,)]
    assert rows_of(lake.read_table(spark, path, snapshot=first)) == [(0,), (1,)]
    assert (second.files, second.bytes) == (
        len(list((tmp_path / "t.pq").glob(f"{second.folder.rsplit('/')[-1]}/*.parquet"))),
        sum(p.stat().st_size for p in (tmp_path / "t.pq").glob(f"{second.folder.rsplit('/')[-1]}/*.parquet")),
    )
    lake.write_table(spark.range(1), path, keep=timedelta(0))
    assert [s.number for s in lake.snapshots(spark, path)] == [3]
    assert len(list((tmp_path / "t.pq").glob("snapshot-*"))) == 1


def test_two_writers_at_once_leave_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t.pq")
    together(spark, [lambda n=n: lake.write_table(spark.range(n), path) for n in (3, 5, 7)])
    found = lake.snapshots(spark, path)
    assert [s.number for s in found] == [3, 2, 1]
    sizes = {lake.read_table(spark, path, snapshot=s).count() for s in found}
    assert sizes == {3, 5, 7}


def test_only_one_writer_gets_a_pointer(spark, tmp_path):
    storage.create_file(spark, str(tmp_path / "p"), "one")
    with pytest.raises(storage.FileTaken):
        storage.create_file(spark, str(tmp_path / "p"), "two")
    assert storage.read_file(spark, str(tmp_path / "p")) == "one"
    assert storage.list_files(spark, str(tmp_path / "nothing")) == []


def test_nulls_stay_null_in_the_lake(spark, tmp_path):
    path = str(tmp_path / "t.pq")
    lake.write_table(spark.sql("SELECT CAST(NULL AS STRING) AS a"), path)
    assert lake.read_table(spark, path).first().a is None


def test_declared_columns_only(spark, tmp_path):
    path = str(tmp_path / "t.pq")
    lake.write_table(spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c"), path, ["c", "a"])
    assert lake.read_table(spark, path).columns == ["c", "a"]


def test_time_windows(spark, tmp_path, rows_of):
    path = str(tmp_path / "w.pq")
    january = (datetime(2020, 1, 1), datetime(2020, 2, 1))
    february = (datetime(2020, 2, 1), datetime(2020, 3, 1))
    assert lake.window_id(*january) == "20200101000000_20200201000000"
    lake.write_window(spark.range(3), path, *january)
    lake.write_window(spark.range(10, 12), path, *february)
    lake.write_window(spark.range(7, 8), path, *january)
    assert rows_of(lake.read_windows(spark, path), "id") == [(10,), (11,), (7,)]
    both = [lambda w=w, n=n: lake.write_window(spark.range(n), path, *w)
            for w, n in ((january, 2), (february, 4))]
    together(spark, both)
    assert lake.read_windows(spark, path).count() == 6
    lake.write_window(spark.range(10, 12), path, *february)
    chosen = lake.read_windows(spark, path, [february])
    assert rows_of(chosen, "id") == [(10,), (11,)]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_catalog_tables(spark, rows_of):
    catalog.create_tables(spark, "shop_wh", WAREHOUSE)
    catalog.create_tables(spark, "shop_wh", WAREHOUSE)
    assert spark.table("shop_wh.dim_customer").columns == WAREHOUSE["dim_customer"].names
    row = (1, "7", "AW7", "a", "b", "c", "d", "e", date(2020, 1, 1), None)
    df = spark.createDataFrame([row], WAREHOUSE["dim_customer"])
    for _ in range(2):
        catalog.refresh_catalog_table(df, "shop_wh", "dim_customer")
    assert rows_of(spark.table("shop_wh.dim_customer")) == [row]


def test_a_failed_refresh_leaves_the_old_rows(spark, rows_of):
    contract = {"t": BRONZE["erp_loc_a101"]}
    catalog.create_tables(spark, "refresh_wh", contract)
    old = spark.createDataFrame([("a", "b")], BRONZE["erp_loc_a101"])
    assert catalog.refresh_catalog_table(old, "refresh_wh", "t") == 1
    broken = old.withColumn("cid", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="(?i)broken"):
        catalog.refresh_catalog_table(broken, "refresh_wh", "t")
    assert rows_of(spark.table("refresh_wh.t")) == [("a", "b")]
    with pytest.raises(ValueError, match="cntry"):
        catalog.refresh_catalog_table(old.drop("cntry"), "refresh_wh", "t")


def test_a_refresh_may_read_the_table_and_keeps_one_generation(spark, rows_of, tmp_path):
    schema = BRONZE["erp_loc_a101"]
    place = f"file://{tmp_path}/generations.db"
    for _ in range(2):
        catalog.create_tables(spark, "generations_wh", {"t": schema}, place)
        for n in range(4):
            row = spark.createDataFrame([(str(n), None)], schema)
            before = spark.table("generations_wh.t")
            catalog.refresh_catalog_table(before.unionByName(row), "generations_wh", "t")
        assert rows_of(spark.table("generations_wh.t"), "cid") == [("0",), ("1",), ("2",), ("3",)]
        assert len(list((tmp_path / "generations.db").glob("t-generation-*"))) == 2
        assert spark.table("generations_wh.t").schema == schema


FAULTY_FILE = (
    b'ID,CAT,SUBCAT,MAINTENANCE\r\n'
    b'1,x,y,z\r\n2,x,y\r\n3,x,y,z,more\r\n4,x,y,"open\r\n5,"a ""q"", b",y,z\r\n6,,\\N,z\r\n'
)


def test_records_that_do_not_fit_are_set_aside_whole(spark, tmp_path, rows_of):
    (tmp_path / "f.csv").write_bytes(FAULTY_FILE)
    read = read_checked(spark, str(tmp_path / "f.csv"), BRONZE["erp_px_cat_g1v2"])
    assert rows_of(read.rows) == [
        ("1", "x", "y", "z"), ("5", 'a "q", b', "y", "z"), ("6", None, None, "z")
    ]
    assert read.rejected.get["rejected"] == 3
    assert rows_of(read.rejects, "reason", "record") == [
        ("fields", "2,x,y"), ("fields", "3,x,y,z,more"), ("quote", '4,x,y,"open')
    ]
    assert {r.file.rsplit("/")[-1] for r in read.rejects.collect()} == {"f.csv"}


def test_values_that_do_not_convert_are_named(spark, tmp_path, rows_of):
    (tmp_path / "prd.csv").write_bytes(PRODUCT_FILE.encode())
    read = read_checked(spark, str(tmp_path / "prd.csv"), BRONZE["crm_prd_info"])
    assert read.rows.schema == BRONZE["crm_prd_info"]
    assert [r.prd_id for r in read.rows.collect()] == [210]
    assert rows_of(read.rejects, "reason", "record") == [
        ("value: prd_id, prd_end_dt", PRODUCT_FILE.split("\r\n")[2])
    ]


def test_the_rejects_cut_each_line_once(spark, tmp_path):
    (tmp_path / "prd.csv").write_bytes(PRODUCT_FILE.encode())
    read = read_checked(spark, str(tmp_path / "prd.csv"), BRONZE["crm_prd_info"])
    for frame in (read.rows, read.rejects):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv(") == 1


def test_line_ends_within_values(spark, tmp_path, rows_of):
    text = b'ID,CAT,SUBCAT,MAINTENANCE\n1,"two\nlines","Yes\r",z\n2,x\n'
    (tmp_path / "f.csv").write_bytes(text)
    schema = BRONZE["erp_px_cat_g1v2"]
    read = read_checked(spark, str(tmp_path / "f.csv"), schema, multi_line=True)
    assert rows_of(read.rows) == [("1", "two\nlines", "Yes\r", "z")]
    assert rows_of(read.rejects, "reason", "record") == [("fields", "2,x")]
    lenient = read_delimited(spark, str(tmp_path / "f.csv"), schema, multi_line=True)
    assert rows_of(lenient) == [("1", "two\nlines", "Yes\r", "z"), ("2", "x", None, None)]


def test_a_source_that_lost_a_column_is_an_error(spark):
    df = spark.createDataFrame([("1", "x")], "cid string, country string")
    with pytest.raises(ValueError, match=r"missing columns \['cntry'\].*\['country'\]"):
        declared(df, "erp_loc_a101")


def test_ddl_columns():
    assert sql_columns(BRONZE["erp_cust_az12"]) == "cid VARCHAR(50), bdate DATE, gen VARCHAR(50)"


DB = jdbc.Database("jdbc:postgresql://db/shop", "etl", "secret", extra={"ssl": "true"})


def test_database_hides_its_password():
    assert "secret" not in repr(DB)
    assert DB.options() == {
        "url": "jdbc:postgresql://db/shop", "user": "etl", "password": "secret", "ssl": "true"
    }


def test_jdbc_read_options():
    assert jdbc.query_options(DB, "SELECT * FROM t")["query"] == "SELECT * FROM t"
    assert "dbtable" not in jdbc.query_options(DB, "SELECT * FROM t")
    sliced = jdbc.table_options(DB, "t", jdbc.Slices("id", 0, 1000, 16))
    assert {k: sliced[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "16"
    }
    assert "partitionColumn" not in jdbc.table_options(DB, "t")


def test_jdbc_write_options(spark):
    refresh = jdbc.refresh_options(DB, "warehouse.dim_customer")
    assert (refresh["truncate"], refresh["batchsize"]) == ("true", "10000")
    df = spark.createDataFrame([], WAREHOUSE["dim_customer"]).select("customer_key", "country")
    replace = jdbc.replace_options(DB, "warehouse.dim_customer", df)
    assert replace["truncate"] == "false"
    assert replace["createTableColumnTypes"] == "country VARCHAR(50)"
    assert "createTableColumnTypes" not in jdbc.replace_options(DB, "t", df.select("customer_key"))


def test_depth_slices_read_every_row_once_and_evenly():
    """The histogram and the conditions are plain SQL, so another engine can judge them."""
    con = duckdb.connect()
    con.execute("""CREATE TABLE t AS SELECT CASE WHEN i % 3 = 0 THEN 7 WHEN i % 50 = 1 THEN NULL
                   ELSE i * i % 9973 END AS k, i FROM range(9000) r(i)""")
    lows = [r[1] for r in con.execute(jdbc.histogram_query("t", "k", 12)).fetchall()]
    conditions = jdbc.depth_predicates("k", lows)
    reads = [con.execute(f"SELECT i FROM t WHERE {c}").fetchall() for c in conditions]
    assert sorted(i for rows in reads for (i,) in rows) == list(range(9000))
    # The value 7 fills a third of the table and cannot be parted.
    sizes = sorted(len(rows) for rows in reads)
    assert len(sizes) >= 8 and sizes[-1] < 3000 + 2 * 750 and sizes[-2] <= 1000


def test_depth_slices_of_other_types():
    assert jdbc.depth_predicates("c", []) == jdbc.depth_predicates("c", ["a", "a"]) == ["1 = 1"]
    assert jdbc.depth_predicates("d", [date(2020, 1, 2), date(2020, 1, 1)]) == [
        "d < DATE '2020-01-02' OR d IS NULL", "d >= DATE '2020-01-02'"
    ]
    assert jdbc.depth_predicates("c", ["a", "o'b", "z"])[1] == "c >= 'o''b' AND c < 'z'"
    assert jdbc.literal(datetime(2020, 1, 2, 3)) == "TIMESTAMP '2020-01-02 03:00:00'"


def test_database_source_reads_whole_tables(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(jdbc, "read_query", lambda s, db, q: asked.append(q) or fake(s))
    monkeypatch.setattr(
        jdbc, "read_table", lambda s, db, t, slices: asked.append((t, slices.column)) or fake(s)
    )

    def fake(session):
        return session.createDataFrame([("1", "DE")], "cid string, cntry string")

    load = LOADERS["erp_loc_a101"]
    assert load(spark, DatabaseSource(DB)).schema == BRONZE["erp_loc_a101"]
    load(spark, DatabaseSource(DB, {"erp_loc_a101": jdbc.Slices("cid", "a", "b", 2)}))
    assert asked == ["SELECT * FROM erp_loc_a101", ("erp_loc_a101", "cid")]
