from __future__ import annotations

import sys

import pytest

import __spark_entry__ as contract
from sluiceway.plans import gold, silver, views
from sluiceway.schemas import AUDIT_COLUMN
from verification import catalogue
from verification.oracle import statements
from verification.compare import compare, connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_its_expected_sql():
    assert set(catalogue.QUERIES) == set(statements())
    assert set(catalogue.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("missing", ["xxhash", "sluiceway.llm", "corpus_pipeline", "public_tokenizers"])
def test_queries_without_the_training_data_part(monkeypatch, missing):
    for module in [m for m in sys.modules if m.split(".")[0] == "corpus_pipeline" or "llm" in m]:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.delattr("sluiceway.llm", raising=False)
    monkeypatch.setitem(sys.modules, missing, None)
    with pytest.warns(UserWarning, match="without training-data queries"):
        assert set(contract.queries()) == set(catalogue.QUERIES)
    with pytest.warns(UserWarning, match="without training-data queries"):
        assert set(contract.oracle_sql()) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["order_number", "product_key", "customer_key"]
    assert df.count() > 0


@pytest.fixture
def silver_tables(spark):
    return {table: catalogue._silver(spark, SF_DIR, table) for table in catalogue.SHAPES}


def test_hot_key_paths_give_the_same_results(spark, con, silver_tables):
    """Every product and every partner counts as hot; results must not change."""
    raw = catalogue.SHAPES["crm_prd_info"](spark, SF_DIR)
    split = silver.clean_products(raw, catalogue.BATCH_TS, partitions=50)
    assert compare(con, "silver_products", split.drop(AUDIT_COLUMN)) == ""
    people = [silver_tables[t] for t in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")]
    dim = gold.build_dim_customer(*people, catalogue.BATCH_TS, heavy_rows=0)
    assert compare(con, "dim_customer", dim.drop(AUDIT_COLUMN)) == ""
    numbered = views.sql_dim_customers(*people, heavy_rows=0)
    assert compare(con, "view_dim_customers", numbered) == ""


def test_results_without_broadcast(spark, con):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        assert differences(spark, con, "fact_sales", SF_DIR) == ""
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
