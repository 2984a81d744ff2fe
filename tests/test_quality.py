from __future__ import annotations

import pytest

from sluiceway.plans import quality
from sluiceway.plans.metrics import append_metrics, table_metrics, write_measured
from sluiceway.sources.lake import write_table
from conftest import BATCH_TS


@pytest.fixture
def tables(spark):
    return {
        "dim_customer": spark.createDataFrame(
            [(0, "1"), (0, "2"), (1, None), (None, "4"), (None, "5")],
            "customer_key bigint, customer_id string",
        ),
        "dim_product": spark.createDataFrame([(0, 7)], "product_key bigint, product_id int"),
        "fact_sales": spark.createDataFrame(
            [("a", 0, 0), ("b", 5, 1), ("c", 5, None), (None, None, 8), ("e", 6, 0)],
            "order_number string, product_key bigint, customer_key bigint",
        ),
    }


def test_report(tables, rows_of):
    assert rows_of(quality.quality_report(tables)) == [
        ("dim_customer", "not_null", "customer_id", 1, False),
        ("dim_customer", "not_null", "customer_key", 2, False),
        ("dim_customer", "unique", "customer_key", 1, False),
        ("dim_product", "not_null", "product_id", 0, True),
        ("dim_product", "not_null", "product_key", 0, True),
        ("dim_product", "unique", "product_key", 0, True),
        ("fact_sales", "not_null", "customer_key", 1, False),
        ("fact_sales", "not_null", "order_number", 1, False),
        ("fact_sales", "not_null", "product_key", 1, False),
        ("fact_sales", "relationships", "customer_key", 1, False),
        ("fact_sales", "relationships", "product_key", 3, False),
    ]


def test_report_on_empty_tables(tables):
    report = quality.quality_report({name: df.limit(0) for name, df in tables.items()})
    assert report.count() == 11
    assert report.where("NOT passed").count() == 0


def test_failing_values_can_be_listed(tables, rows_of):
    assert rows_of(quality.duplicates(tables["dim_customer"], "customer_key")) == [(0, 2)]
    orphans = quality.orphans(
        tables["fact_sales"], "product_key", tables["dim_product"], "product_key"
    )
    assert rows_of(orphans) == [(5, 2), (6, 1)]


def test_every_table_is_evaluated_once_for_its_own_tests(spark, tables, tmp_path):
    written = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        written[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = quality.quality_report(written)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [order_number") == 1
    # Once for its own tests, once as the parent of the fact's keys.
    assert plan.count("Relation [customer_key") == 2


def test_references_between_types(spark, rows_of):
    child = spark.createDataFrame([(1,), (2**40,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    checks = {"child": (quality.Relationship("k", "parent", "id"), quality.Unique("k"))}
    report = quality.quality_report({"child": child, "parent": parent}, checks)
    assert rows_of(report) == [
        ("child", "relationships", "k", 1, False), ("child", "unique", "k", 0, True)
    ]


def test_the_fact_is_counted_before_the_reference_join(tables):
    plan = quality.orphans(
        tables["fact_sales"], "product_key", tables["dim_product"], "product_key"
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate")


def test_write_measured_counts_in_the_same_pass(spark, tmp_path):
    path = str(tmp_path / "t.pq")
    metric = write_measured(spark.range(7), "t", lambda df: write_table(df, path))
    assert metric == {"table_name": "t", "records": 7, "column_dtypes": {"id": "bigint"}}
    append_metrics(spark, str(tmp_path / "m.pq"), [metric], BATCH_TS)
    append_metrics(spark, str(tmp_path / "m.pq"), [metric], BATCH_TS)
    stored = spark.read.parquet(str(tmp_path / "m.pq")).collect()
    assert [(r.table_name, r.records, r.column_dtypes) for r in stored] == [
        ("t", 7, {"id": "bigint"})
    ] * 2


def test_table_metrics(spark, rows_of):
    out = table_metrics({"a": spark.range(3), "b": spark.range(0)})
    assert rows_of(out) == [("a", 3, "id:bigint"), ("b", 0, "id:bigint")]


def test_referenced_keys_are_not_built_in_the_driver(spark):
    """The parents' keys grow; by the bytes the planner expects they would be broadcast."""
    child = spark.range(50).selectExpr("id AS k", "id % 40 AS p")
    parent = spark.range(30).selectExpr("id AS p")
    checks = {"child": (quality.Relationship("p", "parent", "p"),)}
    report = quality.quality_report({"child": child, "parent": parent}, checks)
    assert [r.failures for r in report.collect()] == [10]
    plan = report._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "LeftAnti" in plan and "BroadcastHashJoin" not in plan
