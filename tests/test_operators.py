from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import dense_key, keep_latest, left_join, next_in_key, row_key, stage
from sluiceway.operators import versions as versions_module
from sluiceway.operators.skew import heavy_keys
from sluiceway.operators.staging import scratch_dir
from verification import source_shapes


def explained(df) -> str:
    return df._jdf.queryExecution().toString()


def test_keep_latest_row_mode(spark, rows_of):
    df = spark.createDataFrame(
        [
            (1, date(2020, 1, 1), "old", "x"),
            (1, date(2020, 1, 3), None, "y"),
            (2, None, "undated", "x"),
            (2, date(2020, 1, 2), "dated", None),
            (3, date(2020, 1, 1), "a", "z"),
            (3, date(2020, 1, 1), "b", "a"),
        ],
        "id int, d date, name string, tag string",
    )
    assert rows_of(keep_latest(df, "id", "d")) == [
        (1, date(2020, 1, 3), None, "y"),
        (2, date(2020, 1, 2), "dated", None),
        (3, date(2020, 1, 1), "b", "a"),
    ]


def test_keep_latest_coalesce_mode(spark, rows_of):
    df = spark.createDataFrame(
        [
            (1, "Ann", None, date(2020, 1, 1)),
            (1, None, "y", date(2020, 1, 3)),
            (2, None, None, None),
        ],
        "id int, name string, tag string, d date",
    )
    assert rows_of(keep_latest(df, "id", "d", "coalesce")) == [
        (1, "Ann", "y", date(2020, 1, 3)),
        (2, None, None, None),
    ]
    with pytest.raises(ValueError):
        keep_latest(df, "id", "d", "newest")


def test_keep_latest_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, date(2020, 1, 1), "a")], "id int, d date, name string")
    assert "partial_max" in explained(keep_latest(df, "id", "d"))


def ranked(values, base):
    order = sorted({(v is None, v or 0) for v in values})
    return {v: order.index((v is None, v or 0)) + base for v in values}


@pytest.mark.parametrize("base", [0, 1])
def test_dense_key_with_nulls_and_repeats(spark, base):
    values = [random.Random(3).randrange(200) for _ in range(500)] + [None, None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    out = dense_key(df.repartition(7), ["v"], "k", base=base)
    assert out.columns == ["k", "v", "i"]
    got = out.collect()
    assert len(got) == len(values)
    expected = ranked(values, base)
    assert all(r.k == expected[r.v] for r in got)


def test_dense_key_leaves_null_unkeyed_when_asked(spark, rows_of):
    df = spark.createDataFrame([(30,), (10,), (None,), (20,)], "v int")
    assert rows_of(dense_key(df, ["v"], "k", null_safe=False)) == [
        (0, 10), (1, 20), (2, 30), (None, None)
    ]


def test_dense_key_on_two_columns(spark, rows_of):
    df = spark.createDataFrame(
        [(date(2020, 1, 2), "a"), (date(2020, 1, 1), "b"), (date(2020, 1, 1), "a"), (None, "a")],
        "d date, s string",
    )
    assert [(r[0], r[2]) for r in rows_of(dense_key(df, ["d", "s"], "k"))] == [
        (0, "a"), (1, "b"), (2, "a"), (3, "a")
    ]


def test_row_key_is_a_permutation_in_order_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).select((F.col("id") * 7919 % 500).alias("v"), F.lit("c").alias("w"))
        out = row_key(df, ["v"], "k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.k for r in out) == list(range(1, 2001))
    in_order = [r.v for r in sorted(out, key=lambda r: r.k)]
    assert in_order == sorted(in_order)


def test_row_key_spreads_exact_copies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = spark.range(1000).select(F.lit(1).alias("v"))
        out = row_key(copies, ["v"], "k")
        assert sorted(r.k for r in out.collect()) == list(range(1, 1001))
        files = [r[0] for r in out.groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 1


def test_keys_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "v int, w string")
    assert row_key(empty, ["v"], "k").collect() == []
    assert dense_key(empty, ["v"], "k").collect() == []


def test_keys_need_no_single_task_window(spark):
    plan = explained(row_key(spark.range(10), ["id"], "k"))
    assert "Window" not in plan
    assert "SinglePartition" not in plan


def test_no_random_value_decides_where_a_row_is_sent(spark):
    """A retried task would draw other values than the first attempt did."""
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    plans = [
        explained(next_in_key(rows, "k", ["v"], "v", "n", partitions)) for partitions in (None, 3)
    ] + [explained(left_join(rows, rows.toDF("rk", "rv"), "k", "rk", 1))]
    for plan in plans:
        assert "rand(" not in plan
        assert "monotonically_increasing_id" not in plan


def versions(n=400, keys=5, seed=1):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["hot", "hot", *"abcd"[:keys]]), rng.choice([None, *range(40)]), i)
        for i in range(n)
    ]
    return rows + [(None, 1, n), (None, 2, n + 1)]


def leads(rows):
    groups: dict = {}
    for key, start, i in rows:
        groups.setdefault(key, []).append((start is None, start or 0, i, start))
    out = {}
    for key, members in groups.items():
        members.sort()
        for here, there in zip(members, [*members[1:], None]):
            out[here[2]] = None if key is None or there is None else there[3]
    return out


@pytest.mark.parametrize("partitions", [None, 1, 7, 300], ids=["chosen", "one", "some", "many"])
@pytest.mark.parametrize("batch", ["10000", "3"])
def test_next_in_key(spark, partitions, batch):
    rows = versions()
    df = spark.createDataFrame(rows, "key string, start int, i int").repartition(5)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        out = next_in_key(df, "key", ["start", "i"], "start", "following", partitions)
    finally:
        spark.conf.set(name, before)
    got = {r.i: r.following for r in out.collect()}
    assert out.count() == len(rows)
    assert got == leads(rows)


def test_next_in_key_with_exact_copies_of_a_hot_row(spark):
    rows = [("hot", 1, "x")] * 50 + [("hot", 2, "x")]
    df = spark.createDataFrame(rows, "key string, start int, tag string")
    for partitions in (None, 10):
        out = next_in_key(df, "key", ["start"], "start", "following", partitions)
        found = sorted((r.start, r.following or 0) for r in out.collect())
        assert found == [(1, 1)] * 49 + [(1, 2), (2, 0)]


def test_next_in_key_of_an_empty_table(spark):
    df = spark.createDataFrame([], "key string, start int")
    out = next_in_key(df, "key", ["start"], "start", "following")
    assert out.columns == ["key", "start", "following"] and out.count() == 0


def test_a_key_with_a_third_of_all_rows_is_spread(spark, monkeypatch):
    """One range exchange before the shift, and the hot key lies on several of its tasks."""
    plans, staged = [], versions_module.stage

    def kept(df, label):
        plans.append(df)
        return staged(df, label)

    monkeypatch.setattr(versions_module, "stage", kept)
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 40) END AS key", "id AS start"
    )
    next_in_key(rows, "key", ["start"], "start", "following", 12)
    (shifted,) = plans
    plan = explained(shifted).split("== Physical Plan ==")[1]
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    parts = shifted.where("key = 'hot'").select(F.shiftright("_id", 33).alias("part"))
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 500


def test_heavy_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 9, "k string")
    assert sorted(map(tuple, heavy_keys(df, "k", 1).collect())) == [("a", 5), ("b", 2)]
    assert [r.k for r in heavy_keys(df, "k", 2).collect()] == ["a"]
    assert heavy_keys(df, "k", 5) is None
    assert heavy_keys(df, "k") is None


def test_hot_keys_are_found_in_a_table_that_compresses_to_nothing(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("'hot' AS k", "0 AS v").coalesce(1)
    rows.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert [tuple(r) for r in heavy_keys(df, "k", 100_000).collect()] == [("hot", 200_000)]
    left = spark.createDataFrame([("hot",)], "lk string")
    assert "_salt" in explained(left_join(left, df, "lk", "k", 100_000))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        plan = explained(left_join(left, df, "lk", "k"))
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin" in plan


@pytest.fixture
def limit_of_100k(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "100k")
    yield
    spark.conf.set(name, before)


def test_growing_tables_are_not_built_in_the_driver(spark, tmp_path, limit_of_100k):
    """Files that compress to less than the broadcast limit, with many more bytes of rows."""
    keys = spark.range(0, 20_000, 1, 1)
    keys.selectExpr(
        "id DIV 4 AS o_orderkey", "1L AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
        "TIMESTAMP '1995-01-01' AS o_orderdate", "'1' AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(0, 20_000, 1, 1).selectExpr(
        "id DIV 4 AS l_orderkey", "1L AS l_partkey", "1 AS l_linenumber", "1D AS l_quantity",
        "1D AS l_extendedprice", "TIMESTAMP '1995-01-02' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    keys.selectExpr(
        "id DIV 4 AS c_custkey", "'n' AS c_name", "1 AS c_nationkey", "1D AS c_acctbal",
        "'m' AS c_mktsegment",
    ).write.parquet(f"{tmp_path}/customer.parquet")
    for shape in (source_shapes.crm_sales_details, source_shapes.crm_cust_info):
        plan = explained(shape(spark, str(tmp_path)))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    ranked_keys = spark.range(20_000).selectExpr("id DIV 2 AS v", "'x' AS w")
    plan = explained(dense_key(ranked_keys, ["v"], "k", null_safe=False))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_configure_leaves_the_broadcast_limit_alone(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"


@pytest.mark.parametrize("heavy_rows", [10**9, 5, 0], ids=["plain", "hot right", "all salted"])
def test_left_join_keeps_every_match_and_every_left_row(spark, heavy_rows):
    left = [("hot", i) for i in range(4)] + [("one", 10), ("none", 11), (None, 12)]
    right = [("hot", f"h{i}") for i in range(20)] + [("one", "o"), (None, "n"), ("other", "x")]
    out = left_join(
        spark.createDataFrame(left, "k string, i int"),
        spark.createDataFrame(right, "rk string, v string"),
        "k",
        "rk",
        heavy_rows,
    )
    expected = [(k, i, rk, v) for k, i in left for rk, v in right if k is not None and k == rk]
    expected += [(k, i, None, None) for k, i in left if k in ("none", None)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_stage_writes_below_the_shared_folder(spark, rows_of):
    staged = stage(spark.range(5), "five")
    assert rows_of(staged) == [(i,) for i in range(5)]
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or scratch_dir(spark).startswith(shared)
    assert all(scratch_dir(spark) in file for file in staged.inputFiles())
