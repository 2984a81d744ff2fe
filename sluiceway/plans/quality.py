"""Declared data tests and the report over them.

A test counts failing rows; zero means passed. Nulls fail ``NotNull`` only: they are
neither duplicates nor broken references.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class Relationship:
    column: str
    to: str
    field: str


Check = NotNull | Unique | Relationship

# The eleven tests declared on the typed views.
CHECKS: dict[str, tuple[Check, ...]] = {
    "dim_customer": (NotNull("customer_key"), Unique("customer_key"), NotNull("customer_id")),
    "dim_product": (NotNull("product_key"), Unique("product_key"), NotNull("product_id")),
    "fact_sales": (
        NotNull("order_number"),
        NotNull("product_key"),
        Relationship("product_key", "dim_product", "product_key"),
        NotNull("customer_key"),
        Relationship("customer_key", "dim_customer", "customer_key"),
    ),
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts."""
    return df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent, with their row counts.

    The child is counted per value before the join, so each task of the fact table
    sends one row per value and a hot key cannot fill a task.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_used")).count()
    known = parent.select(F.col(field).alias("_known"))
    return used.join(known, F.col("_used") == F.col("_known"), "left_anti").select(
        F.col("_used").alias(column), "count"
    )


def _candidates(
    df: DataFrame, table: str, declared: Sequence[Check], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Failures of all tests of one table, counted in one pass over it.

    The tested keys are counted per value by grouping sets, with map-side combine: one row per
    value and task is shuffled, whatever the table's size. The null counts ride along with the
    first key. Broken references are only candidates: ``parent`` and ``known`` say where the
    value has to be found.
    """
    keys = list(dict.fromkeys(c.column for c in declared if not isinstance(c, NotNull)))
    required = list(dict.fromkeys(c.column for c in declared if isinstance(c, NotNull)))
    key_of = {c: f"_key{i}" for i, c in enumerate(keys)}
    nulls_of = {c: f"_nulls{i}" for i, c in enumerate(required)}
    narrow = df.select(
        *[F.col(c).alias(name) for c, name in key_of.items()],
        *[F.col(c).isNull().alias(name) for c, name in nulls_of.items()],
    )
    figures = [
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(name).alias(name) for name in nulls_of.values()],
    ]
    names = list(key_of.values())
    if len(names) > 1:
        counted = narrow.groupingSets([[F.col(n)] for n in names], *map(F.col, names)).agg(
            *figures, *[(F.grouping(n) == 0).alias(f"{n}_on") for n in names]
        )
    else:
        counted = narrow.groupBy(*names).agg(*figures)
        counted = counted.withColumns({f"{n}_on": F.lit(True) for n in names})
    first = F.col(f"{names[0]}_on") if names else F.lit(True)

    found = []
    for check in declared:
        key = key_of.get(check.column)
        used = F.col(f"{key}_on") & F.col(key).isNotNull() if key else F.lit(False)
        parent = known = F.lit(None).cast("string")
        if isinstance(check, NotNull):
            test, failures = "not_null", F.when(first, F.col(nulls_of[check.column]))
        elif isinstance(check, Unique):
            test, failures = "unique", F.when(used & (F.col("_n") > 1), F.lit(1))
        else:
            test, failures = "relationships", F.when(used, F.col("_n"))
            parent = F.lit(f"{check.to}.{check.field}")
            # A value that its parent's type cannot hold has no parent.
            kind = tables[check.to].schema[check.field].dataType
            known = F.col(key).try_cast(kind).cast("string")
        found.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(test).alias("test"),
                F.lit(check.column).alias("column_name"),
                F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
                parent.alias("parent"),
                known.alias("known"),
            )
        )
    failing = F.filter(F.array(*found), lambda f: f["failures"] > 0)
    return counted.select(F.inline(failing))


def _test_name(check: Check) -> str:
    names = {NotNull: "not_null", Unique: "unique", Relationship: "relationships"}
    return names[type(check)]


def quality_report(
    tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]] = CHECKS
) -> DataFrame:
    """One row per test: (table_name, test, column_name, failures, passed).

    ``Unique`` counts values that occur more than once, the others rows. Every table is
    evaluated once, for all of its tests together, and once more in two narrow columns where
    other tables refer to it.
    """
    declared = [
        (table, _test_name(check), check.column) for table, group in checks.items() for check in group
    ]
    spark = next(iter(tables.values())).sparkSession
    report = spark.createDataFrame(declared, "table_name string, test string, column_name string")
    report = report.withColumn("failures", F.lit(0).cast("bigint"))
    for table, group in checks.items():
        if not group:
            continue
        failing = _candidates(tables[table], table, group, tables)
        parents = sorted({(c.to, c.field) for c in group if isinstance(c, Relationship)})
        if parents:
            values = [
                tables[to]
                .where(F.col(field).isNotNull())
                .select(
                    F.lit(f"{to}.{field}").alias("parent"),
                    F.col(field).cast("string").alias("known"),
                )
                for to, field in parents
            ]
            # Merged, not broadcast: they are already dealt by value, and grow with the parents.
            known = reduce(DataFrame.unionByName, values).distinct().hint("merge")
            failing = failing.join(known, ["parent", "known"], "left_anti")
        report = report.unionByName(failing.select(*report.columns))
    summed = report.groupBy("table_name", "test", "column_name").agg(
        F.sum("failures").alias("failures")
    )
    return summed.withColumn("passed", F.col("failures") == 0)
