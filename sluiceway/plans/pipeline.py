"""Layer runs: each reads one layer, writes the next and records its metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators import Scratch
from sluiceway.plans import gold, quality, silver, views
from sluiceway.plans.concurrent import together
from sluiceway.plans.metrics import append_metrics, write_measured
from sluiceway.plans.warehouse import LOADS
from sluiceway.session import configure
from sluiceway.sources import jdbc
from sluiceway.sources.bronze import LOADERS, FileSource, Source, declared
from sluiceway.sources.lake import lake_path, read_table, write_table


@dataclass(frozen=True)
class Lake:
    """Where the layers live, and the clock of this run.

    ``batch_ts`` stamps every row of the run; birth dates after it are dropped.
    """

    spark: SparkSession
    root: str
    database: str
    batch_ts: datetime

    @classmethod
    def open(
        cls, spark: SparkSession, root: str, database: str, batch_ts: datetime | None = None
    ) -> Lake:
        return cls(configure(spark), root, database, batch_ts or datetime.now(UTC))

    def path(self, layer: str, table: str) -> str:
        return lake_path(self.root, self.database, layer, table)

    def read(self, layer: str, table: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, table))

    def write(self, layer: str, table: str, df: DataFrame) -> dict:
        return write_measured(df, table, lambda out: write_table(out, self.path(layer, table)))

    def record(self, metrics: list[dict]) -> list[dict]:
        append_metrics(self.spark, self.path("metrics", "run_metrics"), metrics, self.batch_ts)
        return metrics


SILVER_PREFIX, GOLD_PREFIX = "silver_", "gold_"


REJECTED_SUFFIX = "_rejects"


def _land(lake: Lake, source: Source, table: str) -> list[dict]:
    """Write one source table, and its rejects where the source is checked and has any."""
    if not (isinstance(source, FileSource) and source.checked):
        return [lake.write("bronze", table, LOADERS[table](lake.spark, source))]
    read = source.read_checked(lake.spark, table)
    metrics = [lake.write("bronze", table, declared(read.rows, table))]
    if read.rejected.get["rejected"]:
        metrics.append(lake.write("bronze", table + REJECTED_SUFFIX, read.rejects))
    return metrics


def load_bronze(lake: Lake, source: Source) -> list[dict]:
    """Land the six source tables as they are; rejects of a checked source beside them."""
    landed = together(
        lake.spark, [lambda t=table: _land(lake, source, t) for table in LOADERS]
    )
    return lake.record([metric for metrics in landed for metric in metrics])


def load_silver(lake: Lake) -> list[dict]:
    """Clean every bronze table."""
    ts = lake.batch_ts
    cleaners: dict[str, Callable[[DataFrame], DataFrame]] = {
        "crm_cust_info": lambda df: silver.clean_customers(df, ts),
        "crm_prd_info": lambda df: silver.clean_products(df, ts),
        "crm_sales_details": lambda df: silver.clean_sales(df, ts),
        "erp_cust_az12": lambda df: silver.clean_demographics(df, ts, as_of=ts),
        "erp_loc_a101": lambda df: silver.clean_locations(df, ts),
        "erp_px_cat_g1v2": lambda df: silver.clean_categories(df, ts),
    }
    return lake.record(
        together(
            lake.spark,
            [
                lambda t=table, clean=clean: lake.write(
                    "silver", SILVER_PREFIX + t, clean(lake.read("bronze", t))
                )
                for table, clean in cleaners.items()
            ],
        )
    )


def silver_tables(lake: Lake) -> dict[str, DataFrame]:
    return {table: lake.read("silver", SILVER_PREFIX + table) for table in LOADERS}


def load_gold(lake: Lake) -> list[dict]:
    """Build the dimensions, write them, then build the fact from the written tables.

    The fact must see the keys that were written, and reading them back gives the
    planner the size of two narrow columns, which decides broadcast or sort-merge
    before the sales are shuffled.
    """
    tables, ts = silver_tables(lake), lake.batch_ts

    def customer() -> DataFrame:
        return gold.build_dim_customer(
            tables["crm_cust_info"], tables["erp_cust_az12"], tables["erp_loc_a101"], ts
        )

    def product() -> DataFrame:
        return gold.build_dim_product(tables["crm_prd_info"], tables["erp_px_cat_g1v2"], ts)

    metrics = together(
        lake.spark,
        [
            lambda: lake.write("gold", GOLD_PREFIX + "dim_customer", customer()),
            lambda: lake.write("gold", GOLD_PREFIX + "dim_product", product()),
        ],
    )
    fact = gold.build_fact_sales(
        tables["crm_sales_details"],
        lake.read("gold", GOLD_PREFIX + "dim_product"),
        lake.read("gold", GOLD_PREFIX + "dim_customer"),
        ts,
    )
    metrics.append(lake.write("gold", GOLD_PREFIX + "fact_sales", fact))
    return lake.record(metrics)


def load_warehouse(
    lake: Lake,
    database: jdbc.Database | None = None,
    columns: Mapping[str, Sequence[str]] | None = None,
) -> list[dict]:
    """Full refresh of the warehouse tables, in the lake or in a database.

    Tables named in ``columns`` are replaced by one of the declared columns only.
    """
    declared_columns = columns or {}

    def write(table: str) -> dict:
        df = LOADS[table](lake.read("gold", GOLD_PREFIX + table))
        chosen = declared_columns.get(table)
        if database is None:
            return lake.write("warehouse", table, df if chosen is None else df.select(*chosen))
        name = f"warehouse.{table}"
        if chosen is None:
            return write_measured(df, table, lambda out: jdbc.refresh_table(out, database, name))
        return write_measured(
            df.select(*chosen), table, lambda out: jdbc.replace_table(out, database, name, chosen)
        )

    return lake.record(together(lake.spark, [lambda t=table: write(t) for table in LOADS]))


# Columns that cut a warehouse table for a parallel read, and the number of slices.
READ_BACK = {
    "dim_customer": jdbc.DepthSlices("customer_key", 16),
    "dim_product": jdbc.DepthSlices("product_key", 4),
    "fact_sales": jdbc.DepthSlices("order_number", 64),
}


def create_views(
    lake: Lake,
    database: jdbc.Database | None = None,
    slices: Mapping[str, jdbc.Slices | jdbc.DepthSlices] = READ_BACK,
) -> dict[str, DataFrame]:
    """Register the typed views over the warehouse tables."""
    warehouse: Mapping[str, DataFrame] = {
        table: (
            lake.read("warehouse", table)
            if database is None
            else jdbc.read_table(lake.spark, database, f"warehouse.{table}", slices.get(table))
        )
        for table in LOADS
    }
    return views.register_typed_views(warehouse)


def run_tests(lake: Lake, database: jdbc.Database | None = None) -> DataFrame:
    """Report of the declared tests over the typed views."""
    return quality.quality_report(create_views(lake, database))


def create_gold_views(lake: Lake, database: str) -> None:
    """Define the SQL-variant gold views in the catalog, over the current silver tables."""
    views.create_catalog_views(silver_tables(lake), database)


def run_all(lake: Lake, source: Source, database: jdbc.Database | None = None) -> DataFrame:
    """Bronze to warehouse, then the test report.

    What the layers stage lives in a folder of this run and goes with it, also if it fails;
    runs at the same time and views registered before keep theirs.
    """
    with Scratch(lake.spark):
        load_bronze(lake, source)
        load_silver(lake)
        load_gold(lake)
        load_warehouse(lake, database)
    return run_tests(lake, database)
