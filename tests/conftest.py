from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from sluiceway import configure  # noqa: E402
from sluiceway.operators import release_scratch  # noqa: E402

BATCH_TS = datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    release_scratch(session)
    session.stop()


@pytest.fixture
def rows_of() -> Callable[[DataFrame], list[tuple]]:
    """All rows as tuples, in an order that does not depend on the plan."""

    def collect(df: DataFrame, *columns: str) -> list[tuple]:
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
