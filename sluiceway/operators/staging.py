"""Cut a plan at a written table in the cluster's shared checkpoint folder.

Surrogate keys must not change between two reads, and range boundaries are drawn
from a sample, so a numbered frame is written once and read back. A written table
survives the loss of any executor, prunes columns and tells the planner its size.

Tables are written into the current *scope*. ``with Scratch(spark):`` opens one with a
folder of its own and removes it at the end, also after a failure; scopes of other runs and
threads are not touched. Outside of any scope, tables belong to the application and stay
until ``release_scratch`` or, failing that, until the shared folder is cleaned.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar, Token
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from sluiceway.sources.storage import delete_path


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; the warehouse folder where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/sluiceway-{spark.sparkContext.applicationId}"


class Scratch:
    """A folder for the staged tables of one run; usable as a context manager."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        self._spark = spark
        self._tokens: list[Token[Scratch | None]] = []
        self.path = f"{scratch_root(spark)}/{name}-{uuid4().hex}"

    def __enter__(self) -> Scratch:
        self._tokens.append(_current.set(self))
        return self

    def __exit__(self, *failure: object) -> None:
        _current.reset(self._tokens.pop())
        self.release()

    @contextmanager
    def current(self) -> Iterator[Scratch]:
        """Stage here for a while, without removing the folder at the end."""
        token = _current.set(self)
        try:
            yield self
        finally:
            _current.reset(token)

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` below this folder and return a frame that reads it back."""
        return _written(df, f"{self.path}/{label}-{uuid4().hex}")

    def release(self) -> None:
        """Remove the folder; frames read from it become unreadable."""
        delete_path(self._spark, self.path)


_current: ContextVar[Scratch | None] = ContextVar("sluiceway_scratch", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """Folder of the current scope, or that of the application outside of any."""
    scope = _current.get()
    return f"{scratch_root(spark)}/application" if scope is None else scope.path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once, in the current scope, and return a frame that reads it back."""
    return _written(df, f"{scratch_dir(df.sparkSession)}/{label}-{uuid4().hex}")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Remove what this application staged outside of any scope."""
    delete_path(spark, f"{scratch_root(spark)}/application")
