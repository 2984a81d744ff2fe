"""Independent tables of one layer, written at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Fixed value: as many table loads may run at once.
MAX_CONCURRENT = 3


def together(
    spark: SparkSession, tasks: Sequence[Callable[[], T]], workers: int = MAX_CONCURRENT
) -> list[T]:
    """Results in the order of ``tasks``. Small tables need not wait for large ones:
    the cluster fills the tail of one job with tasks of the next."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(workers) as pool:
        # Each task gets a copy of the caller's context, and with it the staging scope.
        running = [pool.submit(copy_context().run, inherit(t)) for t in tasks]
        return [f.result() for f in running]
