"""Run a worker object over a text column in Arrow batches, without moving any row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# A worker turns a list of texts into one list of values per output field.
Worker = Callable[[list[str]], dict[str, list[Any]]]

# Texts turned into Python objects at a time; bounds a task's memory besides the batch.
_SLICE_BYTES = 4 << 20

_BATCHES = {
    # Setting, Spark's default, and the value used instead: few rows and bytes a batch, as
    # texts may be very long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(16 << 20)),
}


def bounded_batches(spark: SparkSession) -> None:
    """Set the Arrow batch limits for long texts, unless the session chose its own."""
    for name, (default, wanted) in _BATCHES.items():
        if spark.conf.get(name, None) in (default, None):
            spark.conf.set(name, wanted)


def by_bytes(texts: pa.Array, limit: int = _SLICE_BYTES) -> Iterator[list[str]]:
    """The batch as lists of texts of about ``limit`` bytes each; null is the empty text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    begin, held = 0, 0
    for at, size in enumerate(sizes):
        if held and held + size > limit:
            yield [t or "" for t in texts.slice(begin, at - begin).to_pylist()]
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield [t or "" for t in texts.slice(begin).to_pylist()]


def text_udf(make: Callable[[], Worker], fields: StructType) -> Callable[[Column], Column]:
    """A struct-valued function of a text column; ``make`` runs once per task."""
    kind = to_arrow_type(fields)

    @F.arrow_udf(fields)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            parts = [
                pa.StructArray.from_arrays(
                    [pa.array(values[f.name], f.type) for f in kind], fields=list(kind)
                )
                for values in map(work, by_bytes(batch))
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def with_text_result(
    df: DataFrame, text: str, make: Callable[[], Worker], fields: StructType
) -> DataFrame:
    """``df`` with the worker's fields appended; columns of the same name are replaced."""
    bounded_batches(df.sparkSession)
    run = text_udf(make, fields)
    kept = [F.col(quoted(c)) for c in df.columns if c not in fields.names]
    (result,) = fresh(df, "text_result")
    held = df.select("*", run(F.col(quoted(text)).cast("string")).alias(result))
    return held.select(*kept, *[F.col(result)[f].alias(f) for f in fields.names])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any((prefix + name).lower() in taken for name in names):
        prefix += "_"
    return [prefix + name for name in names]


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"
