"""LEAD within a key, also for keys too large for one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.staging import stage

# ``monotonically_increasing_id``: partition number above, the row's place in the lower 33 bits.
_PLACE = (1 << 33) - 1


def next_in_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: str,
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """Append ``LEAD(value) OVER (PARTITION BY key ORDER BY order_by NULLS LAST)``.

    Rows with a null key belong to no group and get null. The remaining columns break ties.

    All rows are range-partitioned by the whole order and sorted, so a key lies on as many
    tasks as it needs, and each row's successor is the row behind it. That shift is the one
    step a window cannot take without a further exchange by key; it works on whole Arrow
    columns. The successor of a partition's last row is the first row of the next partition
    that has any: those edges, two rows a partition, meet in a small window of their own.
    Exact copies of one row have no order among them and stay on one task, which holds a batch
    of them at a time.

    ``partitions`` fixes the number of ranges; by default adaptive execution chooses it.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    ordering = [F.asc_nulls_last(c) for c in (key, *order_by, *rest)]
    ranged = (
        df.repartitionByRange(*ordering)
        if partitions is None
        else df.repartitionByRange(partitions, *ordering)
    )
    sorted_rows = ranged.sortWithinPartitions(*ordering)
    placed = sorted_rows.withColumn("_id", F.monotonically_increasing_id())
    shifted = stage(_shifted(placed, key, value, out), "versions")

    edges = shifted.where(F.col("_last") | (F.col("_id").bitwiseAND(F.lit(_PLACE)) == 0))
    along = Window.orderBy("_id")
    following = F.when(F.lead(key).over(along) == F.col(key), F.lead(value).over(along))
    columns = [*df.columns, out]
    inner = shifted.where(~F.col("_last")).select(*columns)
    ends = edges.withColumn(out, following).where("_last").select(*columns)
    return inner.unionByName(ends)


def _shifted(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``df`` with ``out``, the next row's value if its key is the same, and ``_last``.

    Within a partition only; ``_last`` marks its last row, whose successor lies elsewhere.
    """
    kind = df.schema[value].dataType
    schema = T.StructType(
        [*df.schema, T.StructField(out, kind), T.StructField("_last", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None

        def appended(rows: pa.RecordBatch, following: pa.Array, last: bool) -> pa.RecordBatch:
            marks = pa.array([last] * rows.num_rows, pa.bool_())
            return pa.RecordBatch.from_arrays(
                [*rows.columns, following, marks], names=[*rows.schema.names, out, "_last"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last row of a batch waits for the first of the next.
            rows = batch
            if held is not None:
                joined = pa.Table.from_batches([held, batch]).combine_chunks()
                rows = joined.to_batches()[0]
            keys, values = rows.column(key), rows.column(value)
            same = pc.fill_null(pc.equal(keys[:-1], keys[1:]), False)
            missing = pa.scalar(None, values.type)
            held = rows.slice(rows.num_rows - 1)
            if rows.num_rows > 1:
                yield appended(
                    rows.slice(0, rows.num_rows - 1), pc.if_else(same, values[1:], missing), False
                )
        if held is not None:
            yield appended(held, pa.nulls(1, held.column(value).type), True)

    return df.mapInArrow(run, schema)
