"""Dense ranks and row numbers over a whole table, without a single-task window.

``dense_rank() OVER (ORDER BY ..)`` without a partition moves every row to one
task. Here the rows are range-partitioned and sorted instead; a row's number is its
place in its partition plus the row count of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.joins import sized
from sluiceway.operators.staging import stage

# ``monotonically_increasing_id`` is documented as partition number in the upper
# bits and the row's place within its partition in the lower 33.
_PLACE_BITS = 33


def _numbered(
    df: DataFrame, ordering: list[Column], out: str, label: str
) -> tuple[DataFrame, int]:
    """Append the zero-based place of every row in the total order; and the number of rows."""
    placed = (
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _PLACE_BITS).cast("int"))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
        .drop("_id")
    )
    staged = stage(placed, label)

    # One row per partition reaches the driver: its number and its size.
    sizes = dict(
        staged.groupBy("_part").agg((F.max("_place") + 1).alias("n")).collect()
    )
    starts, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    # Folded to one array constant, so numbering stays inside the scan's stage.
    offsets = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    placed = F.get(offsets, F.col("_part")) + F.col("_place")
    return staged.withColumn(out, placed).drop("_part", "_place"), total


def row_key(
    df: DataFrame, order_by: Sequence[str], out: str, base: int = 1, label: str = "row_key"
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_by NULLS LAST)`` counted from ``base``.

    The remaining columns break ties, so the numbering is reproducible and only exact
    copies are interchangeable; a random last range column spreads those over several
    partitions. It is written before it decides where a row goes: drawn again in a
    retried task, it could send a row to two partitions or to none. The written table
    also saves computing ``df`` a second time for the sample of the range bounds.
    """
    ordering = [*order_by, *[c for c in df.columns if c not in order_by], "_copy"]
    source = stage(df.withColumn("_copy", F.rand(seed=7)), f"{label}-rows")
    numbered, _ = _numbered(source, [F.asc_nulls_last(c) for c in ordering], "_row", label)
    return numbered.select((F.col("_row") + base).alias(out), *df.columns)


def dense_key(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    base: int = 0,
    null_safe: bool = True,
    label: str = "dense_key",
) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY order_by NULLS LAST)`` counted from ``base``.

    Only the distinct order columns are range-partitioned and written; the ranks are
    joined back. With ``null_safe=False`` rows with a null order column get a null
    key, and the join can reuse a partitioning by the order column that ``df`` has.
    """
    ordering = [F.asc_nulls_last(c) for c in order_by]
    numbered, total = _numbered(df.select(*order_by).distinct(), ordering, "_row", label)
    keys = numbered.select(
        (F.col("_row") + base).alias(out), *[F.col(c).alias(f"_k_{c}") for c in order_by]
    )
    keys = sized(keys, total)
    pairs = [(F.col(c), F.col(f"_k_{c}")) for c in order_by]
    if null_safe:
        joined = df.join(keys, [mine.eqNullSafe(theirs) for mine, theirs in pairs], "inner")
    else:
        joined = df.join(keys, [mine == theirs for mine, theirs in pairs], "left")
    return joined.select(out, *df.columns)
