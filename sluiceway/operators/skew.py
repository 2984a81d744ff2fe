"""Find the few keys that hold too many rows for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.staging import stage

# A task sorts or buffers this many narrow rows of one key without trouble.
HEAVY_ROWS = 5_000_000


@dataclass(frozen=True)
class KeySizes:
    """Exact figures of a key column: rows that count, and rows of the most frequent key."""

    rows: int
    largest: int


def _per_key(df: DataFrame, key: str, nulls: bool) -> DataFrame:
    keys = df.select(key)
    if not nulls:
        keys = keys.where(F.col(key).isNotNull())
    return keys.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def key_sizes(df: DataFrame, key: str, nulls: bool = False) -> KeySizes:
    """Count one column with map-side combine; two numbers reach the driver.

    Null never matches in a join and counts as a key only if ``nulls`` is set.
    """
    total = F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))
    rows, largest = _per_key(df, key, nulls).agg(*total).head()
    return KeySizes(rows, largest)


def heavy_keys(
    df: DataFrame,
    key: str,
    heavy_rows: int = HEAVY_ROWS,
    nulls: bool = False,
    sizes: KeySizes | None = None,
) -> DataFrame | None:
    """Keys with more than ``heavy_rows`` rows and their number ``_rows``, or None.

    Every key is counted, whatever the size of the table, and none is left out. The list
    stays distributed: it is written once, so the planner knows its size when it is joined.
    ``sizes`` are figures already taken by ``key_sizes``.
    """
    sizes = sizes or key_sizes(df, key, nulls)
    if sizes.largest <= heavy_rows:
        return None
    return stage(_per_key(df, key, nulls).where(F.col("_rows") > heavy_rows), "heavy_keys")
