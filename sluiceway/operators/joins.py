"""Left outer lookup that stays balanced when either side has a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType

from sluiceway.operators.skew import HEAVY_ROWS, heavy_keys, key_sizes
from sluiceway.operators.staging import stage

# Bytes of a decoded value, for the broadcast decision.
_VARIABLE_WIDTH, _FIXED_WIDTH = 48, 16


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``; null never matches.

    Matches are never deduplicated. A hot key on the left is split by adaptive
    execution at run time. On the right of an outer join adaptive execution cannot
    split, so right keys above ``heavy_rows`` take a salted inner join, which is the
    same as a left join for keys known to be on the right. A key gets one piece per
    ``heavy_rows`` of its rows. The random pieces are written before the join shuffles on
    them, so a retried task cannot draw others.

    The right side is ``sized``.
    """
    condition = F.col(left_key) == F.col(right_key)
    sizes = key_sizes(right, right_key)
    right = sized(right, sizes.rows)
    heavy = heavy_keys(right, right_key, heavy_rows, sizes=sizes)
    if heavy is None:
        return left.join(right, condition, "left")

    pieces = F.ceil(F.col("_rows") / max(1, heavy_rows)).cast("int").alias("_pieces")
    hot = heavy.select(F.col(right_key).alias("_hot"), pieces)
    on_left, on_right = F.col(left_key) == F.col("_hot"), F.col(right_key) == F.col("_hot")
    ordinary = left.join(hot, on_left, "left_anti").join(
        right.join(hot, on_right, "left_anti"), condition, "left"
    )
    copies = (
        left.join(hot, on_left)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .drop("_hot", "_pieces")
    )
    dealt = stage(
        right.join(hot, on_right)
        .withColumn("_piece", F.floor(F.rand(seed=11) * F.col("_pieces")).cast("int"))
        .drop("_hot", "_pieces"),
        "hot_right",
    )
    salted = copies.join(dealt, condition & (F.col("_salt") == F.col("_piece")), "inner")
    return ordinary.unionByName(salted.drop("_salt", "_piece"))


def sized(side: DataFrame, rows: int) -> DataFrame:
    """``side`` of a join, which Spark may broadcast only if it is small.

    Its counted ``rows``, decoded, must be below the broadcast limit; the size of compressed
    files says nothing about that, and what is broadcast is built in the driver's memory.
    """
    return side if fits_broadcast(side, rows) else side.hint("merge")


def fits_broadcast(side: DataFrame, rows: int) -> bool:
    """Whether ``rows`` rows of ``side``, decoded, are below the session's broadcast limit."""
    return rows * _row_width(side.schema) <= _broadcast_limit(side)


def _row_width(schema: StructType) -> int:
    def width(kind: DataType) -> int:
        return _VARIABLE_WIDTH if isinstance(kind, (StringType, BinaryType)) else _FIXED_WIDTH

    return sum(width(field.dataType) for field in schema)


def _broadcast_limit(df: DataFrame) -> int:
    """The session's limit in bytes."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("bB")
    units = {"k": 10, "m": 20, "g": 30}
    if limit[-1:].lower() in units:
        return int(limit[:-1]) << units[limit[-1].lower()]
    return int(limit)
