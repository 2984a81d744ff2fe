"""Keep the newest row of every key."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame, key: str, date: str, mode: Literal["row", "coalesce"] = "row"
) -> DataFrame:
    """One row per ``key``: the newest by ``date``, null dates last.

    Ties are broken by the remaining columns, descending. ``mode="coalesce"`` takes
    the newest non-null value of every column on its own.

    The maximum of a struct that starts with the date is the newest row, and a
    maximum is combined on the map side, so each task sends one row per key and a
    key with very many records costs no more than any other.
    """
    others = [c for c in df.columns if c not in (key, date)]
    newest_first = F.struct(date, *others)

    if mode == "row":
        latest = df.groupBy(key).agg(F.max(newest_first).alias("_row"))
        values: dict[str, Column] = {c: F.col("_row")[c] for c in (date, *others)}
    elif mode == "coalesce":
        latest = df.groupBy(key).agg(
            *[
                F.max(F.when(F.col(c).isNotNull(), newest_first))[c].alias(c)
                for c in (date, *others)
            ]
        )
        values = {c: F.col(c) for c in (date, *others)}
    else:
        raise ValueError(f"unknown mode {mode!r}")

    values[key] = F.col(key)
    return latest.select([values[c].alias(c) for c in df.columns])
