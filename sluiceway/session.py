"""Session settings the transforms are tuned for.

All are runtime SQL settings, so they can be applied to a session somebody else
created. Partition counts are left to the cluster: adaptive execution merges small
shuffle partitions, so ``spark.sql.shuffle.partitions`` should be set for the
largest stage. So is the broadcast limit: a broadcast side is built in the driver, several
at a time where tables are loaded together, in a multiple of its size.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs a further exchange downstream:
    # consecutive joins on one key would otherwise switch the split off.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark
