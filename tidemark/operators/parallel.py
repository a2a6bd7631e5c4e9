"""Spreading CPU-heavy row work over the cluster, where a caller asks for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting that the registered queries read; unset (the default) means no extra shuffle.
SPREAD_SETTING = "spark.tidemark.spreadPartitions"


def spread(df: DataFrame, *key: str, partitions: int | None = None) -> DataFrame:
    """Hash-repartition ``df`` on ``key`` into ``partitions``; without a number ``df`` stays as it is.

    The regex chains cost far more than moving a page, so an input that
    arrives in one or two splits (a single-row-group file) is worth spreading
    before them.  A large scan has more splits than cores and is not: the
    caller knows which it is, nothing here looks at the data.
    """
    if not partitions:
        return df
    return df.repartition(partitions, *key) if key else df.repartition(partitions)


def session_partitions(spark: SparkSession) -> int | None:
    """The number set in the session, if any."""
    n = spark.conf.get(SPREAD_SETTING, None)
    return int(n) if n else None
