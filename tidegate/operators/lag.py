"""Consumer lag from committed and end offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.config import InboxConfig


def offset_lag(committed: DataFrame, end: DataFrame) -> DataFrame:
    """Lag per partition, never negative; partitions without an end offset are left out."""
    have = committed.select("topic", "partition", F.col("offset").alias("committed_offset"))
    want = end.select("topic", "partition", F.col("offset").alias("end_offset"))
    lag = F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("committed_offset"))
    return have.join(want, ["topic", "partition"]).withColumn("lag", lag)


def lag_summary(lag: DataFrame, config: InboxConfig) -> DataFrame:
    """Largest and total lag; zero when nothing is committed. ``max_lag`` only labels."""
    zero = F.lit(0).cast("bigint")
    return lag.agg(
        F.coalesce(F.max("lag"), zero).alias("largest_lag"),
        F.coalesce(F.sum("lag"), zero).alias("total_lag"),
        F.count("*").alias("partitions"),
    ).withColumn("max_lag", F.lit(config.max_lag).cast("bigint"))
