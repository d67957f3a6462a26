"""Idempotent upsert as a query: one row per event key, the last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.schema import EVENT_KEY, ORIGIN_COLUMNS

WRITE_ORDER = ["ingest_time", *ORIGIN_COLUMNS]


def upsert_latest(events: DataFrame) -> DataFrame:
    """Last write per (window_bucket, event_ts, event_id).

    ``row_number() = 1`` lets Spark cut every key to one row per map task before
    the exchange, so a key redelivered any number of times ships one row per task.
    """
    order = Window.partitionBy(*EVENT_KEY).orderBy(*[F.desc(c) for c in WRITE_ORDER])
    return events.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def overwritten(events: DataFrame, *columns: str) -> DataFrame:
    """Every write but the last of its key: ``columns`` alone, next to which only key and write order are exchanged."""
    order = Window.partitionBy(*EVENT_KEY).orderBy(*[F.desc(c) for c in WRITE_ORDER])
    narrow = events.select(*EVENT_KEY, *WRITE_ORDER, *columns)
    return narrow.withColumn("_rn", F.row_number().over(order)).where("_rn > 1").select(*columns)


def key_counts(events: DataFrame) -> DataFrame:
    """Deliveries per event key; reads the key columns only."""
    return events.groupBy(*EVENT_KEY).agg(F.count("*").alias("copies"))


def dedup_stats(events: DataFrame) -> DataFrame:
    """Accepted deliveries, distinct event keys and redeliveries absorbed by the upsert."""
    return key_counts(events).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("deliveries"),
        F.count("*").alias("distinct_events"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("redeliveries"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("max_copies"),
    )


def key_lookup(events: DataFrame, bucket, event_ts, event_id) -> DataFrame:
    """Stored rows and deliveries behind one full key."""
    match = (
        (F.col("window_bucket") == bucket)
        & (F.col("event_ts") == event_ts)
        & (F.col("event_id") == event_id)
    )
    found = key_counts(events.where(match))
    return found.select(*EVENT_KEY, F.lit(1).cast("bigint").alias("stored_rows"), "copies")
