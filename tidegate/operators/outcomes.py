"""Split of decoded deliveries into events and dead letters, and their counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.timestamps import to_millis
from tidegate.schema import EVENT_COLUMNS, ORIGIN_COLUMNS

ACCEPTED = "accepted"
REJECTED = "rejected"


def with_ingest_time(decoded: DataFrame, ingest_time: Column) -> DataFrame:
    """Add the reception clock and the untouched delivery text as payload."""
    return decoded.withColumns(
        {"ingest_time": to_millis(ingest_time), "payload": F.col("value")}
    )


def valid_events(decoded: DataFrame) -> DataFrame:
    """Accepted deliveries: event columns plus the origin that orders equal ingest times."""
    return decoded.where(F.col("reason").isNull()).select(*EVENT_COLUMNS, *ORIGIN_COLUMNS)


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rejected deliveries with their original key and value."""
    return decoded.where(F.col("reason").isNotNull()).select(
        "key", "value", "reason", *ORIGIN_COLUMNS
    )


def is_late(bucket: Column, cursor: Column | int) -> Column:
    """The window was drained already: cursor > 0 and bucket <= cursor."""
    cursor = cursor if isinstance(cursor, Column) else F.lit(cursor)
    return F.coalesce((cursor > 0) & (bucket <= cursor), F.lit(False))


def counter_columns(cursor: Column | int) -> list[Column]:
    """One count per delivery: writes, parse errors, writes behind the drain cursor."""
    accepted = F.col("reason").isNull()
    late = accepted & is_late(F.col("window_bucket"), cursor)
    return [
        F.count_if(accepted).alias("success"),
        F.count_if(~accepted).alias("parse_error"),
        F.count_if(late).alias("late_arrival"),
    ]


def ingest_counters(decoded: DataFrame, cursor: Column | int = 0) -> DataFrame:
    return decoded.agg(*counter_columns(cursor))


def dead_letter_summary(decoded: DataFrame) -> DataFrame:
    return dead_letters(decoded).groupBy("reason").agg(F.count("*").alias("deliveries"))
