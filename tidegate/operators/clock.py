"""The stream's own clock: how far every source partition has come in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_clock(partitions: DataFrame, idle_seconds: int | None = None) -> DataFrame:
    """One row: ``clock``, the least of the partitions' highest event times (epoch seconds), and ``partitions``.

    A partition that runs ahead cannot move the clock past the others. One whose last
    reception is more than ``idle_seconds`` behind the newest of all no longer holds it
    back; reception time is the stream's own, so the answer can be repeated. Partitions
    that sent no event are not counted; without any the clock is null.
    """
    seen = partitions.where("high_event_ts IS NOT NULL")
    if idle_seconds is not None:
        # Joined by one row: the newest reception.
        newest = partitions.agg(F.max(F.unix_millis("last_seen")).alias("newest")).scalar()
        active = F.unix_millis("last_seen") >= newest - F.lit(idle_seconds * 1000)
    else:
        active = F.lit(True)
    high = F.when(active, F.unix_seconds("high_event_ts"))
    return seen.agg(F.min(high).alias("clock"), F.count(F.lit(1)).alias("partitions"))
