"""The drain ledger against the inbox: cursor, gaps, reconciliation, late output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.latest import upsert_latest
from tidegate.operators.outcomes import is_late
from tidegate.operators.window_queries import ordered_window, window_counts
from tidegate.schema import EVENT_KEY, PROGRESS
from tidegate.session import cut_lineage

# What names a segment within a store's rows.
SEGMENT = ["storage_bucket", "segment"]


def latest_progress(ledger: DataFrame) -> DataFrame:
    """One ledger row per (drain_id, window_bucket): the last record, by time and then by segment."""
    later = [F.col("segment").desc()] if "segment" in ledger.columns else []
    order = Window.partitionBy("drain_id", "window_bucket").orderBy(
        F.col("drained_at").desc(), *later, F.col("event_count").desc()
    )
    ranked = ledger.withColumn("_rn", F.row_number().over(order)).where("_rn = 1")
    return ranked.select(*PROGRESS.fieldNames())


def live_progress(ledger: DataFrame, now_epoch: int, ttl_seconds: int) -> DataFrame:
    oldest = F.timestamp_seconds(F.lit(now_epoch - ttl_seconds))
    return ledger.where(F.col("drained_at") > oldest)


def last_drained(ledger: DataFrame) -> DataFrame:
    """Highest drained window per drain identity."""
    return ledger.groupBy("drain_id").agg(F.max("window_bucket").alias("last_bucket"))


def cursor_of(ledger: DataFrame, drain_id: str) -> Column:
    """Drain cursor as a scalar subquery; null when nothing was drained."""
    mine = ledger.where(F.col("drain_id") == drain_id)
    return mine.agg(F.max("window_bucket").alias("cursor")).scalar()


def late_arrivals(events: DataFrame, cursor: Column | int) -> DataFrame:
    """Stored events at or behind the cursor; they stay stored."""
    return events.where(is_late(F.col("window_bucket"), cursor))


def undrained_windows(windows: DataFrame, ledger: DataFrame, drain_id: str) -> DataFrame:
    """Windows without a ledger row of this drain identity."""
    mine = ledger.where(F.col("drain_id") == drain_id).select("window_bucket")
    return windows.join(mine, "window_bucket", "left_anti")


def drain_reconcile(events: DataFrame, ledger: DataFrame, drain_id: str) -> DataFrame:
    """Ledger count against the count stored now, for windows on either side.

    ``recorded`` is null for a window not drained, ``actual`` 0 for one that holds nothing
    now; ``late_rows`` is positive where events arrived after the drain, negative where they were lost or expired.
    """
    recorded = ledger.where(F.col("drain_id") == drain_id).select(
        "window_bucket", F.col("event_count").alias("recorded")
    )
    actual = window_counts(events).select("window_bucket", F.col("event_count").alias("actual"))
    joined = recorded.join(actual, "window_bucket", "full")
    actual_or_zero = F.coalesce("actual", F.lit(0))
    return joined.select(
        "window_bucket",
        "recorded",
        actual_or_zero.alias("actual"),
        (actual_or_zero - F.col("recorded")).alias("late_rows"),
    )


def late_side_output(events: DataFrame, emitted: DataFrame, ledger: DataFrame, drain_id: str) -> DataFrame:
    """Events of drained windows whose key was not part of the drained output, in drain order.

    Keys are compared, not counts: one event may have expired while another arrived. Of a store's rows only
    segments that hold such a key are exchanged: a first pass over keys alone names them.
    """
    drained = ledger.where(F.col("drain_id") == drain_id).select("window_bucket")
    candidates = events.join(drained, "window_bucket", "left_semi")
    known = emitted.select(*EVENT_KEY)
    if set(SEGMENT) <= set(events.columns):
        holding = candidates.select(*EVENT_KEY, *SEGMENT).join(known, EVENT_KEY, "left_anti").select(*SEGMENT).distinct()
        # One row per segment: names that the driver lists anyway.
        candidates = candidates.join(F.broadcast(cut_lineage(holding)), SEGMENT, "left_semi")
    late = upsert_latest(candidates).join(known, EVENT_KEY, "left_anti")
    return ordered_window(late)
