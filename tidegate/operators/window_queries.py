"""Questions about windows: counts, gaps, seals, size, order, reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.config import InboxConfig
from tidegate.functions.windows import bucket_of_seconds, is_sealed, seal_time
from tidegate.operators.latest import key_counts
from tidegate.schema import EVENT_KEY
from tidegate.session import cut_lineage

# Windows generated per inner sequence when a gap is filled.
GAP_FAN_OUT = 4096


def window_counts(events: DataFrame) -> DataFrame:
    """Distinct events and deliveries per window, from the key columns alone."""
    return (
        key_counts(events)
        .groupBy("window_bucket")
        .agg(F.count("*").alias("event_count"), F.sum("copies").alias("deliveries"))
    )


def window_range(bounds: DataFrame, window_seconds: int) -> DataFrame:
    """Every window start between ``first`` and ``last`` of a one-row frame.

    Two nested sequences keep each generated array small however long the span,
    and the exchange between them spreads the inner one over the cluster.
    """
    stride = window_seconds * GAP_FAN_OUT
    outer = bounds.where("first IS NOT NULL").select(
        "last", F.explode(F.sequence("first", "last", F.lit(stride).cast("bigint"))).alias("_from")
    )
    outer = outer.repartition("_from")
    upto = F.least(F.col("_from") + F.lit(stride - window_seconds), F.col("last"))
    return outer.select(
        F.explode(F.sequence("_from", upto, F.lit(window_seconds).cast("bigint"))).alias(
            "window_bucket"
        )
    )


def fill_gaps(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts for every given window, zero where nothing was stored."""
    joined = windows.join(counts, "window_bucket", "left")
    zeros = [c for c in counts.columns if c != "window_bucket"]
    return joined.select("window_bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in zeros])


def windows_gapfilled(events: DataFrame, window_seconds: int) -> DataFrame:
    """Every window from the first to the last stored one, empty ones included."""
    # Read twice below: one narrow row per window is kept instead of counting again.
    counts = cut_lineage(window_counts(events).select("window_bucket", "event_count"))
    bounds = counts.agg(
        F.min("window_bucket").alias("first"), F.max("window_bucket").alias("last")
    )
    return fill_gaps(window_range(bounds, window_seconds), counts)


def sealed_windows(windows: DataFrame, now_epoch: int | Column, config: InboxConfig) -> DataFrame:
    sealed = windows.where(is_sealed(F.col("window_bucket"), now_epoch, config))
    return sealed.withColumn("sealed_after", seal_time(F.col("window_bucket"), config))


def scan_window(events: DataFrame, bucket: int | Column) -> DataFrame:
    """One window in drain order."""
    return events.where(F.col("window_bucket") == bucket).orderBy("event_ts", "event_id")


def ordered_window(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Drain order: by window, event time and id, over all partitions in sequence.

    Ranges of the full key cut a window of any size over many tasks.
    """
    count = [partitions] if partitions else []
    ranged = events.repartitionByRange(*count, *EVENT_KEY)
    return ranged.sortWithinPartitions(*EVENT_KEY)


def drain_position(events: DataFrame) -> DataFrame:
    """One-based position of each event in its window, without gathering the window.

    Ranges of the full key put a window's events into consecutive tasks, hot windows and
    instants included. The key order is kept as a table; a position is the place in the
    task plus the window's events in earlier tasks, and only those counts are summed up.
    """
    place = F.monotonically_increasing_id()
    keys = ordered_window(events.select(*EVENT_KEY)).select(
        *EVENT_KEY, F.shiftright(place, 33).alias("_task"), place.bitwiseAND((1 << 33) - 1).alias("_place")
    )
    placed = cut_lineage(keys)
    counts = placed.groupBy("window_bucket", "_task").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("window_bucket").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    starts = counts.select("window_bucket", "_task", before.alias("_before"))
    position = placed.join(starts, ["window_bucket", "_task"]).select(
        *EVENT_KEY, (F.col("_place") + F.col("_before")).alias("position")
    )
    return events.join(position, EVENT_KEY)


def live_rows(events: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Rows whose last write is not older than the retention; the bound reaches the scan."""
    oldest = F.timestamp_micros(F.unix_micros(now) - F.lit(ttl_seconds * 1_000_000))
    return events.where(F.col("ingest_time") > oldest)


def window_size_audit(events: DataFrame, config: InboxConfig) -> DataFrame:
    """Rows and payload bytes per window, flagged above the warning size."""
    return (
        events.groupBy("window_bucket")
        .agg(F.count("*").alias("event_count"), F.sum("payload_bytes").alias("payload_bytes"))
        .withColumn("oversized", F.col("payload_bytes") > F.lit(config.window_warn_bytes))
    )


def latest_windows(counts: DataFrame, n: int) -> DataFrame:
    """Top-k report: the n newest windows."""
    return counts.orderBy(F.col("window_bucket").desc()).limit(n)


def rebucket(events: DataFrame, window_seconds: int) -> DataFrame:
    """The same events under another window size."""
    return events.withColumn(
        "window_bucket", bucket_of_seconds(F.unix_seconds("event_ts"), window_seconds)
    )
