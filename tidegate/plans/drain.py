"""Bulk drain: every sealed window after the cursor, in ascending order, once."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.config import InboxConfig
from tidegate.functions.windows import bootstrap_cursor, last_sealed_bucket
from tidegate.operators.latest import upsert_latest
from tidegate.operators.window_queries import fill_gaps, ordered_window, window_counts
from tidegate.schema import EVENT_COLUMNS, EVENT_KEY, ORIGIN_COLUMNS
from tidegate.session import cut_lineage
from tidegate.sinks.window_files import WindowSink
from tidegate.sources.lease import DrainLease
from tidegate.sources.store import InboxStore


@dataclass(frozen=True)
class DrainRun:
    """What one run covered; ``first > last`` means nothing was sealed yet."""

    drain_id: str
    first: int
    last: int
    windows: int = 0
    events: int = 0


def sealed_span(cursor: int, now_epoch: int, config: InboxConfig) -> tuple[int, int]:
    """First and last window of a run, at most ``max_windows_per_run`` of them."""
    w = config.window_seconds
    first = cursor + w
    newest = last_sealed_bucket(now_epoch, config)
    return first, min(newest, first + (config.max_windows_per_run - 1) * w)


def window_ledger(rows: DataFrame, first: int, last: int, config: InboxConfig) -> DataFrame:
    """(window_bucket, event_count, deliveries) of every window in the span, empty ones as zero."""
    w = config.window_seconds
    span = rows.sparkSession.range(first, last + w, w).withColumnRenamed("id", "window_bucket")
    return fill_gaps(span, window_counts(rows))


def drain_tasks(rows: int, config: InboxConfig) -> int:
    """Tasks of one ordered output: one per file, unless that makes very many small ones."""
    files = -(-rows // config.rows_per_file)
    return max(1, min(files, max(config.most_small_tasks, -(-rows // config.rows_per_task))))


def ordered_events(rows: DataFrame, deliveries: int, config: InboxConfig) -> DataFrame:
    """Latest events in drain order, whatever the sizes of the windows.

    Each key is cut to one row per task before the exchange of the upsert; ranges of the
    full key then spread a window of any size over tasks, in ascending order.
    """
    columns = rows.select(*EVENT_COLUMNS, *ORIGIN_COLUMNS)
    return ordered_window(upsert_latest(columns), drain_tasks(deliveries, config)).select(*EVENT_COLUMNS)


def drain_span(
    store: InboxStore,
    first: int,
    last: int,
    sink: WindowSink,
    drain_id: str,
    now_epoch: int,
    drained_at_epoch: int | None = None,
    lease: DrainLease | None = None,
) -> DrainRun:
    """Emit the windows ``first``..``last`` and record them after the sink returned.

    With a lease, a drainer that was replaced stops ahead of the sink or, if it loses the lease there, ahead of the ledger.
    """
    config = store.config
    if lease is not None:
        lease.renew()
    if last < first:
        return DrainRun(drain_id, first, last)
    now = F.timestamp_seconds(F.lit(now_epoch))
    rows = store.live(now, first, last)
    windows = cut_lineage(window_ledger(rows, first, last, config))
    totals = windows.agg(
        F.count("*").alias("w"), F.sum("event_count").alias("e"), F.sum("deliveries").alias("d")
    ).first()
    sink(ordered_events(rows, totals["d"], config), windows.select("window_bucket", "event_count"), drain_id)
    if config.late_output:
        # The same files as the sink's events: the listing was made once.
        store.append_emitted(rows.select(*EVENT_KEY).distinct(), drain_id, f"drain-{first}-{last}")
    drained_at = int(time.time() * 1000) if drained_at_epoch is None else drained_at_epoch * 1000
    store.append_progress(
        windows.select(
            F.lit(drain_id).alias("drain_id"),
            "window_bucket",
            "event_count",
            F.timestamp_millis(F.lit(drained_at)).alias("drained_at"),
        ),
        lease=lease,
    )
    if store.ledger_is_fragmented(drain_id):
        store.compact_progress(drain_id, now_epoch)
    return DrainRun(drain_id, first, last, totals["w"], totals["e"])


def drain(
    store: InboxStore,
    sink: WindowSink,
    now_epoch: int | None = None,
    drained_at_epoch: int | None = None,
    seal_at_epoch: int | None = None,
    lease: DrainLease | None = None,
) -> DrainRun:
    """One cycle: resume or bootstrap the cursor, drain all that is sealed at ``now_epoch``.

    Works in runs of at most ``max_windows_per_run`` windows, ascending, and records each
    before the next begins: when one fails, the windows of the earlier runs stay recorded.
    ``seal_at_epoch`` seals by another clock than the one retention follows.
    """
    config = store.config
    now_epoch = int(time.time()) if now_epoch is None else now_epoch
    seal_at = now_epoch if seal_at_epoch is None else seal_at_epoch
    last = store.last_drained(config.drain_id, now_epoch)
    cursor = bootstrap_cursor(last, seal_at, config)
    first, newest = sealed_span(cursor, seal_at, config)
    windows = events = 0
    start = first
    while True:
        run = drain_span(store, first, newest, sink, config.drain_id, now_epoch, drained_at_epoch, lease)
        windows, events = windows + run.windows, events + run.events
        following, newest = sealed_span(newest, seal_at, config) if newest >= first else (first, newest)
        if newest < following:
            return DrainRun(config.drain_id, start, run.last, windows, events)
        first = following


def drain_by_stream_clock(
    store: InboxStore,
    sink: WindowSink,
    now_epoch: int | None = None,
    drained_at_epoch: int | None = None,
    expected: int | None = None,
    lease: DrainLease | None = None,
) -> DrainRun | None:
    """One cycle that seals a window once every source partition, idle ones aside, has passed it by the lateness.

    A source that is behind, as after an outage, delays its windows instead of finding
    them drained. Returns None as long as the clock is not known.
    """
    clock = store.stream_clock(expected)
    if clock is None:
        return None
    return drain(store, sink, now_epoch, drained_at_epoch, clock, lease)


def replay_windows(
    store: InboxStore,
    sink: WindowSink,
    first: int,
    last: int,
    drain_id: str,
    now_epoch: int | None = None,
    drained_at_epoch: int | None = None,
) -> list[DrainRun]:
    """Emit sealed windows again under a drain identity of their own, in bounded runs."""
    config = store.config
    w = config.window_seconds
    now_epoch = int(time.time()) if now_epoch is None else now_epoch
    first = first // w * w
    last = min(last // w * w, last_sealed_bucket(now_epoch, config))
    step = config.max_windows_per_run * w
    return [
        drain_span(store, lo, min(last, lo + step - w), sink, drain_id, now_epoch, drained_at_epoch)
        for lo in range(first, last + w, step)
    ]
