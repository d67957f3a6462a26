"""Late events as an output of their own: each is emitted once, after its window was drained without it."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import functions as F

from tidegate.operators.latest import upsert_latest
from tidegate.operators.window_queries import live_rows, ordered_window
from tidegate.schema import EVENT_COLUMNS, EVENT_KEY
from tidegate.session import cut_lineage
from tidegate.sinks.window_files import WindowSink
from tidegate.sources.store import InboxStore


@dataclass(frozen=True)
class LateRun:
    """One tick: how many segments were new to it, and what it emitted."""

    tick: int
    segments: int
    windows: int = 0
    events: int = 0


def late_name(drain_id: str, tick: int) -> str:
    """Name under which a sink gets the events of a tick; a tick that comes again has the same."""
    return f"{drain_id}.late-{tick:010d}"


def emit_late(store: InboxStore, sink: WindowSink, now_epoch: int | None = None) -> LateRun:
    """Hand the sink, in drain order, the events of drained windows that no drain and no tick emitted before.

    Reads only segments that no earlier tick has looked at, and of the log of emitted keys only
    their storage folders. An event counts by its key: a redelivery of an emitted one is not late
    output, whatever it holds. Expired rows and windows without a live ledger row are left out. The keys are
    logged and the segments recorded after the sink returned, so a tick that failed comes again
    under the same name. A segment written by a compaction is new once.

    For the drainer itself, between its drains: a drain that runs meanwhile could record
    windows whose new segments this tick has passed over.
    """
    config = store.config
    if not config.late_output:
        raise ValueError("late_output is off: drains have not logged what they emitted")
    now_epoch = int(time.time()) if now_epoch is None else now_epoch
    drain_id = config.drain_id
    tick, examined = store.examined_segments(drain_id)
    cursor = store.last_drained(drain_id, now_epoch)
    if cursor is None:
        return LateRun(tick, 0)
    listed = store.segment_folders(last=cursor)
    fresh = [name for name in listed if name not in examined]
    if not fresh:
        return LateRun(tick, 0)
    buckets = sorted({int(name.split("/")[0].split("=")[1]) for name in fresh})
    now = F.timestamp_seconds(F.lit(now_epoch))
    rows = live_rows(store.read_segments(fresh), now, config.inbox_ttl_seconds).where(F.col("window_bucket") <= cursor)
    drained = store.progress(now_epoch).where(F.col("drain_id") == drain_id).select("window_bucket")
    candidates = upsert_latest(rows.join(drained, "window_bucket", "left_semi"))
    known = store.emitted(drain_id, buckets).select(*EVENT_KEY)
    late = cut_lineage(candidates.join(known, EVENT_KEY, "left_anti").select(*EVENT_COLUMNS))
    windows = cut_lineage(late.groupBy("window_bucket").agg(F.count("*").alias("event_count")))
    totals = windows.agg(F.count("*").alias("w"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("e")).first()
    if totals["e"]:
        tasks = max(1, -(-totals["e"] // config.rows_per_file))
        sink(ordered_window(late, tasks), windows, late_name(drain_id, tick))
        store.append_emitted(late, drain_id, f"late-{tick:010d}")
    store.mark_examined(drain_id, tick, listed)
    return LateRun(tick, len(fresh), totals["w"], totals["e"])
