"""Periodic drain."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidegate.plans.drain import drain, drain_by_stream_clock
from tidegate.plans.late_output import emit_late
from tidegate.sinks.window_files import WindowSink
from tidegate.sources.lease import DrainLease, StaleLease, acquire
from tidegate.sources.store import InboxStore


def run_drainer(
    store: InboxStore,
    sink: WindowSink,
    checkpoint: str,
    clock=time.time,
    by_stream_clock: bool = False,
    late_sink: WindowSink | None = None,
    lease_seconds: int = 300,
) -> StreamingQuery:
    """Drain on every poll interval, then emit late events to ``late_sink``.

    Any number of drainers may run for a drain identity: the one that holds its lease works, the others
    wait until it has not renewed it for ``lease_seconds``, which must exceed one run of a drain.
    ``by_stream_clock`` seals windows by the events received instead of the wall clock. The
    ledger, not the ticker's checkpoint, says where to continue.
    """
    ticks = store.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    held: list[DrainLease] = []

    def run(_: DataFrame, __: int) -> None:
        now = int(clock())
        try:
            if held:
                held[0].renew()
            else:
                held.extend(filter(None, [acquire(store, store.config.drain_id, lease_seconds)]))
            if held:
                (drain_by_stream_clock if by_stream_clock else drain)(store, sink, now, lease=held[0])
                if late_sink is not None:
                    held[0].renew()
                    emit_late(store, late_sink, now)
        except StaleLease:
            # Another drainer works: this one waits with the others.
            held.clear()

    return (
        ticks.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{store.config.poll_interval_ms} milliseconds")
        .start()
    )
