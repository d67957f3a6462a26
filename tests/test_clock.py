"""The stream clock and drains that seal by it; reports of streaming queries."""

from __future__ import annotations

import json
import time

import pytest
from conftest import deliveries_of, envelope, instant
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_store import T0, iso, make_store

from tidegate.config import CONFIGURED, InboxConfig
from tidegate.operators.clock import stream_clock
from tidegate.operators.lag import offset_lag
from tidegate.plans.drain import drain_by_stream_clock
from tidegate.schema import RATES
from tidegate.sources.deliveries import file_stream
from tidegate.streaming.ingest import ingest_batch, stream_ingest
from tidegate.streaming.monitor import IngestMonitor, rate_row, reported_offsets, stream_throughput

CONFIG = {"allowed_lateness_seconds": 10, "bootstrap": CONFIGURED, "start_bucket": T0}


def state(spark, rows):
    """Rows of (partition, high event second or None, last seen second)."""
    full = [("t", p, 1, None if h is None else instant((T0 + h) * 1000), instant((T0 + s) * 1000)) for p, h, s in rows]
    return spark.createDataFrame(full, "topic string, partition int, next_offset long, high_event_ts timestamp, last_seen timestamp")


@pytest.mark.parametrize(
    ("rows", "idle", "clock"),
    [
        ([], None, None),
        ([(0, 100, 100)], None, 100),
        ([(0, 100, 100), (1, 20, 100)], None, 20),
        ([(0, 100, 100), (1, 20, 50)], 49, 100),
        ([(0, 100, 100), (1, 20, 50)], 50, 20),
        ([(0, 100, 100), (1, None, 100)], None, 100),
        # Only a dead letter is newer: its partition has no event time, the others are idle.
        ([(0, 100, 10), (1, None, 100)], 50, None),
        ([(0, 100, 10), (1, 7, 10)], 0, 7),
    ],
)
def test_the_clock_is_the_slowest_active_partition(spark, rows, idle, clock):
    found = stream_clock(state(spark, rows), idle).first()
    assert found.clock == (None if clock is None else T0 + clock)
    assert found.partitions == sum(h is not None for _, h, _ in rows)


def send(store, partition, seconds, arrival, name):
    values = [envelope(f"p{partition}-{s}", iso(T0 + s)) for s in seconds]
    batch = deliveries_of(store.spark, values, [(T0 + arrival) * 1000] * len(values), partition=partition)
    ingest_batch(store, batch, name, F.col("timestamp"))


def windows(store):
    return sorted((r.window_bucket - T0, r.event_count) for r in store.progress().collect())


def test_one_partition_ahead_does_not_seal_the_others(spark, tmp_path):
    store, seen = make_store(spark, tmp_path, **CONFIG), []
    sink = lambda events, _, __: seen.extend(r.event_id for r in events.collect())
    assert drain_by_stream_clock(store, sink, T0 + 10_000) is None
    send(store, 0, [0, 4, 300], 300, "b0")
    assert drain_by_stream_clock(store, sink, T0 + 10_000, expected=2) is None
    # The wall clock is far on; partition 1 has come to second 14, one short of the first seal.
    send(store, 1, [1, 14], 301, "b1")
    drain_by_stream_clock(store, sink, T0 + 10_000, expected=2)
    assert windows(store) == []
    send(store, 1, [15], 302, "b2")
    drain_by_stream_clock(store, sink, T0 + 10_000, expected=2)
    assert windows(store) == [(0, 3)]
    assert seen == ["p0-0", "p1-1", "p0-4"]
    # A partition that falls back does not open a window again.
    send(store, 2, [3], 303, "b3")
    run = drain_by_stream_clock(store, sink, T0 + 10_000)
    assert run.windows == 0 and windows(store) == [(0, 3)]


def test_an_idle_partition_lets_go_of_the_clock(spark, tmp_path):
    store = make_store(spark, tmp_path, idle_seconds=60, **CONFIG)
    send(store, 0, [0, 30], 30, "b0")
    send(store, 1, [2], 2, "b1")
    assert store.stream_clock() == T0 + 2
    send(store, 0, [31], 63, "b2")
    assert store.stream_clock() == T0 + 31
    drain_by_stream_clock(store, lambda *_: None, T0 + 100)
    assert windows(store) == [(0, 2), (5, 0), (10, 0), (15, 0)]


def test_the_clock_survives_replays_and_retention_follows_the_wall(spark, tmp_path):
    store = make_store(spark, tmp_path, **{**CONFIG, "inbox_ttl_seconds": 100})
    for _ in range(2):
        send(store, 0, [0, 40], 40, "b0")
    assert store.partitions().first().next_offset == 2
    drain_by_stream_clock(store, lambda *_: None, T0 + 200)
    assert set(windows(store)) == {(b, 0) for b in range(0, 30, 5)}


def test_idle_seconds_are_checked():
    with pytest.raises(ValueError, match="idle_seconds"):
        InboxConfig(idle_seconds=-1)


# -- what streaming queries report -------------------------------------------

REPORT = {
    "id": "q",
    "batchId": 7,
    "timestamp": "2026-07-16T10:00:00.000Z",
    "numInputRows": 30,
    "batchDuration": 1500,
    "sources": [{"endOffset": '{"t":{"0":5,"1":9}}', "latestOffset": {"t": {"0": 9, "1": 9, "2": 3}}}],
}


def test_live_lag_from_reports(spark):
    older = rate_row({**REPORT, "batchId": 6, "sources": [{"endOffset": {"t": {"0": 1}}, "latestOffset": {"t": {"0": 2}}}]})
    other = rate_row({**REPORT, "id": "files", "sources": [{"endOffset": {"logOffset": 3}, "latestOffset": None}]})
    rates = spark.createDataFrame([older, rate_row(REPORT), other], RATES)
    lag = {r.partition: r.lag for r in offset_lag(*reported_offsets(rates)).collect()}
    assert lag == {0: 4, 1: 0}
    speed = {r["query"]: (r.batches, r.deliveries, r.per_second) for r in stream_throughput(rates).collect()}
    assert speed == {"q": (2, 60, 20.0), "files": (1, 30, 20.0)}


def test_reports_are_stored_once(spark, tmp_path):
    store = make_store(spark, tmp_path)
    monitor = IngestMonitor(store)
    assert store.rates().count() == 0
    for _ in range(2):
        monitor.rows["q-0000000007"] = rate_row(REPORT)
        monitor.flush()
    assert [r.rows for r in store.rates().collect()] == [30]


def test_a_failed_flush_keeps_the_reports(spark, tmp_path, monkeypatch):
    store = make_store(spark, tmp_path)
    monitor = IngestMonitor(store)
    monitor.rows["q-0000000007"] = rate_row(REPORT)
    with monkeypatch.context() as patch:
        patch.setattr(type(store), "write_rates", lambda *_: (_ for _ in ()).throw(OSError("down")))
        with pytest.raises(OSError):
            monitor.flush()
    monitor.flush()
    assert store.rates().count() == 1


def test_failed_attempts_are_counted_and_rates_recorded(spark, tmp_path):
    store, source, offsets = make_store(spark, tmp_path), str(tmp_path / "in"), str(tmp_path / "cp")
    for i in range(2):
        batch = deliveries_of(spark, [envelope(f"a{i}", iso(T0 + i)), "oops"], [T0 * 1000 + 1000] * 2, first_offset=2 * i)
        batch.coalesce(1).write.mode("append").parquet(source)
    monitor = IngestMonitor(store)
    spark.streams.addListener(monitor)

    def run(sink=None):
        stream = file_stream(spark, source, max_files_per_trigger=1)
        query = stream_ingest(stream, store, offsets, lambda: F.col("timestamp"), dead_letter_sink=sink, monitor=monitor)
        query.awaitTermination()

    def down(letters):
        raise OSError("topic is down")

    try:
        for _ in range(2):
            with pytest.raises(StreamingQueryException, match="topic is down"):
                run(down)
        totals = store.metrics().agg(F.sum("write_error").alias("e"), F.sum("success").alias("s")).first()
        assert (totals.e, totals.s) == (2, 0)
        run()
        deadline = time.time() + 60
        while store.rates().count() < 2 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(monitor)
    assert sorted(r.rows for r in store.rates().collect()) == [2, 2]
    assert json.loads(store.rates().first().committed) == {}
    totals = store.metrics().agg(*[F.sum(c).alias(c) for c in ("success", "parse_error", "write_error")]).first()
    assert tuple(totals) == (2, 2, 2)
    store.register_views()
    assert spark.sql("SELECT sum(write_error) AS n FROM ingest_metrics").first().n == 2
