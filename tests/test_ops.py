from __future__ import annotations

import random

import pytest
from conftest import events_of
from pyspark.sql import functions as F

from tidegate.config import InboxConfig
from tidegate.operators.lag import lag_summary, offset_lag
from tidegate.operators.latency import latency_histogram, percentiles, throughput
from tidegate.operators.progress import (
    cursor_of,
    drain_reconcile,
    late_arrivals,
    late_side_output,
    undrained_windows,
)
from tidegate.operators.window_queries import window_counts, window_size_audit
from tidegate.sources.offsets import next_offsets, offsets_frame, progress_offsets

CONFIG = InboxConfig()


def test_lag_skips_partitions_without_an_end_offset(spark):
    committed = offsets_frame(spark, {"t": {"0": 10, "1": 25, "2": 7}})
    end = offsets_frame(spark, {"t": {"0": 12, "1": 20}})
    lag = offset_lag(committed, end)
    assert {r.partition: r.lag for r in lag.collect()} == {0: 2, 1: 0}
    row = lag_summary(lag, CONFIG).first()
    assert (row.largest_lag, row.total_lag, row.partitions, row.max_lag) == (2, 2, 2, 10_000)


def test_nothing_committed_is_zero_lag(spark):
    row = lag_summary(offset_lag(offsets_frame(spark, None), offsets_frame(spark, None)), CONFIG).first()
    assert (row.largest_lag, row.total_lag, row.partitions) == (0, 0, 0)


def test_offsets_from_query_progress(spark):
    progress = {"sources": [{"endOffset": '{"t":{"0":5}}', "latestOffset": {"t": {"0": 9}}}]}
    committed, end = progress_offsets(spark, progress)
    assert offset_lag(committed, end).first().lag == 4


def test_next_offsets(spark):
    rows = spark.sql("SELECT 't' topic, 0 partition, explode(array(3L, 8L)) offset")
    assert next_offsets(rows).first().offset == 9
    assert next_offsets(rows, F.col("offset") < 8).first().offset == 4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_percentiles_equal_the_sorted_list(spark, seed):
    rng = random.Random(seed)
    scale = [3, 5_000, 10_000_000][seed - 1]
    values = [rng.randrange(-scale // 4, scale) for _ in range(rng.choice([1, 20, 777]))]
    histogram = spark.createDataFrame([(v,) for v in values], "latency_ms bigint").groupBy("latency_ms").agg(
        F.count("*").alias("n")
    )
    fractions = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    got = {r.p: r.latency_ms for r in percentiles(histogram, fractions).collect()}
    ordered = sorted(values)
    assert got == {p: ordered[min(int(len(values) * p), len(values) - 1)] for p in fractions}


def test_latency_and_throughput(spark):
    events = events_of(spark, [(1000, "a", 1500), (2000, "b", 2500), (3000, "c", 5500)])
    assert {r.latency_ms: r.n for r in latency_histogram(events).collect()} == {500: 2, 2500: 1}
    row = throughput(events).first()
    assert (row.deliveries, row.elapsed_seconds, row.per_second) == (3, 4.0, 0.75)
    assert throughput(events.where("event_id = 'a'")).first().per_second is None


def test_size_audit_flags_large_windows(spark):
    events = events_of(spark, [(1000, "a"), (2000, "b"), (6000, "c")]).withColumn("payload_bytes", F.lit(60))
    rows = window_size_audit(events, InboxConfig(window_warn_bytes=100)).collect()
    assert {r.window_bucket: (r.event_count, r.payload_bytes, r.oversized) for r in rows} == {
        0: (2, 120, True),
        5: (1, 60, False),
    }


def test_ledger_reconciliation_and_late_output(spark):
    rows = [
        (100_000, "a", 101_000),
        (100_000, "a", 300_000),  # redelivered late: not a new event
        (101_000, "late", 165_000),  # sealed at 165 s, boundary counts as late
        (104_000, "b", 164_999),
        (115_000, "c", 116_000),
        (400_000, "open", 401_000),
    ]
    events = events_of(spark, rows)
    drained = [("primary", b, {100: 2, 115: 1}.get(b, 0)) for b in range(100, 140, 5)]
    ledger = events.sparkSession.createDataFrame(drained, "drain_id string, window_bucket bigint, event_count bigint")
    changed = drain_reconcile(events, ledger, "primary").where("late_rows <> 0").collect()
    assert [(r.window_bucket, r.recorded, r.actual, r.late_rows) for r in changed] == [(100, 2, 3, 1)]
    emitted = events.where("event_id IN ('a', 'b', 'c')")
    late = late_side_output(events, emitted, ledger, "primary").collect()
    assert [r.event_id for r in late] == ["late"]
    open_windows = undrained_windows(window_counts(events), ledger, "primary").collect()
    assert [r.window_bucket for r in open_windows] == [400]
    assert undrained_windows(window_counts(events), ledger, "other").count() == 3
    behind = late_arrivals(events, cursor_of(ledger, "primary"))
    assert behind.count() == 5
    assert late_arrivals(events, cursor_of(ledger, "other")).count() == 0


@pytest.mark.parametrize(("cursor", "late"), [(1784194890, 1), (1784194885, 1), (0, 0)])
def test_late_rule(spark, cursor, late):
    events = events_of(spark, [(1784194887000, "a")])
    assert late_arrivals(events, cursor).count() == late
