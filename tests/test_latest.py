from __future__ import annotations

import random

from conftest import deliveries_of, envelope, events_of, instant
from pyspark.sql import functions as F

from tidegate.functions.envelope import decode
from tidegate.operators.latest import dedup_stats, key_lookup, upsert_latest
from tidegate.operators.outcomes import ingest_counters, valid_events, with_ingest_time


def accepted(spark, values, arrivals=None):
    decoded = decode(deliveries_of(spark, values, arrivals), 5)
    return with_ingest_time(decoded, F.col("timestamp"))


def test_redelivery_is_one_row_and_three_writes(spark):
    value = envelope("demo-event-001", "2026-07-16T10:00:00Z")
    decoded = accepted(spark, [value] * 3, [1000, 2000, 3000])
    rows = upsert_latest(valid_events(decoded)).collect()
    assert [(r.window_bucket, r.event_id) for r in rows] == [(1784196000, "demo-event-001")]
    assert ingest_counters(decoded).first().success == 3
    assert dedup_stats(valid_events(decoded)).first().asDict() == {
        "deliveries": 3,
        "distinct_events": 1,
        "redeliveries": 2,
        "max_copies": 3,
    }


def test_same_id_other_time_is_another_row(spark):
    values = [envelope("x", "2026-07-16T10:00:00Z"), envelope("x", "2026-07-16T10:00:05Z")]
    rows = upsert_latest(valid_events(accepted(spark, values))).orderBy("window_bucket").collect()
    assert [r.window_bucket for r in rows] == [1784196000, 1784196005]


def test_times_equal_to_the_millisecond_are_one_row(spark):
    values = [envelope("x", f"2026-07-16T10:00:00.0001{d}Z") for d in (1, 9)]
    rows = upsert_latest(valid_events(accepted(spark, values, [1000, 2000]))).collect()
    assert [r.payload for r in rows] == [values[1]]


def test_demo_batch_windows(spark):
    values = [envelope(f"e{s}", f"2026-07-16T10:00:{s:02d}Z") for s in (1, 3, 6, 8, 11)]
    rows = valid_events(accepted(spark, values)).groupBy("window_bucket").count().collect()
    assert {r[0]: r[1] for r in rows} == {1784196000: 2, 1784196005: 2, 1784196010: 1}


def test_last_write_wins_in_any_order(spark):
    rng = random.Random(7)
    writes = [
        (1000 + 1000 * rng.randrange(20), f"id{rng.randrange(4)}", rng.randrange(5), i, f"p{i}")
        for i in range(200)
    ]
    expected = {}
    for w in sorted(writes, key=lambda w: (w[2], w[3])):
        expected[(w[0], w[1])] = w[4]
    for seed in range(3):
        random.Random(seed).shuffle(writes)
        rows = upsert_latest(events_of(spark, writes).repartition(5)).collect()
        got = {(int(r.event_ts.timestamp() * 1000), r.event_id): r.payload for r in rows}
        assert got == expected


def test_hot_key_keeps_only_its_last_write(spark):
    base = events_of(spark, [(5_000, "hot")]).drop("offset", "payload")
    hot = base.crossJoin(spark.range(20_000).select(F.col("id").alias("offset"))).withColumn(
        "payload", F.col("offset").cast("string")
    )
    (row,) = upsert_latest(hot.repartition(8)).collect()
    assert row.payload == "19999"


def test_key_lookup(spark):
    events = events_of(spark, [(5_000, "a"), (5_000, "a"), (5_000, "b")])
    row = key_lookup(events, 5, F.lit(instant(5_000)), "a").first()
    assert (row.stored_rows, row.copies) == (1, 2)
    assert key_lookup(events, 10, F.lit(instant(5_000)), "a").count() == 0
