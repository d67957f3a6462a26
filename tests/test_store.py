from __future__ import annotations

import random

import pytest
from conftest import deliveries_of, envelope
from pyspark.sql import functions as F

from tidegate.config import InboxConfig
from tidegate.schema import COUNTERS
from tidegate.session import exists, list_dirs
from tidegate.sources.store import MAX_LEDGER_SEGMENTS, MERGED, InboxStore
from tidegate.streaming.ingest import ingest_batch

T0 = 1_784_196_000


def make_store(spark, tmp_path, **config):
    # The instants are fixed: a test that is not about retention must not meet it.
    return InboxStore(spark, str(tmp_path / "inbox"), InboxConfig(**{"inbox_ttl_seconds": 10**10, **config}))


def put(store, rows, segment, first_offset=0):
    """Rows of (second after T0, id, ingest second after T0) ingested as one batch."""
    values = [envelope(i, iso(T0 + s)) for s, i, _ in rows]
    arrivals = [(T0 + a) * 1000 for _, _, a in rows]
    batch = deliveries_of(store.spark, values, arrivals, first_offset=first_offset)
    return ingest_batch(store, batch, segment, F.col("timestamp"))


def iso(second):
    from datetime import datetime, timezone

    return datetime.fromtimestamp(second, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def contents(df):
    return sorted((r.window_bucket - T0, r.event_id, int(r.ingest_time.timestamp()) - T0) for r in df.collect())


def test_replayed_segment_changes_nothing(spark, tmp_path):
    store = make_store(spark, tmp_path)
    rows = [(0, "a", 1), (3, "b", 2), (3600, "c", 3601), (0, "a", 9)]
    for _ in range(2):
        put(store, rows, "batch-0")
    assert store.accepted().count() == 4
    assert contents(store.inbox()) == [(0, "a", 9), (0, "b", 2), (3600, "c", 3601)]
    assert store.metrics().count() == 1


def test_any_delivery_order_gives_the_same_inbox(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(20), f"id{rng.randrange(6)}", 100 + i) for i in range(40)]
    seen = []
    for seed in range(2):
        store = make_store(spark, tmp_path / str(seed))
        random.Random(seed).shuffle(rows)
        put(store, rows[:25], "batch-0")
        put(store, rows[20:], "batch-1")
        seen.append(contents(store.inbox()))
    assert seen[0] == seen[1]


def test_reads_only_the_needed_folders(spark, tmp_path):
    store = make_store(spark, tmp_path)
    put(store, [(0, "a", 1), (3600, "b", 3601), (7200, "c", 7201)], "batch-0")
    files = store.accepted(T0 + 3600, T0 + 3605).inputFiles()
    assert files and all(f"storage_bucket={T0 + 3600}/" in f for f in files)
    assert contents(store.inbox(T0 + 3600, T0 + 3605)) == [(3600, "b", 3601)]
    assert store.accepted(T0 + 90_000, T0 + 90_005).count() == 0


def test_windows_wider_than_a_storage_folder(spark, tmp_path):
    store = make_store(spark, tmp_path, window_seconds=7000)
    put(store, [(0, "a", 1), (6999, "b", 7000), (9000, "c", 9001)], "batch-0")
    first = T0 // 7000 * 7000
    assert store.accepted(first, first).count() + store.accepted(first + 7000, first + 14_000).count() == 3


def test_compaction_keeps_the_inbox_and_leaves_one_row_per_key(spark, tmp_path):
    store = make_store(spark, tmp_path, rows_per_file=2)
    put(store, [(s, f"id{s}", 10 + s) for s in range(6)], "batch-0")
    put(store, [(s, f"id{s}", 50 + s) for s in range(4)], "batch-1")
    before = contents(store.inbox())
    old = store.compact()
    assert contents(store.inbox()) == before
    put(store, [(0, "id0", 99)], "batch-2")
    store.drop(old)
    assert contents(store.inbox()) == sorted([*before[1:], (0, "id0", 99)])
    assert store.accepted().count() == 7
    assert len(list_dirs(spark, f"{store.deliveries_path}/outcome=accepted/storage_bucket={T0}")) == 2


def test_compacted_folders_are_read_without_an_exchange(spark, tmp_path):
    store = make_store(spark, tmp_path)
    put(store, [(0, "a", 1), (0, "a", 2), (3600, "b", 3601)], "batch-0")
    store.drop(store.compact())
    physical = lambda: store.inbox()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in physical()
    assert contents(store.inbox()) == [(0, "a", 2), (3600, "b", 3601)]
    put(store, [(0, "a", 9), (1, "c", 9)], "batch-1")
    assert physical().count("Exchange") == 1
    assert contents(store.inbox()) == [(0, "a", 9), (0, "c", 9), (3600, "b", 3601)]
    assert contents(store.inbox(T0 + 3600, T0 + 3605)) == [(3600, "b", 3601)]


def test_expiry(spark, tmp_path):
    store = make_store(spark, tmp_path, inbox_ttl_seconds=100)
    put(store, [(0, "a", 10), (3600, "b", 20), (3600, "b", 200)], "batch-0")
    now = lambda s: F.timestamp_seconds(F.lit(T0 + s))
    assert store.live(now(109)).count() == 3
    assert store.live(now(110)).count() == 2
    assert store.expire(T0 + 110) == []
    assert store.expire(T0 + 111) == [T0]
    assert contents(store.inbox(now=now(150))) == [(3600, "b", 200)]


def test_reads_hide_expired_rows_of_shared_folders(spark, tmp_path):
    store = make_store(spark, tmp_path, inbox_ttl_seconds=60)
    put(store, [(0, "old", 1), (1, "new", 100)], "batch-0")
    now = F.timestamp_seconds(F.lit(T0 + 110))
    assert contents(store.inbox(now=now)) == [(0, "new", 100)]
    store.drop(store.compact())
    assert contents(store.inbox(now=now)) == [(0, "new", 100)]
    store.register_views()
    assert spark.table("inbox").count() == store.inbox().count()


def test_a_write_during_expiry_survives(spark, tmp_path, monkeypatch):
    store = make_store(spark, tmp_path, inbox_ttl_seconds=100)
    put(store, [(0, "a", 10)], "batch-0")
    plain = InboxStore._read_folders

    def read_then_write(self, paths):
        rows = plain(self, paths)
        if any("outcome=accepted" in p for p in paths):
            monkeypatch.setattr(InboxStore, "_read_folders", plain)
            put(store, [(1, "late", 300)], "batch-1")
        return rows

    monkeypatch.setattr(InboxStore, "_read_folders", read_then_write)
    assert store.expire(T0 + 301) == [T0]
    assert contents(store.inbox(now=F.timestamp_seconds(F.lit(T0 + 301)))) == [(0, "late", 300)]


def sums(store):
    return tuple(store.metrics().agg(*[F.sum(c) for c in COUNTERS]).first())


def test_old_counters_are_merged_and_a_replayed_batch_counts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidegate.sources.store.MAX_LEDGER_SEGMENTS", 2)
    store = make_store(spark, tmp_path)
    names = [f"{query}-{i:010d}" for query in ("q1", "q2") for i in range(3)]
    for i, name in enumerate(names):
        put(store, [(i, f"id{i}", i + 1)], name)
    store.count_failure(names[2])
    assert sums(store) == (6, 0, 0, 1)
    store.expire(T0)
    # The newest batch of each query may come again and keeps its row.
    assert sums(store) == (6, 0, 0, 1) and len(list_dirs(spark, store.metrics_path)) == 3
    for i in (2, 5):
        put(store, [(i, f"id{i}", i + 1)], names[i])
    assert sums(store) == (6, 0, 0, 1)
    put(store, [(9, "id9", 10)], "q1-0000000003")
    store.expire(T0)
    assert sums(store) == (7, 0, 0, 1) and len(list_dirs(spark, store.metrics_path)) == 3


def test_an_interrupted_merge_of_counters_counts_nothing_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidegate.sources.store.MAX_LEDGER_SEGMENTS", 2)
    store = make_store(spark, tmp_path)
    for i in range(5):
        put(store, [(i, f"id{i}", i + 1)], f"q-{i:010d}")
    monkeypatch.setattr(InboxStore, "drop", lambda self, folders: None)
    store.expire(T0)
    assert sums(store)[0] == 5 and len(list_dirs(spark, store.metrics_path)) == 6
    store.expire(T0)
    assert sums(store)[0] == 5
    monkeypatch.undo()
    monkeypatch.setattr("tidegate.sources.store.MAX_LEDGER_SEGMENTS", 2)
    store.expire(T0)
    assert sums(store)[0] == 5 and len(list_dirs(spark, store.metrics_path)) == 2


def test_old_counters_expire(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidegate.sources.store.MAX_LEDGER_SEGMENTS", 1)
    store = make_store(spark, tmp_path)
    for i in range(3):
        put(store, [(i, f"id{i}", i + 1)], f"q-{i:010d}")
    store.expire(2 * T0)
    assert sums(store)[0] == 1


def test_how_far_source_partitions_have_come(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidegate.sources.store.MAX_LEDGER_SEGMENTS", 1)
    store = make_store(spark, tmp_path)
    assert store.stream_clock() is None
    for i in range(3):
        put(store, [(20 - i, f"id{i}", 30 + i)], f"q-{i:010d}", first_offset=5 * i)
    ingest_batch(store, deliveries_of(spark, ["bad"], [T0 * 1000], partition=1), "q-0000000003", F.col("timestamp"))

    def state():
        rows = store.partitions().collect()
        return {r.partition: (r.next_offset, r.high_event_ts and int(r.high_event_ts.timestamp()) - T0) for r in rows}

    assert state() == {0: (11, 20), 1: (1, None)}
    store.expire(T0)
    assert state() == {0: (11, 20), 1: (1, None)} and len(list_dirs(spark, store.partitions_path)) == 1
    assert store.stream_clock() == T0 + 20 and store.stream_clock(expected=2) is None


def test_dead_letters_are_merged_without_losing_any(spark, tmp_path):
    store = make_store(spark, tmp_path)
    for i in range(4):
        ingest_batch(store, deliveries_of(spark, [f"bad{i}", "same"], [T0 * 1000] * 2, first_offset=2 * i), f"b-{i}", F.col("timestamp"))
    ingest_batch(store, deliveries_of(spark, ["bad0"], [T0 * 1000]), "again", F.col("timestamp"))
    nowhere = deliveries_of(spark, ["lost", "lost"], [T0 * 1000] * 2).withColumn("offset", F.lit(None).cast("long"))
    ingest_batch(store, nowhere, "nowhere", F.col("timestamp"))
    before = sorted(r.value for r in store.dead_letters().collect())
    assert before == ["bad0", "bad0", "bad1", "bad2", "bad3", "lost", "lost", "same", "same", "same", "same"]
    old = store.compact()
    assert len(old) == 6
    put(store, [(0, "a", 1)], "later")
    ingest_batch(store, deliveries_of(spark, ["new"], [T0 * 1000], first_offset=90), "newer", F.col("timestamp"))
    expected = sorted(["bad0", "bad1", "bad2", "bad3", "lost", "lost", "new", "same", "same", "same", "same"])
    store.drop(old)
    assert sorted(r.value for r in store.dead_letters().collect()) == expected
    store.drop(store.compact())
    assert sorted(r.value for r in store.dead_letters().collect()) == expected
    assert len(store.read("rejected").inputFiles()) == 1


def test_ids_have_filters(spark, tmp_path):
    store = make_store(spark, tmp_path)
    put(store, [(i, f"id{i}", i) for i in range(50)], "b0")
    (path,) = store.accepted().inputFiles()
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
        )
    )
    columns = footer.getFooter().getBlocks()[0].getColumns()
    filtered = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0}
    footer.close()
    assert filtered == {"event_id"}


def test_files_of_a_batch_do_not_follow_its_tasks(spark, tmp_path):
    store = make_store(spark, tmp_path)
    values = [envelope(f"e{i}", iso(T0 + i)) for i in range(64)] + ["bad"]
    ingest_batch(store, deliveries_of(spark, values).repartition(16), "batch-0", F.col("timestamp"))
    assert len(store.accepted().inputFiles()) + len(store.read("rejected").inputFiles()) <= 3


def test_dead_letter_sink_reads_its_own_segment_only(spark, tmp_path, monkeypatch):
    store = make_store(spark, tmp_path)
    for i in range(3):
        put(store, [(i, f"id{i}", i)], f"old-{i}")
        ingest_batch(store, deliveries_of(spark, ["bad"], [T0 * 1000]), f"older-{i}", F.col("timestamp"))
    listed, got = [], []
    monkeypatch.setattr("tidegate.sources.store.list_dirs", lambda s, p: listed.append(p) or list_dirs(s, p))
    letters = lambda df: got.extend(df.collect())
    batch = deliveries_of(spark, ["worse", envelope("a", iso(T0))], [T0 * 1000] * 2)
    ingest_batch(store, batch, "now", F.col("timestamp"), dead_letter_sink=letters)
    assert [r.value for r in got] == ["worse"]
    assert not any("storage_bucket" in p for p in listed)


def test_empty_store_has_typed_empty_tables(spark, tmp_path):
    store = make_store(spark, tmp_path)
    store.register_views()
    for view in ("inbox", "drain_progress", "dead_letter", "ingest_metrics"):
        assert spark.table(view).count() == 0
    assert store.last_drained("primary") is None
    assert store.compact() == []


def test_dead_letters_keep_key_and_value(spark, tmp_path):
    store = make_store(spark, tmp_path)
    batch = deliveries_of(spark, ["oops", envelope("a", iso(T0))]).withColumn("key", F.lit("k1"))
    counters = ingest_batch(store, batch, "batch-0", F.col("timestamp"))
    assert counters == {"success": 1, "parse_error": 1, "late_arrival": 0}
    (row,) = store.dead_letters().collect()
    assert (row.key, row.value, row.reason, row.offset) == ("k1", "oops", "not_json", 0)


def test_rebalanced_writes_store_the_same(spark, tmp_path):
    store = make_store(spark, tmp_path, rebalance_writes=True)
    values = [envelope(f"e{i}", iso(T0 + i)) for i in range(50)] + ["bad"]
    batch = deliveries_of(spark, values).repartition(8)
    ingest_batch(store, batch, "batch-0", F.col("timestamp"))
    assert (store.inbox().count(), store.dead_letters().count()) == (50, 1)
    files = store.accepted().inputFiles()
    assert len(files) == 1


def ledger(spark, drain_id, buckets, at):
    rows = [(drain_id, b, 1) for b in buckets]
    df = spark.createDataFrame(rows, "drain_id string, window_bucket bigint, event_count bigint")
    return df.withColumn("drained_at", F.timestamp_seconds(F.lit(at)))


def test_ledger_is_idempotent_per_drain_identity(spark, tmp_path):
    store = make_store(spark, tmp_path)
    for _ in range(2):
        store.append_progress(ledger(spark, "primary", [T0, T0 + 5], T0 + 100))
    store.append_progress(ledger(spark, "other", [T0 + 50], T0 + 100))
    assert store.progress().count() == 3
    assert store.last_drained("primary") == T0 + 5
    assert store.last_drained("other") == T0 + 50
    assert store.last_drained("nobody") is None


def test_ledger_retention_loses_the_cursor(spark, tmp_path):
    store = make_store(spark, tmp_path, progress_ttl_seconds=1000)
    store.append_progress(ledger(spark, "primary", [T0], T0))
    assert store.last_drained("primary", T0 + 999) == T0
    assert store.last_drained("primary", T0 + 1000) is None


def test_merged_ledgers_are_spread_over_files(spark, tmp_path):
    store = make_store(spark, tmp_path, rows_per_file=10, progress_ttl_seconds=1000)
    store.append_progress(ledger(spark, "primary", [T0 + 5 * i for i in range(60)], T0 + 500))
    store.append_progress(ledger(spark, "primary", [T0 - 5], T0))
    store.forget_progress("primary", T0 + 200, T0 + 1200)
    assert sorted(r.window_bucket for r in store.progress().collect()) == [T0 + 5 * i for i in range(40)]
    files = lambda: len(list(tmp_path.rglob(f"segment=*{MERGED}/*.parquet")))
    assert 2 <= files() <= 4
    store.compact_progress("primary", T0 + 1200)
    assert files() >= 4 and store.progress().count() == 40


def test_ledger_compaction_and_forgetting(spark, tmp_path):
    store = make_store(spark, tmp_path)
    for i in range(5):
        store.append_progress(ledger(spark, "primary", [T0 + 5 * i], T0 + 100))
    path = f"{store.progress_path}/drain_id=primary"
    store.compact_progress("primary", T0 + 200)
    assert len(list_dirs(spark, path)) == 6
    store.compact_progress("primary", T0 + 200)
    names = list_dirs(spark, path)
    assert len(names) == 2 and all(n.endswith(MERGED) for n in names)
    assert store.progress().count() == 5
    store.forget_progress("primary", T0 + 10)
    assert store.last_drained("primary") == T0 + 5
    assert MAX_LEDGER_SEGMENTS > 5 and not store.ledger_is_fragmented("primary")


def test_shared_folder_is_the_configured_one(spark):
    from tidegate.session import fresh_dir, shared_dir

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert fresh_dir(spark, "x").startswith(configured) and not exists(spark, fresh_dir(spark, "x"))


@pytest.mark.parametrize("bad", [{"storage_seconds": 0}])
def test_config(bad):
    with pytest.raises(ValueError):
        InboxConfig(**bad)


def test_events_of_any_age_are_stored_found_and_drained(spark, tmp_path):
    from tidegate.plans.drain import replay_windows
    from tidegate.sinks.window_files import json_files

    store = make_store(spark, tmp_path, inbox_ttl_seconds=10**10)
    stamps = {
        "0001-01-01T00:00:00Z": -62135596800,
        "1800-06-01T12:00:03Z": -5351572797,
        "1969-12-31T23:59:53Z": -7,
        "1970-01-01T00:00:03Z": 3,
        "9999-12-31T23:59:59Z": 253402300799,
    }
    values = [envelope(f"e{i}", stamp) for i, stamp in enumerate(stamps)]
    ingest_batch(store, deliveries_of(spark, values, [T0 * 1000] * 5), "batch-0", F.col("timestamp"))
    store.drop(store.compact())
    buckets = {r.event_id: r.window_bucket for r in store.inbox().select("event_id", "window_bucket").collect()}
    assert buckets == {f"e{i}": int(s / 5) * 5 for i, s in enumerate(stamps.values())}
    for event_id, bucket in buckets.items():
        found = store.inbox(bucket, bucket).select("event_id").collect()
        assert [r.event_id for r in found] == [event_id]
    out = str(tmp_path / "out")
    for bucket in (-5, 0):
        replay_windows(store, json_files(out), bucket, bucket, "old", T0, T0)
    lines = spark.read.schema("eventId string, eventTs string").json(out).collect()
    assert sorted((r.eventId, r.eventTs) for r in lines) == [
        ("e2", "1969-12-31T23:59:53Z"),
        ("e3", "1970-01-01T00:00:03Z"),
    ]
