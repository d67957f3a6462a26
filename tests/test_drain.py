from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_store import T0, iso, make_store, put

from tidegate.config import CONFIGURED
from tidegate.plans.drain import drain, ordered_events, replay_windows, window_ledger
from tidegate.sinks.window_files import LINE_NAMES, json_files, parquet_files
from tidegate.sources.store import InboxStore

CONFIG = {"allowed_lateness_seconds": 10, "bootstrap": CONFIGURED, "start_bucket": T0}


def ledger_of(store):
    return {r.window_bucket - T0: r.event_count for r in store.progress().collect()}


def window_lines(path, bucket, drain_id="primary"):
    folder = Path(path) / f"drain_id={drain_id}" / f"day={bucket // 86400 * 86400}" / f"window_bucket={bucket}"
    files = sorted(folder.glob("part-*"))
    return [json.loads(line) for f in files for line in f.read_text().splitlines()]


def test_drains_sealed_windows_in_order_with_empty_ones(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(4, "b", 5), (1, "z", 5), (1, "a", 6), (1, "a", 7), (11, "c", 12), (16, "open", 17)], "b0")
    out = str(tmp_path / "out")
    run = drain(store, json_files(out), T0 + 25, T0 + 26)
    assert (run.first, run.last, run.windows, run.events) == (T0, T0 + 10, 3, 4)
    assert ledger_of(store) == {0: 3, 5: 0, 10: 1}
    lines = window_lines(out, T0)
    assert [x["eventId"] for x in lines] == ["a", "z", "b"]
    assert list(lines[0]) == LINE_NAMES
    assert (lines[0]["eventTs"], lines[0]["ingestTime"]) == (iso(T0 + 1), iso(T0 + 7))
    assert json.loads(lines[0]["payload"])["id"] == "a"


def test_seal_boundary(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    sink = json_files(str(tmp_path / "out"))
    assert drain(store, sink, T0 + 14, T0).windows == 0
    assert ledger_of(store) == {}
    assert drain(store, sink, T0 + 15, T0).windows == 1
    assert ledger_of(store) == {0: 0}


def test_resumes_after_the_ledger_and_drains_once(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(s, f"id{s}", s) for s in range(20)], "b0")
    sink = json_files(str(tmp_path / "out"))
    assert drain(store, sink, T0 + 20, T0 + 20).last == T0 + 5
    again = InboxStore(spark, store.root, store.config)
    run = drain(again, sink, T0 + 30, T0 + 30)
    assert (run.first, run.last) == (T0 + 10, T0 + 15)
    assert drain(again, sink, T0 + 30, T0 + 30).windows == 0
    assert ledger_of(store) == {0: 5, 5: 5, 10: 5, 15: 5}


def test_latest_bootstrap_skips_history(spark, tmp_path):
    store = make_store(spark, tmp_path)
    put(store, [(0, "old", 1), (100, "new", 101)], "b0")
    run = drain(store, json_files(str(tmp_path / "out")), T0 + 168, T0 + 168)
    assert (run.first, run.last, run.events) == (T0 + 100, T0 + 100, 1)


def test_failing_sink_records_nothing_and_is_retried(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(0, "a", 1)], "b0")
    out = str(tmp_path / "out")

    def broken(events, windows, drain_id):
        json_files(out)(events, windows, drain_id)
        raise OSError("sink is down")

    with pytest.raises(OSError, match="sink is down"):
        drain(store, broken, T0 + 15, T0 + 15)
    assert ledger_of(store) == {}
    put(store, [(0, "a", 3), (2, "b", 2)], "b1")
    drain(store, json_files(out), T0 + 15, T0 + 15)
    assert [x["eventId"] for x in window_lines(out, T0)] == ["a", "b"]
    assert ledger_of(store) == {0: 2}


def test_redrained_window_that_is_empty_now_loses_its_files(spark, tmp_path):
    store = make_store(spark, tmp_path, inbox_ttl_seconds=100, **CONFIG)
    put(store, [(0, "a", 1), (6, "b", 90)], "b0")
    out = str(tmp_path / "out")
    sink = parquet_files(out)
    replay_windows(store, sink, T0, T0 + 5, "again", T0 + 50, T0 + 50)
    folder = Path(out) / "drain_id=again"
    assert len(list(folder.glob("*/window_bucket=*"))) == 2
    replay_windows(store, sink, T0, T0 + 5, "again", T0 + 150, T0 + 150)
    assert [p.name for p in folder.glob("*/window_bucket=*")] == [f"window_bucket={T0 + 5}"]


def test_bounded_runs_cover_a_long_backlog(spark, tmp_path):
    store = make_store(spark, tmp_path, max_windows_per_run=4, **CONFIG)
    put(store, [(s, f"id{s}", s) for s in range(0, 50, 3)], "b0")
    sink = parquet_files(str(tmp_path / "out"))
    calls = []

    def counted(events, windows, drain_id):
        calls.append(windows.count())
        sink(events, windows, drain_id)

    run = drain(store, counted, T0 + 60, T0 + 60)
    assert (calls, run.windows, run.events, run.first, run.last) == ([4, 4, 2], 10, 17, T0, T0 + 45)
    assert sum(ledger_of(store).values()) == 17
    assert drain(store, counted, T0 + 60, T0 + 60).windows == 0


def test_a_failing_run_keeps_the_ledger_of_earlier_ones(spark, tmp_path):
    store = make_store(spark, tmp_path, max_windows_per_run=2, **CONFIG)
    put(store, [(s, f"id{s}", s) for s in range(20)], "b0")
    sink, calls = parquet_files(str(tmp_path / "out")), []

    def second_breaks(events, windows, drain_id):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("sink is down")
        sink(events, windows, drain_id)

    with pytest.raises(OSError, match="sink is down"):
        drain(store, second_breaks, T0 + 30, T0 + 30)
    assert ledger_of(store) == {0: 5, 5: 5}
    run = drain(store, sink, T0 + 30, T0 + 31)
    assert (run.first, run.last) == (T0 + 10, T0 + 15)


def test_windows_of_any_size_come_in_ascending_order(spark, tmp_path):
    store = make_store(spark, tmp_path, rows_per_file=10, **CONFIG)
    put(store, [(i % 5, f"id{i}", 9) for i in range(40)] + [(11, "one", 12)], "b0")
    met = []

    def watch(events, windows, drain_id):
        met.append([r.window_bucket - T0 for r in events.select("window_bucket").toLocalIterator()])

    drain(store, watch, T0 + 30, T0 + 30)
    assert met == [[0] * 40 + [10]]


def test_late_output_compares_keys_not_counts(spark, tmp_path):
    from tidegate.operators.progress import drain_reconcile, late_side_output

    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(0, "a", 1), (1, "b", 1)], "b0")
    out = str(tmp_path / "out")
    drain(store, parquet_files(out), T0 + 15, T0 + 15)
    emitted = spark.read.parquet(f"{out}/drain_id=primary")
    put(store, [(0, "a", 1), (2, "z", 20), (7, "open", 20)], "b1")
    now = store.accepted().where("event_id <> 'b'")
    late = late_side_output(now, emitted, store.progress(), "primary")
    assert [r.event_id for r in late.collect()] == ["z"]
    lost = drain_reconcile(now.where("event_id = 'open'"), store.progress(), "primary")
    rows = sorted((r.window_bucket - T0, r.recorded, r.actual, r.late_rows) for r in lost.collect())
    assert rows == [(0, 2, 0, -2), (5, None, 1, None)]
    assert late._jdf.queryExecution().optimizedPlan().toString().count("outcome") <= 2 * late.count() + 2


def test_a_second_record_within_a_second_wins(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(0, "a", 1), (1, "b", 2)], "b0")
    sink = parquet_files(str(tmp_path / "out"))
    replay_windows(store, sink, T0, T0, "again", T0 + 50, T0 + 50)
    short = InboxStore(spark, store.root, type(store.config)(inbox_ttl_seconds=48, **CONFIG))
    replay_windows(short, sink, T0, T0, "again", T0 + 50, T0 + 50)
    assert [r.event_count for r in store.progress().collect()] == [0]


def test_replay_uses_its_own_identity(spark, tmp_path):
    store = make_store(spark, tmp_path, max_windows_per_run=2, **CONFIG)
    put(store, [(s, f"id{s}", s) for s in range(20)], "b0")
    out = str(tmp_path / "out")
    drain(store, json_files(out), T0 + 30, T0 + 30)
    runs = replay_windows(store, json_files(out), T0 + 6, T0 + 90, "replay", T0 + 30, T0 + 31)
    assert [(r.first - T0, r.last - T0) for r in runs] == [(5, 10), (15, 15)]
    assert len(window_lines(out, T0 + 5, "replay")) == 5
    assert (store.last_drained("primary"), store.last_drained("replay")) == (T0 + 15, T0 + 15)


def test_forgotten_windows_drain_again(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(0, "a", 1), (6, "b", 7)], "b0")
    sink = json_files(str(tmp_path / "out"))
    drain(store, sink, T0 + 20, T0 + 20)
    put(store, [(7, "late", 22)], "b1")
    store.forget_progress("primary", T0 + 5)
    run = drain(store, sink, T0 + 20, T0 + 23)
    assert (run.first, run.events) == (T0 + 5, 2)


def test_late_output_hands_on_only_segments_that_hold_late_keys(spark, tmp_path, monkeypatch):
    from tidegate.operators import progress

    store = make_store(spark, tmp_path, late_output=True, **CONFIG)
    put(store, [(i % 5, f"id{i}", 1) for i in range(40)], "b0")
    drain(store, parquet_files(str(tmp_path / "out")), T0 + 15, T0 + 15)
    put(store, [(0, "id0", 20), (2, "z", 20), (2, "z", 30), (7, "open", 20)], "b1")
    put(store, [(1, "id1", 25)], "b2")
    put(store, [(2, "z", 25)], "b3")
    handed = []
    keep = progress.upsert_latest
    monkeypatch.setattr(progress, "upsert_latest", lambda rows: handed.append(rows) or keep(rows))
    late = progress.late_side_output(store.accepted(), store.emitted("primary"), store.progress(), "primary")
    assert [(r.event_id, r.ingest_time.timestamp() - T0) for r in late.collect()] == [("z", 30)]
    assert {r.segment for r in handed[0].select("segment").collect()} == {"b1", "b3"}


def test_misaligned_ledger_is_an_error(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    drain(store, json_files(str(tmp_path / "out")), T0 + 20, T0 + 20)
    other = InboxStore(spark, store.root, type(store.config)(window_seconds=7))
    with pytest.raises(ValueError, match="not a multiple"):
        drain(other, json_files(str(tmp_path / "out")), T0 + 40)


def test_large_window_spreads_over_ordered_files(spark, tmp_path):
    store = make_store(spark, tmp_path, rows_per_file=20, **CONFIG)
    rows = [(i % 4, f"id{i:03d}", 10 + i) for i in range(150)] + [(7, "small", 8)]
    put(store, rows + rows[:40], "b0")
    out = str(tmp_path / "out")
    run = drain(store, json_files(out), T0 + 20, T0 + 20)
    assert run.events == 151
    files = list((Path(out) / "drain_id=primary").glob(f"day=*/window_bucket={T0}/part-*"))
    assert len(files) > 3
    got = [(x["eventTs"], x["eventId"]) for x in window_lines(out, T0)]
    assert got == sorted(got) and len(got) == 150
    assert len(window_lines(out, T0 + 5)) == 1


def test_hot_key_does_not_make_a_window_hot_for_long(spark, tmp_path):
    store = make_store(spark, tmp_path, rows_per_file=30, **CONFIG)
    put(store, [(1, "hot", i) for i in range(100)] + [(2, "b", 1)], "b0")
    ledger = window_ledger(store.accepted(), T0, T0, store.config)
    row = ledger.first()
    assert (row.event_count, row.deliveries) == (2, 101)
    rows = ordered_events(store.accepted(), row.deliveries, store.config).collect()
    assert sorted((r.event_id, int(r.ingest_time.timestamp()) - T0) for r in rows) == [("b", 1), ("hot", 99)]


def test_line_json_names_and_escaping(spark, tmp_path):
    from conftest import events_of

    from tidegate.sinks.window_files import line_json

    events = events_of(spark, [(5_120, 'q"\\é', 5_120, 0, '{"a":"b"}')])
    line = json.loads(events.select(line_json().alias("l")).first().l)
    assert list(line) == LINE_NAMES
    assert (line["eventId"], line["payload"]) == ('q"\\é', '{"a":"b"}')
    assert line["eventTs"] == "1970-01-01T00:00:05.120Z"


def test_event_count_matches_files(spark, tmp_path):
    store = make_store(spark, tmp_path, **CONFIG)
    put(store, [(s % 15, f"id{s % 11}", s) for s in range(60)], "b0")
    out = str(tmp_path / "out")
    drain(store, parquet_files(out), T0 + 60, T0 + 60)
    per_file = spark.read.parquet(f"{out}/drain_id=primary").groupBy("window_bucket").agg(F.count("*").alias("n"))
    files = {r.window_bucket - T0: r.n for r in per_file.collect()}
    assert files == {b: n for b, n in ledger_of(store).items() if n}
