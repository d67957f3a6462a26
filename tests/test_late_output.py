"""Late events as an output of their own, tick by tick."""

from __future__ import annotations

import pytest
from test_store import T0, make_store, put

from tidegate.config import CONFIGURED
from tidegate.plans.drain import drain
from tidegate.plans.late_output import emit_late, late_name
from tidegate.sinks.window_files import parquet_files
from tidegate.sources.store import InboxStore

CONFIG = {"allowed_lateness_seconds": 10, "bootstrap": CONFIGURED, "start_bucket": T0, "late_output": True}


class Sink:
    """Remembers what each call was given, in the order of the rows."""

    def __init__(self):
        self.calls = {}

    def __call__(self, events, windows, drain_id):
        rows = [(r.window_bucket - T0, r.event_id) for r in events.collect()]
        counts = {r.window_bucket - T0: r.event_count for r in windows.collect()}
        self.calls[drain_id] = (rows, counts)


def drained(spark, tmp_path, **config):
    store = make_store(spark, tmp_path, **{**CONFIG, **config})
    put(store, [(0, "a", 1), (1, "b", 1), (7, "c", 8)], "b0")
    drain(store, Sink(), T0 + 20, T0 + 20)
    return store


def test_each_late_event_comes_once_and_in_order(spark, tmp_path):
    store, sink = drained(spark, tmp_path), Sink()
    assert emit_late(store, sink, T0 + 30).events == 0
    # Redelivered, late in both windows, not drained yet, and before the first drained window.
    put(store, [(1, "b", 25), (8, "z", 25), (2, "y", 25), (30, "open", 25), (-5, "older", 25)], "b1")
    run = emit_late(store, sink, T0 + 40)
    assert (run.tick, run.segments, run.windows, run.events) == (1, 2, 2, 2)
    assert sink.calls == {late_name("primary", 1): ([(0, "y"), (5, "z")], {0: 1, 5: 1})}
    assert emit_late(store, sink, T0 + 40).segments == 0
    put(store, [(2, "y", 45), (3, "x", 45), (3, "x", 46)], "b2")
    assert emit_late(store, sink, T0 + 50).events == 1
    assert sink.calls[late_name("primary", 2)] == ([(0, "x")], {0: 1})
    # The open window drains whole; nothing of it is late afterwards.
    main = Sink()
    drain(store, main, T0 + 60, T0 + 60)
    assert [r for r in main.calls["primary"][0]] == [(30, "open")]
    assert emit_late(store, sink, T0 + 60).events == 0 and len(sink.calls) == 2


def test_expired_rows_are_not_late_output(spark, tmp_path):
    store, sink = drained(spark, tmp_path, inbox_ttl_seconds=100), Sink()
    put(store, [(2, "old", 25), (3, "new", 90)], "b1")
    assert emit_late(store, sink, T0 + 130).events == 1
    assert sink.calls == {late_name("primary", 0): ([(0, "new")], {0: 1})}


def test_a_failing_sink_gets_the_same_tick_again(spark, tmp_path):
    store = drained(spark, tmp_path)
    put(store, [(2, "y", 25)], "b1")
    names = []

    def broken(events, windows, drain_id):
        names.append(drain_id)
        raise OSError("disk full")

    for _ in range(2):
        with pytest.raises(OSError, match="disk full"):
            emit_late(store, broken, T0 + 30)
    sink = Sink()
    put(store, [(3, "x", 31)], "b2")
    emit_late(store, sink, T0 + 32)
    assert set(names) == set(sink.calls) == {late_name("primary", 0)}
    assert sink.calls[names[0]][0] == [(0, "y"), (0, "x")]


def test_a_crash_behind_the_sink_repeats_the_tick_only(spark, tmp_path, monkeypatch):
    store, out = drained(spark, tmp_path), str(tmp_path / "late")
    put(store, [(2, "y", 25)], "b1")
    with monkeypatch.context() as patch:
        patch.setattr(InboxStore, "append_emitted", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            emit_late(store, parquet_files(out), T0 + 30)
    emit_late(store, parquet_files(out), T0 + 30)
    assert [r.event_id for r in spark.read.parquet(out).collect()] == ["y"]


def test_reads_new_segments_and_their_folders_only(spark, tmp_path, monkeypatch):
    store = drained(spark, tmp_path, storage_seconds=5)
    emit_late(store, Sink(), T0 + 30)
    put(store, [(6, "z", 25)], "b1")
    read, logs = [], []
    plain, emitted = InboxStore._read_folders, InboxStore.emitted
    monkeypatch.setattr(InboxStore, "_read_folders", lambda self, p: read.extend(p) or plain(self, p))
    monkeypatch.setattr(InboxStore, "emitted", lambda self, d, b=None: logs.append(b) or emitted(self, d, b))
    emit_late(store, Sink(), T0 + 40)
    assert [p.rsplit("/", 2)[1:] for p in read] == [[f"storage_bucket={T0 + 5}", "segment=b1"]]
    assert logs == [[T0 + 5]]


def test_compaction_and_expiry_keep_the_late_output_right(spark, tmp_path):
    store, sink = drained(spark, tmp_path), Sink()
    put(store, [(2, "y", 25)], "b1")
    emit_late(store, sink, T0 + 30)
    put(store, [(3, "x", 35)], "b2")
    store.drop(store.compact())
    emit_late(store, sink, T0 + 40)
    assert [rows for rows, _ in sink.calls.values()] == [[(0, "y")], [(0, "x")]]
    # The names of segments that are gone are not kept.
    assert store.examined_segments("primary")[1] == set(store.segment_folders())
    store.expire(T0 + 50)
    assert store.emitted("primary").count() == 5
    store.expire(T0 + 2 * 10**10)
    assert store.emitted("primary").count() == 0


def test_identities_have_logs_of_their_own(spark, tmp_path):
    from dataclasses import replace

    store = drained(spark, tmp_path)
    other = replace(store, config=replace(store.config, drain_id="other"))
    assert emit_late(other, Sink(), T0 + 30).segments == 0
    put(store, [(2, "y", 25)], "b1")
    drain(other, Sink(), T0 + 30, T0 + 30)
    assert emit_late(other, Sink(), T0 + 30).events == 0
    assert emit_late(store, Sink(), T0 + 30).events == 1


def test_without_a_log_there_is_no_late_output(spark, tmp_path):
    store = make_store(spark, tmp_path)
    with pytest.raises(ValueError, match="late_output"):
        emit_late(store, Sink(), T0)


def test_a_redrained_window_replaces_its_log(spark, tmp_path):
    store = drained(spark, tmp_path)
    store.forget_progress("primary", T0)
    put(store, [(2, "y", 25)], "b1")
    drain(store, Sink(), T0 + 20, T0 + 20)
    assert store.emitted("primary").count() == 4
    assert store.emitted("primary", [T0 - 3600]).count() == 0
    assert emit_late(store, Sink(), T0 + 30).events == 0
