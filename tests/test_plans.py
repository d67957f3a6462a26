"""Shape of the physical plans that matter at scale."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import functions as F
from test_store import T0, contents, make_store, put

from tidegate import session
from tidegate.config import InboxConfig
from tidegate.operators.latest import upsert_latest
from tidegate.operators.window_queries import drain_position, window_counts, window_size_audit
from tidegate.plans.catalog import _decoded, _events
from tidegate.plans.drain import drain_tasks, ordered_events
from tidegate.session import spread

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schema(df) -> str:
    return re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)


def stored(spark, tmp_path, **config):
    store = make_store(spark, tmp_path, **config)
    put(store, [(s, f"id{s}", s) for s in range(30)], "b0")
    return store


def test_upsert_cuts_duplicates_before_the_exchange(spark, tmp_path):
    text = plan(upsert_latest(stored(spark, tmp_path).accepted()))
    assert text.count("Exchange hashpartitioning") == 1
    before_exchange = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_counts_and_audit_do_not_read_the_payload(spark, tmp_path):
    store = stored(spark, tmp_path)
    counts = read_schema(window_counts(store.accepted()))
    assert counts == "window_bucket:bigint,event_ts:timestamp,event_id:string"
    assert "payload:" not in read_schema(window_size_audit(store.accepted(), store.config))


def test_window_filter_reaches_the_scan(spark, tmp_path):
    text = plan(stored(spark, tmp_path).accepted(T0, T0 + 5))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(window_bucket", text)


def test_retention_filter_reaches_the_scan(spark, tmp_path):
    text = plan(stored(spark, tmp_path).live(F.timestamp_seconds(F.lit(T0))))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ingest_time", text)


def test_drain_is_one_upsert_and_one_ordered_exchange(spark, tmp_path):
    text = plan(ordered_events(stored(spark, tmp_path).accepted(), 30, InboxConfig()))
    assert text.count("Exchange hashpartitioning(window_bucket") == 1
    assert text.count("Exchange ") == 2 and "rangepartitioning(window_bucket" in text or "SinglePartition" in text
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning")[1]


def exchanged(df) -> list[str]:
    """What every exchange of the physical plan hands on."""
    node, found = df._jdf.queryExecution().executedPlan(), []

    def walk(n):
        if "Exchange" in n.nodeName() and "Broadcast" not in n.nodeName():
            found.append(n.output().mkString(","))
        below = n.children()
        for i in range(below.size()):
            walk(below.apply(i))
        if n.nodeName() == "AdaptiveSparkPlan":
            walk(n.executedPlan())

    walk(node)
    return found


def test_payloads_pass_no_exchange_beyond_a_size(spark, tmp_path, monkeypatch):
    rows = [[(i % 40, f"id{i % 40}", i) for i in range(100)], [(s, f"id{s}", 200) for s in range(5)]]
    plain = make_store(spark, tmp_path / "plain")
    store = make_store(spark, tmp_path / "by_address", address_from_bytes=0)
    for each in (plain, store):
        for n, batch in enumerate(rows):
            put(each, batch, f"b{n}")
    expected = contents(plain.inbox())
    assert len(expected) == 40 and contents(store.inbox()) == expected
    assert any("payload" in columns for columns in exchanged(plain.inbox()))
    assert not any("payload" in columns for columns in exchanged(store.inbox()))
    assert contents(store.inbox(T0 + 5, T0 + 10)) == contents(plain.inbox(T0 + 5, T0 + 10))
    # Compaction hands its writer rows that were not exchanged either, and leaves one row per key.
    written = []
    keep = type(store).write_segment
    monkeypatch.setattr(type(store), "write_segment", lambda self, df: written.append(df) or keep(self, df))
    store.drop(store.compact())
    assert not any("payload" in columns for columns in exchanged(written[0]))
    assert store.accepted().count() == 40 and contents(store.inbox()) == expected


def test_with_too_many_overwritten_rows_whole_rows_are_exchanged(spark, tmp_path):
    store = make_store(spark, tmp_path, address_from_bytes=0, most_overwritten=1)
    put(store, [(0, "a", i) for i in range(4)], "b0")
    assert contents(store.inbox()) == [(0, "a", 3)]
    assert any("payload" in columns for columns in exchanged(store.inbox()))


def test_percentiles_parse_the_text_once(spark):
    from tidegate.plans.catalog import CATALOG

    assert "from_json" not in plan(CATALOG["latency_percentiles"](spark, SF))
    assert "from_json" not in plan(CATALOG["windows_gapfilled_narrow"](spark, SF))


def test_lookups_and_replays_read_only_their_folders(spark):
    from tidegate.plans.catalog import CATALOG

    for name in ("key_lookup", "replay_range"):
        folders = {re.search(r"storage_bucket=(\d+)", f).group(1) for f in CATALOG[name](spark, SF).inputFiles()}
        assert 1 <= len(folders) <= (1 if name == "key_lookup" else 17)


def test_positions_do_not_gather_a_window(spark, tmp_path):
    text = plan(drain_position(stored(spark, tmp_path).accepted().select("window_bucket", "event_ts", "event_id")))
    assert "partitionBy" not in text and not re.search(r"Window \[row_number", text)


def test_text_is_parsed_once_even_behind_a_filter(spark):
    assert plan(_events(spark, SF)).count("from_json(") == 1
    assert plan(_decoded(spark, SF).where("reason IS NOT NULL")).count("from_json(") == 1


def test_no_join_by_cartesian_product(spark):
    from tidegate.plans.catalog import CATALOG

    for name in ("late_behind_ledger", "drain_reconcile", "late_side_output", "latency_percentiles"):
        text = plan(CATALOG[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_spread_only_adds_an_exchange_when_splits_are_few(spark):
    cores = spark.sparkContext.defaultParallelism
    assert "Exchange" in plan(spread(spark.range(100, numPartitions=1)))
    assert "Exchange" not in plan(spread(spark.range(100, numPartitions=cores)))


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1_000)
    cores = spark.sparkContext.defaultParallelism
    rows = spread(spark.range(40_000, numPartitions=cores))
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert rows.rdd.getNumPartitions() == 40 and max(sizes) < 3_000
    assert sorted(r.id for r in rows.collect()) == list(range(40_000))


def test_tasks_of_a_drain_do_not_grow_with_small_files():
    small = InboxConfig(rows_per_file=10)
    assert [drain_tasks(n, small) for n in (0, 5, 95, 2_000, 1_700_000)] == [1, 1, 10, 200, 200]
    assert drain_tasks(100_000_000, small) == 1_000
    assert [drain_tasks(n, InboxConfig()) for n in (1, 250_000, 100_000_000)] == [1, 3, 1_000]


def test_no_local_checkpoint_and_no_row_udf_in_the_package():
    root = Path(__file__).resolve().parents[1] / "tidegate"
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for banned in ("localCheckpoint", "F.udf", "pandas_udf", "mapPartitions", "crossJoin", "toPandas"):
        assert banned not in text
