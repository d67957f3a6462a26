from __future__ import annotations

import pytest
from conftest import events_of
from pyspark.sql import functions as F

from tidegate.config import CONFIGURED, InboxConfig
from tidegate.functions.windows import (
    bootstrap_cursor,
    is_sealed,
    last_sealed_bucket,
    latest_cursor,
    window_bucket,
)
from tidegate.operators.window_queries import (
    GAP_FAN_OUT,
    drain_position,
    ordered_window,
    window_range,
    windows_gapfilled,
)


@pytest.mark.parametrize(
    ("second", "bucket"),
    [(0, 0), (7, 5), (1784194884, 1784194880), (1784194885, 1784194885), (1784194887, 1784194885), (-7, -5)],
)
def test_bucket(spark, second, bucket):
    df = spark.range(1).select(window_bucket(F.timestamp_seconds(F.lit(second)), 5).alias("b"))
    assert df.first().b == bucket


def test_bucket_before_1970_with_fraction_truncates(spark):
    df = spark.range(1).select(window_bucket(F.timestamp_millis(F.lit(-7500)), 5).alias("b"))
    assert df.first().b == -5


@pytest.mark.parametrize(("offset", "sealed"), [(14, False), (15, True), (115, True)])
def test_seal_boundary_is_inclusive(spark, offset, sealed):
    config = InboxConfig(window_seconds=5, allowed_lateness_seconds=10)
    bucket = 1784194885
    df = spark.range(1).select(is_sealed(F.lit(bucket), bucket + offset, config).alias("s"))
    assert df.first().s is sealed
    assert (last_sealed_bucket(bucket + offset, config) >= bucket) is sealed


def test_latest_cursor():
    config = InboxConfig()
    assert latest_cursor(1_000_000_080, config) == 1_000_000_010
    assert latest_cursor(10, config) == 0
    assert latest_cursor(67, config) == 0


def test_bootstrap_order():
    config = InboxConfig(bootstrap=CONFIGURED, start_bucket=1_784_194_887)
    now = 1_784_200_000
    assert bootstrap_cursor(1_784_194_900, now, config) == 1_784_194_900
    assert bootstrap_cursor(None, now, config) == 1_784_194_880
    for start in (0, -5, 3):
        fallback = InboxConfig(bootstrap=CONFIGURED, start_bucket=start)
        assert bootstrap_cursor(None, now, fallback) == latest_cursor(now, fallback)
    with pytest.raises(ValueError, match="not a multiple"):
        bootstrap_cursor(1_784_194_901, now, config)


@pytest.mark.parametrize("n", [1, 2, GAP_FAN_OUT, GAP_FAN_OUT + 1, 3 * GAP_FAN_OUT + 7])
def test_window_range_is_complete(spark, n):
    bounds = spark.sql(f"SELECT 1000L AS first, 1000L + {(n - 1) * 5}L AS last")
    rows = sorted(r.window_bucket for r in window_range(bounds, 5).collect())
    assert rows == list(range(1000, 1000 + n * 5, 5))


def test_gap_fill(spark):
    events = events_of(spark, [(1_000_000, "a"), (1_000_001, "b"), (1_021_000, "c"), (1_021_000, "c")])
    rows = windows_gapfilled(events, 5).orderBy("window_bucket").collect()
    assert [tuple(r) for r in rows] == [(1000, 2), (1005, 0), (1010, 0), (1015, 0), (1020, 1)]
    assert windows_gapfilled(events.where("false"), 5).count() == 0


def test_order_and_positions(spark):
    rows = [(ms, f"id{i}") for i in range(7) for ms in (1_000_000, 1_000_500, 1_003_000, 1_006_000)]
    events = events_of(spark, rows).repartition(3)
    ordered = [(r.window_bucket, r.event_ts, r.event_id) for r in ordered_window(events, 5).collect()]
    assert ordered == sorted(ordered) and len(ordered) == 28
    placed = drain_position(events).orderBy("window_bucket", "position").collect()
    assert [(r.window_bucket, r.event_ts, r.event_id) for r in placed] == ordered
    assert [r.position for r in placed] == [*range(1, 22), *range(1, 8)]


def test_size_estimate_and_config_checks():
    wrong = {
        "window_seconds": 0,
        "allowed_lateness_seconds": -1,
        "bootstrap": "x",
        "drain_id": "a/b",
        "rows_per_file": 0,
    }
    for name, value in wrong.items():
        with pytest.raises(ValueError):
            InboxConfig(**{name: value})
