"""Sinks for drained windows.

A sink is called as ``sink(events, windows, drain_id)``: ``events`` holds whole
windows in drain order, ``windows`` one row (window_bucket, event_count) per
window, empty ones included. Runs come in ascending order of their windows. A sink
must be idempotent; raising means the windows are not recorded and will come again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.timestamps import iso_utc
from tidegate.schema import EVENT_COLUMNS
from tidegate.session import delete_dir, exists, list_dirs

WindowSink = Callable[[DataFrame, DataFrame, str], None]

# Record names of a window line, in line order.
LINE_NAMES = [
    "windowBucket",
    "eventTs",
    "eventId",
    "guid",
    "operation",
    "requestName",
    "applicationId",
    "clientAddress",
    "ingestTime",
    "payload",
]


def line_columns() -> list[Column]:
    """Event columns under their line names; instants as ISO-8601 UTC text."""
    as_text = {"event_ts", "ingest_time"}
    return [
        (iso_utc(F.col(c)) if c in as_text else F.col(c)).alias(name)
        for c, name in zip(EVENT_COLUMNS, LINE_NAMES, strict=True)
    ]


def line_json() -> Column:
    """One event as a JSON line; the payload stays one escaped string."""
    return F.to_json(F.struct(*line_columns()))


DAY_SECONDS = 86_400


def window_day() -> Column:
    """Start of the UTC day of a window: the folder level above it, which keeps every listing short."""
    return (F.floor(F.col("window_bucket") / DAY_SECONDS) * DAY_SECONDS).cast("bigint")


def _write_windows(lines: DataFrame, fmt: str, path: str) -> None:
    (
        lines.withColumn("day", window_day())
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "window_bucket")
        .save(path)
    )


def _remove_stale(windows: DataFrame, path: str) -> None:
    """Folders of windows that are empty now but were written by an earlier attempt.

    Lists the days of this run only. Both collects are bounded by max_windows_per_run.
    """
    spark = windows.sparkSession
    empty = windows.where("event_count = 0").select(window_day().alias("day"), "window_bucket").collect()
    if not empty or not exists(spark, path):
        return
    existing = {
        f"day={day}/{d}" for day in {r.day for r in empty} for d in list_dirs(spark, f"{path}/day={day}")
    }
    for row in empty:
        name = f"day={row.day}/window_bucket={row.window_bucket}"
        if name in existing:
            delete_dir(spark, f"{path}/{name}")


def json_files(output_path: str) -> WindowSink:
    """JSON lines under ``drain_id=<id>/day=<d>/window_bucket=<b>/``.

    A rewritten window replaces its folder. Part file names follow drain order
    when a window has more than one.
    """

    def write(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        path = f"{output_path}/drain_id={drain_id}"
        _remove_stale(windows, path)
        _write_windows(events.select("window_bucket", *line_columns()), "json", path)

    return write


def parquet_files(output_path: str) -> WindowSink:
    """The same folders with typed Parquet rows."""

    def write(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        path = f"{output_path}/drain_id={drain_id}"
        _remove_stale(windows, path)
        _write_windows(events.select(*EVENT_COLUMNS), "parquet", path)

    return write


def kafka_topic(servers: str, topic: str, **options: str) -> WindowSink:
    """Lines to a topic, keyed by window so that one window stays in one partition.

    Delivery is at least once: windows that come again are written again. Several tasks
    may write one window at the same time, so readers order its lines by ``eventTs`` and
    ``eventId``, and drop repeated ones by these and ``windowBucket``.
    """

    def write(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        records = events.select(
            F.col("window_bucket").cast("string").alias("key"), line_json().alias("value")
        )
        writer = records.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).options(**options).save()

    return write
