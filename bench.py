"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

# Parse and split, upsert, windows, ledger, storage, drain, streaming.
HEADLINE = [
    "parse_events",
    "ingest_counters",
    "upsert_latest",
    "window_counts",
    "latency_percentiles",
    "window_size_audit",
    "windows_gapfilled_narrow",
    "drain_reconcile",
    "late_side_output",
    "write_inbox",
    "compacted_inbox",
    "drain_files",
    "drain_cycle",
    "stream_ingest",
    "seal_by_event_time",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # The test table is one small file: split it so that every core reads.
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def filled(spark: SparkSession) -> dict[str, float]:
    """Fills and drains the stores that several queries read, timed by themselves."""
    from tidegate.plans.catalog import _narrow_outage, _outage

    times = {}
    for name, make in (("fill_hourly", _outage), ("fill_narrow", _narrow_outage)):
        start = time.perf_counter()
        make(spark, SF_DIR)
        times[name] = round(time.perf_counter() - start, 3)
    return times


def prepared(spark: SparkSession) -> dict[str, float]:
    """Read, compaction and drain of a store that is filled before the clock starts."""
    from tidegate.plans.catalog import AFTER, _history
    from tidegate.plans.drain import drain
    from tidegate.session import fresh_dir
    from tidegate.sinks.window_files import json_files

    def clocked(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    store = _history(spark, SF_DIR)
    times = {"read_alone": round(seconds(store.inbox), 3)}
    times["drain_alone"] = clocked(lambda: drain(store, json_files(fresh_dir(spark, "windows")), AFTER, AFTER))
    times["compact_alone"] = clocked(store.compact)
    return times


def main() -> None:
    from tidegate.plans.catalog import CATALOG
    from tidegate.sources.synthetic import deliveries, read_events

    spark = session()
    rows = deliveries(read_events(spark, SF_DIR)).count()
    names = os.environ["BENCH_ONLY"].split(",") if "BENCH_ONLY" in os.environ else HEADLINE
    times = {}
    # Ahead of the queries that read these stores, so that none of them is timed with or without the fill by chance.
    fills = filled(spark) if "BENCH_ONLY" not in os.environ else {}
    for name in names:
        best = min(seconds(lambda: CATALOG[name](spark, SF_DIR)) for _ in range(REPEATS))
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    if "BENCH_ONLY" not in os.environ:
        times |= fills | prepared(spark)
    print(
        json.dumps(
            {
                "metric": "inbox_headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "deliveries": rows,
                "deliveries_per_sec": {n: round(rows / t) for n, t in times.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
