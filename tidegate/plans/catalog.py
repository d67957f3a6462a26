"""Every query of the inbox over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.config import CONFIGURED, InboxConfig
from tidegate.functions.envelope import decode, is_blank
from tidegate.functions.windows import seal_time, window_bucket
from tidegate.operators import latency as latency_ops
from tidegate.operators import progress as ledger_ops
from tidegate.operators import window_queries as win
from tidegate.operators.clock import stream_clock
from tidegate.operators.lag import lag_summary, offset_lag
from tidegate.operators.latest import dedup_stats, key_counts, key_lookup, upsert_latest
from tidegate.operators.outcomes import (
    dead_letter_summary,
    dead_letters,
    is_late,
    valid_events,
    with_ingest_time,
)
from tidegate.operators.sketches import latency_estimates, redelivery_estimates
from tidegate.plans.drain import drain, drain_by_stream_clock, ordered_events, replay_windows, window_ledger
from tidegate.plans.late_output import emit_late, late_name
from tidegate.plans.rebuild import active_store, drop_superseded, rebuild
from tidegate.schema import COUNTERS, EVENT, EVENT_KEY
from tidegate.session import configure, cut_lineage, fresh_dir
from tidegate.sinks.published_files import PublishedWindows
from tidegate.sinks.window_files import LINE_NAMES, json_files, line_json, parquet_files
from tidegate.sources.deliveries import file_batch
from tidegate.sources.offsets import next_offsets
from tidegate.sources.store import InboxStore
from tidegate.sources.synthetic import deliveries, read_events, stream_events
from tidegate.streaming.ingest import ingest_batch, stream_ingest
from tidegate.streaming.monitor import IngestMonitor, stream_throughput
from tidegate.streaming.sealing import seal_by_event_time

Query = Callable[[SparkSession, str], DataFrame]

# The test events are thin and span a month: one storage folder per day, few files in each.
# They are from 2024, so the retention must not hide them.
TEN_YEARS = 10 * 365 * 86_400
NARROW = InboxConfig(
    window_seconds=5,
    allowed_lateness_seconds=60,
    storage_seconds=86_400,
    inbox_ttl_seconds=TEN_YEARS,
    progress_ttl_seconds=TEN_YEARS,
)
HOURLY = replace(NARROW, window_seconds=3600)

# 2024-01-16T12:01:00Z, inside the month of the test events.
NOW = 1_705_406_460
# 2024-02-01T00:00:00Z, after every test event.
AFTER = 1_706_745_600
# This source partition is down until after the drain: all its deliveries are late.
LATE_PARTITION = 4
# Of these source partitions one stops two days before NOW, the other is read to its end; the rest up to NOW.
BEHIND_PARTITION, AHEAD_PARTITION = 1, 2
BEHIND_UNTIL = NOW - 2 * 86_400
# Between NOW and the end of the events lie more than 14 days, between the stopped partition and it more than 16.
IDLE_SECONDS = 15 * 86_400
LATE_TTL = 10 * 86_400

CATALOG: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(fn: Query) -> Query:
        CATALOG[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        return fn

    return register


# -- inputs ------------------------------------------------------------------


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(read_events(spark, sf_dir))


def _decoded(spark: SparkSession, sf_dir: str, config: InboxConfig = NARROW) -> DataFrame:
    rows = decode(_deliveries(spark, sf_dir), config.window_seconds)
    return with_ingest_time(rows, F.col("timestamp"))


def _events(spark: SparkSession, sf_dir: str, config: InboxConfig = NARROW) -> DataFrame:
    return valid_events(_decoded(spark, sf_dir, config))


def _stored(spark: SparkSession, sf_dir: str, config: InboxConfig) -> InboxStore:
    """A store on the shared folder, filled from the test deliveries."""
    store = InboxStore(spark, fresh_dir(spark, "inbox"), config)
    ingest_batch(store, _deliveries(spark, sf_dir), "batch-0", F.col("timestamp"))
    return store


def _from_first(store: InboxStore, **changes) -> InboxStore:
    """The same store with a drain that starts at the first stored window."""
    first = store.accepted().agg(F.min("window_bucket").alias("b")).first()["b"]
    return replace(store, config=replace(store.config, bootstrap=CONFIGURED, start_bucket=first, **changes))


def _history(spark: SparkSession, sf_dir: str) -> InboxStore:
    return _from_first(_stored(spark, sf_dir, HOURLY))


# Stores that several queries read and none changes, one per session and input: the text is parsed and drained once.
_STORES: dict[tuple[str, str, str], object] = {}


def _shared(spark: SparkSession, sf_dir: str, make: Callable[[SparkSession, str], object]):
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
    if key not in _STORES:
        _STORES[key] = make(spark, sf_dir)
    return _STORES[key]


def _at(epoch: int) -> Column:
    """The time of a read."""
    return F.timestamp_seconds(F.lit(epoch))


def _discard(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
    """A sink that only has the events computed."""
    events.write.format("noop").mode("overwrite").save()


def _hourly_outage(spark: SparkSession, sf_dir: str) -> InboxStore:
    """An hourly inbox drained at NOW, after which the late partition was ingested."""
    rows = _deliveries(spark, sf_dir)
    store = InboxStore(spark, fresh_dir(spark, "inbox"), HOURLY)
    ingest_batch(store, rows.where(F.col("partition") != LATE_PARTITION), "in-time", F.col("timestamp"))
    store = _from_first(store)
    drain(store, _discard, NOW, NOW)
    ingest_batch(store, rows.where(F.col("partition") == LATE_PARTITION), "late", F.col("timestamp"))
    return store


def _outage(spark: SparkSession, sf_dir: str) -> InboxStore:
    return _shared(spark, sf_dir, _hourly_outage)


def _streamed_outage(spark: SparkSession, sf_dir: str) -> InboxStore:
    """An inbox of 5-second windows drained at NOW; then the late partition comes as a stream whose first attempt fails."""
    rows = _deliveries(spark, sf_dir).where(F.col("partition") != LATE_PARTITION)
    store = InboxStore(spark, fresh_dir(spark, "inbox"), replace(NARROW, late_output=True))
    ingest_batch(store, rows, "in-time", F.col("timestamp"))
    store = _from_first(store, max_windows_per_run=1_000_000)
    drain(store, _discard, NOW, NOW)

    attempts = []

    def down_at_first(letters: DataFrame) -> None:
        attempts.append(1)
        if len(attempts) == 1:
            raise OSError("dead letter topic is down")

    stream = deliveries(stream_events(spark, sf_dir)).where(F.col("partition") == LATE_PARTITION)
    offsets, monitor = fresh_dir(spark, "offsets"), IngestMonitor(store)
    for _ in range(2):
        run = stream_ingest(
            stream, store, offsets, lambda: F.col("timestamp"), dead_letter_sink=down_at_first, monitor=monitor
        )
        try:
            run.awaitTermination()
        except StreamingQueryException:
            # The failure is what the counter is for; the next run replays the batch.
            continue
        monitor.collect(run)
    monitor.flush()
    return store


def _narrow_outage(spark: SparkSession, sf_dir: str) -> InboxStore:
    return _shared(spark, sf_dir, _streamed_outage)


def _uneven_store(spark: SparkSession, sf_dir: str) -> InboxStore:
    """An hourly inbox in which one source partition has stopped early and one is far ahead."""
    until = (
        F.when(F.col("partition") == BEHIND_PARTITION, BEHIND_UNTIL)
        .when(F.col("partition") == AHEAD_PARTITION, AFTER)
        .otherwise(NOW)
    )
    store = InboxStore(spark, fresh_dir(spark, "inbox"), HOURLY)
    rows = _deliveries(spark, sf_dir).where(F.unix_seconds("timestamp") < until)
    ingest_batch(store, rows, "batch-0", F.col("timestamp"))
    return _from_first(store)


def _uneven(spark: SparkSession, sf_dir: str) -> InboxStore:
    return _shared(spark, sf_dir, _uneven_store)


def _plain_columns() -> list[Column | str]:
    """Event columns with instants as epoch milliseconds."""
    return [
        "window_bucket",
        F.unix_millis("event_ts").alias("event_ts_ms"),
        "event_id",
        "guid",
        "operation",
        "request_name",
        "application_id",
        "client_address",
        F.unix_millis("ingest_time").alias("ingest_ms"),
        "payload",
    ]


def _plain(events: DataFrame) -> DataFrame:
    return events.select(*_plain_columns())


def _keys(events: DataFrame) -> DataFrame:
    return events.select(
        "window_bucket", F.unix_millis("event_ts").alias("event_ts_ms"), "event_id"
    )


# -- scans -------------------------------------------------------------------


@query("scan_deliveries")
def scan_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "landed")
    _deliveries(spark, sf_dir).write.parquet(path)
    rows = file_batch(spark, path)
    return rows.select(
        "key", "value", "topic", "partition", "offset", F.unix_millis("timestamp").alias("arrival_ms")
    )


@query("scan_window")
def scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hourly window, in drain order."""
    store = _stored(spark, sf_dir, HOURLY)
    newest = store.accepted().agg(F.max("window_bucket").alias("b")).first()["b"]
    return win.scan_window(store.inbox(newest, newest), newest).select(*_plain_columns())


@query("scan_progress")
def scan_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger of a drain."""
    store = _outage(spark, sf_dir)
    return store.progress().withColumn("drained_at", F.unix_seconds("drained_at"))


@query("scan_dead_letters")
def scan_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first stored dead letters by partition and offset."""
    store = _outage(spark, sf_dir)
    letters = store.dead_letters().select("key", "value", "partition", "offset")
    return letters.orderBy("partition", "offset").limit(20)


@query("sample_inbox")
def sample_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = upsert_latest(_events(spark, sf_dir)).select(
        "window_bucket", F.unix_millis("event_ts").alias("event_ts_ms"), "event_id", "operation"
    )
    return rows.orderBy("window_bucket", "event_ts_ms", "event_id").limit(20)


# -- projections -------------------------------------------------------------


@query("parse_events")
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted delivery as an event, redeliveries included."""
    events = _events(spark, sf_dir)
    return events.select("offset", *_plain_columns()).drop("payload")


@query("parse_texts")
def parse_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long multilingual texts through the envelope and back, unchanged."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = F.struct(
        F.col("source").alias("operation"),
        F.col("text").alias("requestName"),
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
    )
    texts = documents.select(
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), data.alias("data"))).alias("value")
    )
    parsed = decode(texts, NARROW.window_seconds).where("reason IS NULL")
    return parsed.select(
        F.col("event_id").cast("bigint").alias("doc_id"),
        F.col("operation").alias("source"),
        F.col("request_name").alias("text"),
        F.char_length("request_name").cast("bigint").alias("n_chars"),
    )


@query("resolve_event_ts")
def resolve_event_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time in micros before it is cut to storage precision, and which field it came from."""
    decoded = _decoded(spark, sf_dir).where("reason IS NULL")
    inner = F.get_json_object("value", "$.data.timestamp")
    micros = F.unix_micros(F.coalesce(inner, F.get_json_object("value", "$.time")).cast("timestamp"))
    return decoded.select(
        "offset",
        F.unix_millis("event_ts").alias("event_ts_ms"),
        micros.alias("sent_micros"),
        inner.isNull().alias("from_envelope"),
    )


@query("null_to_empty")
def null_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return events.groupBy("request_name").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("client_address") == "").alias("without_address"),
    )


@query("payload_verbatim")
def payload_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("offset", "payload")


@query("ingest_time")
def ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.unix_millis("ingest_time") - F.unix_millis("event_ts")
    return _events(spark, sf_dir).select(
        "offset", F.unix_millis("ingest_time").alias("ingest_ms"), delay.alias("delay_ms")
    )


@query("window_bucket")
def window_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window of every event under three window sizes."""
    events = read_events(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", *[window_bucket(ts, w).alias(f"bucket_{w}") for w in (5, 7, 3600)]
    )


@query("tumbling_window")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own tumbling window starts at the same bucket."""
    starts = F.window(F.col("ts").cast("timestamp"), "5 seconds")
    grouped = read_events(spark, sf_dir).groupBy(starts.alias("w")).agg(F.count("*").alias("events"))
    return grouped.select(F.unix_seconds("w.start").alias("window_bucket"), "events")


@query("seal_time")
def seal_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = _events(spark, sf_dir).select("window_bucket").distinct()
    return buckets.select("window_bucket", seal_time(F.col("window_bucket"), NARROW).alias("sealed_after"))


@query("sink_json")
def sink_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window line of every stored event, read back field by field."""
    line = upsert_latest(_events(spark, sf_dir)).select(line_json().alias("line"))
    names = [n for n in LINE_NAMES if n != "windowBucket"]
    fields = F.from_json("line", "windowBucket BIGINT, " + ", ".join(f"{n} STRING" for n in names))
    return line.select(fields.alias("f")).select("f.*")


# -- filters -----------------------------------------------------------------


@query("valid_events")
def accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("topic", "partition", "offset", "event_id")


@query("dead_letters")
def rejected_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(_decoded(spark, sf_dir))


@query("reject_reasons")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letter_summary(_decoded(spark, sf_dir))


@query("blank_id")
def blank_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which padded ids count as blank: Unicode white space does, a no-break space does not."""
    forms = F.array(F.lit(""), F.lit(" \t"), F.lit("\u2003"), F.lit("\u00a0"))
    form = F.element_at(forms, (F.col("event_id") % 4 + 1).cast("int"))
    return read_events(spark, sf_dir).select("event_id", is_blank(form).alias("blank"))


@query("key_lookup")
def lookup_most_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-key lookup of the most redelivered event of the inbox: one stored row, found in one storage folder."""
    store = _narrow_outage(spark, sf_dir)
    order = [F.col("copies").desc(), *EVENT_KEY]
    key = key_counts(store.accepted()).orderBy(*order).withColumn("ms", F.unix_millis("event_ts")).limit(1).first()
    bucket = key.window_bucket
    found = key_lookup(store.accepted(bucket, bucket), F.lit(bucket), F.timestamp_millis(F.lit(key.ms)), F.lit(key.event_id))
    return found.withColumn("event_ts_ms", F.unix_millis("event_ts")).drop("event_ts")


@query("sealed_windows")
def sealed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = win.window_counts(_events(spark, sf_dir))
    return win.sealed_windows(counts, NOW, NARROW)


@query("live_rows")
def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows still retained one day before the middle of the month."""
    rows = win.live_rows(_events(spark, sf_dir), F.timestamp_seconds(F.lit(NOW)), 86_400)
    return _keys(upsert_latest(rows))


@query("replay_range")
def replay_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events of every window from a start window on; earlier storage folders are not read."""
    store = _outage(spark, sf_dir)
    return _keys(store.inbox(first=NOW // HOURLY.window_seconds * HOURLY.window_seconds))


@query("inbox_ttl")
def inbox_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordinary read a day and a half after NOW: writes older than a day are hidden, also in shared folders."""
    store = _outage(spark, sf_dir)
    short = replace(store, config=replace(store.config, inbox_ttl_seconds=86_400))
    return _keys(short.inbox(now=_at(NOW + 129_600)))


# -- ledger against inbox ----------------------------------------------------


@query("late_arrivals")
def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes of the late batch at or behind the cursor the ledger held when they came."""
    store = _narrow_outage(spark, sf_dir)
    cursor = store.last_drained(store.config.drain_id)
    late = ledger_ops.late_arrivals(store.live(_at(AFTER)).where(F.col("segment") != "in-time"), cursor)
    return late.select("offset", "event_id", "window_bucket")


@query("late_behind_ledger")
def late_behind_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events at or behind the cursor the ledger holds."""
    store = _narrow_outage(spark, sf_dir)
    cursor = ledger_ops.cursor_of(store.progress(), store.config.drain_id)
    return _keys(ledger_ops.late_arrivals(store.inbox(now=_at(AFTER)), cursor))


@query("late_data_kept")
def late_data_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events stay in their natural window: all writes, and those that came after the window's drain."""
    store = _narrow_outage(spark, sf_dir)
    cursor = store.last_drained(store.config.drain_id)
    after = (F.col("segment") != "in-time") & is_late(F.col("window_bucket"), cursor)
    return store.live(_at(AFTER)).groupBy("window_bucket").agg(
        F.count("*").alias("writes"), F.count_if(after).alias("late_writes")
    )


@query("windows_gapfilled")
def windows_gapfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.windows_gapfilled(_events(spark, sf_dir, HOURLY), HOURLY.window_seconds)


@query("windows_gapfilled_narrow")
def windows_gapfilled_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.windows_gapfilled(_events(spark, sf_dir), NARROW.window_seconds)


@query("undrained_windows")
def undrained_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _outage(spark, sf_dir)
    windows = win.window_counts(store.live(_at(AFTER))).select("window_bucket", "event_count")
    return ledger_ops.undrained_windows(windows, store.progress(), store.config.drain_id)


@query("drain_reconcile")
def drain_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger against the inbox at NOW, with a retention that has just ended for what came on the first day."""
    store = _outage(spark, sf_dir)
    retention = NOW - (store.config.start_bucket + 86_400)
    short = replace(store, config=replace(store.config, inbox_ttl_seconds=retention))
    rows = short.live(_at(NOW))
    return ledger_ops.drain_reconcile(rows, store.progress(), store.config.drain_id)


@query("late_side_output")
def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events of drained windows that the log of emitted keys does not hold."""
    store = _narrow_outage(spark, sf_dir)
    drain_id = store.config.drain_id
    late = ledger_ops.late_side_output(store.live(_at(AFTER)), store.emitted(drain_id), store.progress(), drain_id)
    return _plain(late)


@query("late_output_ticks")
def late_output_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events as two ticks emit them: half of the late partition, then all of it again with an in-time one.

    What has expired by then comes out of neither.
    """
    rows = _deliveries(spark, sf_dir)
    late = rows.where(F.col("partition") == LATE_PARTITION)
    store = InboxStore(spark, fresh_dir(spark, "inbox"), replace(NARROW, late_output=True))
    ingest_batch(store, rows.where(F.col("partition") != LATE_PARTITION), "in-time", F.col("timestamp"))
    store = _from_first(store, max_windows_per_run=1_000_000)
    drain(store, _discard, NOW, NOW)
    path = fresh_dir(spark, "late")
    short = replace(store, config=replace(store.config, inbox_ttl_seconds=LATE_TTL))

    def log(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        events.select(*EVENT_KEY).write.mode("overwrite").parquet(f"{path}/run={drain_id}")

    ingest_batch(store, late.where("offset div 3 % 4 < 2"), "late-1", F.col("timestamp"))
    emit_late(short, log, NOW)
    again = rows.where(F.col("partition").isin(LATE_PARTITION, 0))
    ingest_batch(store, again, "late-2", F.col("timestamp"))
    emit_late(short, log, NOW)
    emit_late(short, log, NOW)
    names = [late_name(store.config.drain_id, tick) for tick in range(2)]
    found = spark.read.schema("window_bucket bigint, event_ts timestamp, event_id string, run string").parquet(path)
    tick = F.when(F.col("run") == names[0], 0).when(F.col("run") == names[1], 1)
    return found.select(tick.alias("tick"), "window_bucket", F.unix_millis("event_ts").alias("event_ts_ms"), "event_id")


# -- lag ---------------------------------------------------------------------


def _lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets the store has recorded while ingesting against the ends of the source."""
    committed = _uneven(spark, sf_dir).partitions().withColumnRenamed("next_offset", "offset")
    return offset_lag(committed, next_offsets(_deliveries(spark, sf_dir)))


@query("offset_lag")
def partition_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag(spark, sf_dir)


@query("lag_summary")
def lag_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_summary(_lag(spark, sf_dir), NARROW)


@query("stream_throughput")
def reported_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streaming query reported about its batches: one batch over all source rows, at some rate."""
    rates = stream_throughput(_narrow_outage(spark, sf_dir).rates())
    return rates.select("batches", F.col("deliveries").alias("source_rows"), (F.col("per_second") > 0).alias("has_rate"))


@query("stream_clock")
def source_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream clock with the stopped source partition, and without it once it counts as idle."""
    partitions = _uneven(spark, sf_dir).partitions()
    waiting = stream_clock(partitions).withColumn("idle_seconds", F.lit(None).cast("bigint"))
    return waiting.unionByName(stream_clock(partitions, IDLE_SECONDS).withColumn("idle_seconds", F.lit(IDLE_SECONDS).cast("bigint")))


# -- aggregations ------------------------------------------------------------


@query("window_counts")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.window_counts(_events(spark, sf_dir, HOURLY))


@query("last_drained")
def last_drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor per drain identity; a drain and a replay of its first ten days share the ledger."""
    store = _history(spark, sf_dir)
    sink, start = parquet_files(fresh_dir(spark, "windows")), store.config.start_bucket
    drain(store, sink, NOW, NOW)
    replay_windows(store, sink, start, start + 10 * 86_400, "replay", NOW, NOW)
    return ledger_ops.last_drained(store.progress())


@query("ingest_counters")
def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored counters of all batches: the late ones met the ledger's cursor, one attempt at a batch failed."""
    stored = _narrow_outage(spark, sf_dir).metrics()
    return stored.agg(*[F.sum(c).alias(c) for c in COUNTERS])


@query("throughput")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_ops.throughput(_events(spark, sf_dir))


@query("latency_percentiles")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = latency_ops.latency_histogram(_events(spark, sf_dir))
    return latency_ops.percentiles(histogram, [0.5, 0.95, 0.99])


@query("latency_estimates")
def estimated_latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency quantiles from the batches' sketches: whether the true rank of each is within three percent."""
    store = _narrow_outage(spark, sf_dir)
    found = latency_estimates(store.metrics(), [0.5, 0.95, 0.99])
    latency = F.unix_millis("ingest_time") - F.unix_millis("event_ts")
    rows = store.live(_at(AFTER)).select(latency.alias("ms"))
    # Three numbers.
    quantiles = {r.p: r.latency_ms for r in found.collect()}
    ranks = [
        F.struct(
            F.lit(p).alias("p"),
            F.avg((F.col("ms") < q).cast("int")).alias("below"),
            F.avg((F.col("ms") <= q).cast("int")).alias("upto"),
        )
        for p, q in quantiles.items()
    ]
    within = (F.col("below") - 0.03 <= F.col("p")) & (F.col("upto") + 0.03 >= F.col("p"))
    return rows.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks")).select("p", within.alias("within"))


@query("redelivery_estimates")
def estimated_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries, and whether the sketches' distinct events are within four percent of the true number."""
    store = _narrow_outage(spark, sf_dir)
    exact = dedup_stats(store.live(_at(AFTER))).select(F.col("distinct_events").alias("n")).scalar()
    found = redelivery_estimates(store.metrics())
    return found.select("deliveries", (F.abs(F.col("distinct_events") - exact) <= exact * 0.04).alias("within"))


@query("window_size_audit")
def window_size_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir, HOURLY).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint")
    )
    small = replace(HOURLY, window_warn_bytes=8_000)
    return win.window_size_audit(upsert_latest(rows), small)


@query("dedup_stats")
def redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_stats(_events(spark, sf_dir))


# -- upsert, order, limits ---------------------------------------------------


@query("upsert_latest")
def upsert_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(upsert_latest(_events(spark, sf_dir)))


@query("ordered_window")
def ordered_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain order as a position inside each window."""
    store = _outage(spark, sf_dir)
    return win.drain_position(store.inbox()).select("window_bucket", "event_id", "position")


@query("newest_windows")
def newest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.latest_windows(win.window_counts(_events(spark, sf_dir, HOURLY)), 10)


# -- sinks -------------------------------------------------------------------


@query("write_inbox")
def write_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored inbox, read back after every delivery was written twice."""
    store = _stored(spark, sf_dir, NARROW)
    ingest_batch(store, _deliveries(spark, sf_dir), "batch-0", F.col("timestamp"))
    return _plain(store.inbox())


@query("compacted_inbox")
def compacted_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping segments merged by compaction; the merged files hold each key once."""
    store = _stored(spark, sf_dir, NARROW)
    ingest_batch(store, _deliveries(spark, sf_dir), "batch-1", F.col("timestamp"))
    store.drop(store.compact())
    return _plain(store.inbox())


@query("write_dead_letters")
def write_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, NARROW).dead_letters()


@query("drain_files")
def drain_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of every drained window, read back with the folder's window."""
    store = _history(spark, sf_dir)
    path = fresh_dir(spark, "windows")
    drain(store, json_files(path), AFTER, AFTER)
    schema = "window_bucket BIGINT, " + ", ".join(
        f"{n} {'BIGINT' if n == 'windowBucket' else 'STRING'}" for n in LINE_NAMES
    )
    return spark.read.schema(schema).json(f"{path}/drain_id={store.config.drain_id}").drop("day")


@query("published_windows")
def published_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as their manifests show them: two drains, one of which died behind its files, and a replaced half.

    Every window has its row, empty ones too; ``events`` counts what a reader finds in its files.
    """
    store = _from_first(_stored(spark, sf_dir, HOURLY), max_windows_per_run=300)
    published = PublishedWindows(spark, fresh_dir(spark, "published"))

    def dies(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        events.write.parquet(f"{published.path}/data/drain_id={drain_id}/run=dead")
        raise OSError("killed")

    drain(store, published, NOW, NOW)
    try:
        drain(store, dies, AFTER, AFTER)
    except OSError:
        drain(store, published, AFTER, AFTER)
    store.forget_progress("primary", NOW)
    drain(store, published, AFTER, AFTER)
    published.merge("primary")
    published.clean("primary")
    found = published.read("primary").groupBy("window_bucket").agg(F.count("*").alias("events"))
    windows = published.windows("primary").join(found, "window_bucket", "left")
    return windows.select("window_bucket", "event_count", F.coalesce("events", F.lit(0)).alias("events"))


@query("source_replay")
def source_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inbox after a replay of the source into a new root; the one before had lost a source partition."""
    rows, base = _deliveries(spark, sf_dir), f"{fresh_dir(spark, 'inboxes')}"
    whole = F.lit(True)

    def fill(wanted: Column) -> Callable[[InboxStore], None]:
        return lambda store: ingest_batch(store, rows.where(wanted), "batch-0", F.col("timestamp")) and None

    rebuild(spark, base, NARROW, fill(F.col("partition") != LATE_PARTITION))
    rebuild(spark, base, NARROW, fill(whole))
    drop_superseded(spark, base)
    return _plain(active_store(spark, base, NARROW).inbox(now=_at(AFTER)))


@query("pluggable_sink")
def custom_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own sink: drained windows summed per operation."""
    store = _history(spark, sf_dir)
    path = fresh_dir(spark, "summary")

    def summarise(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        counts = events.groupBy("window_bucket", "operation").agg(F.count("*").alias("events"))
        # Windows that come again replace what they wrote before.
        written = counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        written.partitionBy("window_bucket").parquet(f"{path}/{drain_id}")

    drain(store, summarise, AFTER, AFTER)
    schema = "window_bucket BIGINT, operation STRING, events BIGINT"
    return spark.read.schema(schema).parquet(f"{path}/{store.config.drain_id}")


@query("record_progress")
def record_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger holds one row per window although every window is recorded twice."""
    store = _history(spark, sf_dir)
    rows = store.accepted()
    span = rows.agg(F.min("window_bucket").alias("a"), F.max("window_bucket").alias("b")).first()
    ledger = window_ledger(rows, span["a"], span["b"], store.config).select(
        F.lit("primary").alias("drain_id"),
        "window_bucket",
        "event_count",
        F.timestamp_seconds(F.lit(AFTER)).alias("drained_at"),
    )
    ledger = cut_lineage(ledger)
    store.append_progress(ledger)
    store.append_progress(ledger)
    return store.progress().withColumn("drained_at", F.unix_seconds("drained_at"))


# -- streaming and drain cycles ----------------------------------------------


@query("stream_ingest")
def stream_ingest_inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed deliveries: the stored inbox after the stream caught up."""
    store = InboxStore(spark, fresh_dir(spark, "inbox"), NARROW)
    stream = deliveries(stream_events(spark, sf_dir))
    run = stream_ingest(stream, store, fresh_dir(spark, "offsets"), lambda: F.col("timestamp"))
    run.awaitTermination()
    return _plain(store.inbox())


@query("stream_ingest_metrics")
def stream_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the streamed late partition: its writes behind the drain cursor are counted as late."""
    stored = _narrow_outage(spark, sf_dir).metrics().where(F.col("segment") != "in-time")
    return stored.agg(*[F.sum(c).alias(c) for c in ("success", "parse_error", "late_arrival")])


@query("drain_cycle")
def drain_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger after two cycles, the second resuming where the first stopped."""
    store = _history(spark, sf_dir)
    sink = parquet_files(fresh_dir(spark, "windows"))
    drain(store, sink, NOW, NOW)
    drain(store, sink, AFTER, AFTER)
    return store.progress().withColumn("drained_at", F.unix_seconds("drained_at"))


@query("bootstrap_cursor")
def bootstrap_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First window an actual drain covers under each bootstrap rule."""
    store = _stored(spark, sf_dir, HOURLY)
    start = _from_first(store).config.start_bucket
    sink = parquet_files(fresh_dir(spark, "windows"))
    rules = {
        "latest": {},
        "configured": {"bootstrap": CONFIGURED, "start_bucket": start},
        "inside_a_window": {"bootstrap": CONFIGURED, "start_bucket": start + 1_234},
        "start_zero": {"bootstrap": CONFIGURED, "start_bucket": 0},
    }
    firsts = []
    for rule, settings in rules.items():
        mine = replace(store, config=replace(HOURLY, drain_id=rule, **settings))
        firsts.append((rule, drain(mine, sink, NOW, NOW).first))
    again = replace(store, config=replace(HOURLY, drain_id="latest"))
    firsts.append(("resume", drain(again, sink, AFTER, AFTER).first))
    # One row per rule; the ledger holds the same windows as first ones.
    ledger = store.progress().groupBy("drain_id").agg(F.min("window_bucket").alias("ledger_first"))
    named = spark.createDataFrame(firsts, "rule string, bucket bigint")
    resumed = F.when(F.col("rule") == "resume", "latest").otherwise(F.col("rule"))
    joined = named.withColumn("drain_id", resumed).join(ledger, "drain_id")
    return joined.select("rule", "bucket", (F.col("bucket") == F.col("ledger_first")).alias("is_ledger_first"))


@query("drain_by_stream_clock")
def drained_by_stream_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers of drains that seal by the stream clock: held back by the stopped partition, and with it idle."""
    store = _uneven(spark, sf_dir)
    patient = replace(store, config=replace(store.config, drain_id="patient"))
    drain_by_stream_clock(patient, _discard, AFTER, AFTER, expected=6)
    hasty = replace(store, config=replace(store.config, drain_id="hasty", idle_seconds=IDLE_SECONDS))
    drain_by_stream_clock(hasty, _discard, AFTER, AFTER)
    return store.progress().select("drain_id", "window_bucket", "event_count")


@query("drain_backlog")
def drain_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of 5-second windows in one drain whose runs are far shorter: every window is recorded."""
    store = _from_first(_stored(spark, sf_dir, NARROW), max_windows_per_run=120_000)
    drain(store, _discard, AFTER, AFTER)
    return store.progress().select("window_bucket", "event_count")


@query("drain_order")
def drain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order in which a sink meets windows of mixed sizes over several runs."""
    store = _from_first(_stored(spark, sf_dir, HOURLY), max_windows_per_run=200, rows_per_file=10)
    path, runs = fresh_dir(spark, "order"), []

    def numbered(events: DataFrame, windows: DataFrame, drain_id: str) -> None:
        runs.append(len(runs))
        met = events.select("window_bucket", F.monotonically_increasing_id().alias("row"))
        first = met.groupBy("window_bucket").agg(F.min("row").alias("row"))
        first.withColumn("run", F.lit(runs[-1])).write.parquet(f"{path}/call={runs[-1]}")

    drain(store, numbered, AFTER, AFTER)
    # One row per window: the report itself.
    seen = spark.read.schema("window_bucket BIGINT, row BIGINT, run INT").parquet(path)
    return seen.select("window_bucket", F.row_number().over(Window.orderBy("run", "row")).alias("nth"))


@query("replay_windows")
def replayed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second half of the month emitted again under another drain identity."""
    store = _history(spark, sf_dir)
    path = fresh_dir(spark, "replay")
    replay_windows(store, parquet_files(path), NOW, AFTER, "replay", AFTER, AFTER)
    return _keys(spark.read.schema(EVENT).parquet(f"{path}/drain_id=replay"))


@query("split_large_windows")
def split_large_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of an average window's size: larger windows spread over several and still drain whole."""
    store = _outage(spark, sf_dir)
    rows = store.live(_at(AFTER))
    sizes = win.window_counts(rows).agg(F.ceil(F.avg("deliveries")).alias("a"), F.sum("deliveries").alias("d"))
    size = sizes.first()
    return _keys(ordered_events(rows, size["d"], replace(HOURLY, rows_per_file=size["a"])))


@query("seal_by_event_time")
def sealed_by_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows sealed by the stream's own watermark, written as they seal."""
    decoded = decode(deliveries(stream_events(spark, sf_dir)), HOURLY.window_seconds)
    valid = decoded.where("reason IS NULL").select("event_ts")
    path = fresh_dir(spark, "sealed")
    run = (
        seal_by_event_time(valid, HOURLY)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", fresh_dir(spark, "offsets"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema("window_bucket BIGINT, deliveries BIGINT").parquet(path)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries to distinct events per hourly window."""
    return CATALOG["window_counts"](spark, sf_dir)
