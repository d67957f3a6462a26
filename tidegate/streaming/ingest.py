"""Streaming ingest: deliveries to inbox and dead letters, offsets last."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.envelope import Parser, decode, envelope_parser
from tidegate.operators.outcomes import ACCEPTED, REJECTED, counter_columns, dead_letters, with_ingest_time
from tidegate.operators.sketches import SKETCHES, sketch_columns
from tidegate.sources.store import InboxStore, storage_time
from tidegate.streaming.monitor import IngestMonitor

QUERY_ID = "sql.streaming.queryId"

DeadLetterSink = Callable[[DataFrame], None]


def kafka_dead_letters(servers: str, topic: str) -> DeadLetterSink:
    """Publish dead letters with their original key and value only."""

    def write(letters: DataFrame) -> None:
        writer = letters.select("key", "value").write.format("kafka")
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def _observed(observation: Observation) -> dict:
    """Metrics of a write that has succeeded; a batch the optimizer proved empty has none."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def ingest_batch(
    store: InboxStore,
    deliveries: DataFrame,
    segment: str,
    ingest_time: Column | None = None,
    parser: Parser = envelope_parser,
    dead_letter_sink: DeadLetterSink | None = None,
) -> dict[str, int]:
    """Store one batch and return its counters.

    The text is parsed once; the counters ride along with the write. Returns
    only after inbox, dead letters and counters are durable.
    """
    clock = F.current_timestamp() if ingest_time is None else ingest_time
    config = store.config
    cursor = store.last_drained(config.drain_id) or 0
    if config.rebalance_writes:
        # Deliveries of one time share folders and much of their text: in order, the exchange compresses them well.
        deliveries = deliveries.sortWithinPartitions("timestamp")
    decoded = decode(deliveries, config.window_seconds, parser)
    decoded = with_ingest_time(decoded, clock)
    observation = Observation()
    span = []
    for outcome, rows in ((ACCEPTED, F.col("reason").isNull()), (REJECTED, F.col("reason").isNotNull())):
        stored_at = F.when(rows, storage_time())
        span += [F.min(stored_at).alias(f"{outcome}_from"), F.max(stored_at).alias(f"{outcome}_to")]
    observed = decoded.observe(observation, *counter_columns(cursor), *sketch_columns(), *span)
    store.write_segment(store.stored_form(observed, segment))
    seen = _observed(observation)
    counters = {k: int(seen.get(k) or 0) for k in ("success", "parse_error", "late_arrival")}
    stored = [
        store.segment_rows(outcome, segment, seen[f"{outcome}_from"], seen[f"{outcome}_to"])
        for outcome in (ACCEPTED, REJECTED)
        if seen.get(f"{outcome}_from") is not None
    ]
    if dead_letter_sink is not None and counters["parse_error"]:
        dead_letter_sink(dead_letters(stored[-1].withColumnRenamed("payload", "value")))
    if stored:
        # Narrow columns of what was just written: the text is not parsed again.
        columns = ["topic", "partition", "offset", "event_ts", "ingest_time"]
        store.write_partitions(reduce(DataFrame.unionByName, [rows.select(*columns) for rows in stored]), segment)
    store.count_batch(segment, counters, {name: seen.get(name) for name in SKETCHES})
    return counters


def _count_failure(store: InboxStore, segment: str) -> None:
    """Count a failed attempt; the failure itself is what the caller raises, also when counting fails too."""
    try:
        store.count_failure(segment)
    except Exception:
        logging.getLogger(__name__).exception("could not count the failure of %s", segment)


def stream_ingest(
    deliveries: DataFrame,
    store: InboxStore,
    checkpoint: str,
    ingest_time: Callable[[], Column] | None = None,
    parser: Parser = envelope_parser,
    dead_letter_sink: DeadLetterSink | None = None,
    trigger: dict | None = None,
    monitor: IngestMonitor | None = None,
) -> StreamingQuery:
    """Run ingest on a stream of deliveries.

    Offsets move only when the batch function returned. A failed or repeated
    batch runs again under the same segment name, which replaces what it left.
    Every failed attempt is counted as a write error. ``monitor`` has the rates and
    offsets of finished batches written to the store.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if not query_id:
            raise RuntimeError("micro-batch without a streaming query id")
        clock = ingest_time() if ingest_time else None
        batch_store = InboxStore(batch.sparkSession, store.root, store.config)
        segment = f"{query_id}-{batch_id:010d}"
        if monitor is not None:
            monitor.flush()
        try:
            ingest_batch(batch_store, batch, segment, clock, parser, dead_letter_sink)
        except Exception:
            _count_failure(batch_store, segment)
            raise

    writer = deliveries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
