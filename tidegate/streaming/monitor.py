"""What streaming queries report about their batches, kept in tables: rates, committed and end offsets."""

from __future__ import annotations

import json
import threading
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidegate.schema import OFFSETS
from tidegate.sources.offsets import source_offsets
from tidegate.sources.store import InboxStore


def rate_row(progress: Mapping) -> tuple:
    """A row of the rates table from a query's progress report."""
    committed, latest = source_offsets(progress)
    return (
        f"{progress['id']}-{progress['batchId']:010d}",
        int(progress["numInputRows"]),
        float(progress["batchDuration"]) / 1000,
        json.dumps(committed),
        json.dumps(latest),
        datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")),
    )


class IngestMonitor(StreamingQueryListener):
    """Collects the reports of finished batches; ``flush`` writes them to the store.

    A report arrives after its batch, so the batch function flushes those of earlier
    batches and the end of the query the rest. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, store: InboxStore) -> None:
        self.store = store
        self.lock = threading.Lock()
        self.rows: dict[str, tuple] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = rate_row(json.loads(event.progress.json))
        with self.lock:
            self.rows[row[0]] = row

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def collect(self, query) -> None:
        """Take the reports a query still holds; one that the listener has brought too is the same row."""
        rows = [rate_row(json.loads(progress.json)) for progress in query.recentProgress]
        with self.lock:
            self.rows |= {row[0]: row for row in rows}

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, {}
        try:
            self.store.write_rates(list(rows.values()))
        except Exception:
            with self.lock:
                self.rows = rows | self.rows
            raise


def stream_throughput(rates: DataFrame) -> DataFrame:
    """Deliveries, seconds spent in batches and deliveries per second, per streaming query."""
    query = F.regexp_replace("segment", "-[0-9]{10}$", "").alias("query")
    return rates.groupBy(query).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("deliveries"),
        F.sum("seconds").alias("seconds"),
        F.try_divide(F.sum("rows"), F.sum("seconds")).alias("per_second"),
    )


def reported_offsets(rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Committed and end offsets of the newest report of each query, for ``offset_lag``.

    Sources that report no offsets by topic and partition give no rows; for them the store's
    ``partitions`` hold the committed ones.
    """
    query = F.regexp_replace("segment", "-[0-9]{10}$", "")
    last = Window.partitionBy(query).orderBy(F.col("segment").desc())
    newest = rates.withColumn("_rn", F.row_number().over(last)).where("_rn = 1")

    def offsets(column: str) -> DataFrame:
        parsed = F.from_json(column, "map<string, map<string, bigint>>")
        topics = newest.select(F.explode(parsed).alias("topic", "parts"))
        rows = topics.select("topic", F.explode("parts").alias("partition", "offset"))
        typed = rows.select("topic", F.col("partition").cast("int").alias("partition"), "offset")
        return typed.groupBy("topic", "partition").agg(F.max("offset").alias("offset")).select(*OFFSETS.fieldNames())

    return offsets("committed"), offsets("latest")
