"""The inbox as plain partitioned Parquet.

Layout below ``root``::

    deliveries/outcome=<accepted|rejected>/storage_bucket=<b>/segment=<s>/
    progress/drain_id=<id>/segment=<s>/
    emitted/drain_id=<id>/storage_bucket=<b>/run=<r>/
    late/drain_id=<id>/tick=<n>/
    metrics/segment=<s>/
    partitions/segment=<s>/
    rates/segment=<s>/

One segment holds one micro-batch or one compaction. A segment written twice
replaces itself, so a replayed micro-batch changes nothing. Readers take the
last write per key over all segments; overlapping segments are therefore
harmless, and compaction needs no lock or manifest, only to write before it
deletes.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    from tidegate.sources.lease import DrainLease

from tidegate.config import InboxConfig
from tidegate.functions.windows import storage_bucket
from tidegate.operators.clock import stream_clock
from tidegate.operators.latest import overwritten, upsert_latest
from tidegate.operators.sketches import SKETCHES, merged_sketches
from tidegate.operators.outcomes import ACCEPTED, REJECTED
from tidegate.operators.progress import latest_progress, live_progress
from tidegate.operators.window_queries import live_rows
from tidegate.schema import (
    COUNTERS,
    EMITTED,
    EVENT_COLUMNS,
    EVENT_KEY,
    METRICS,
    ORIGIN_COLUMNS,
    PROGRESS,
    RATES,
    SOURCE_PARTITIONS,
    STORED,
    STORED_FULL,
    STORED_PARTITIONS,
)
from tidegate.session import (
    configure,
    cut_lineage,
    delete_dir,
    empty_table,
    exists,
    list_dirs,
    stored_bytes,
)


COMPACT = "compact"
MERGED = "merged"
MAX_LEDGER_SEGMENTS = 64
# The number of a micro-batch behind the name of its query, and the mark of a failed attempt.
BATCH_NUMBER = r"-[0-9]{10}$"
FAILED = ".failed-"


def _replace_partitions(rows: DataFrame, columns: list[str], path: str, **options: str) -> None:
    """Write rows, replacing exactly the partitions they hold.

    Jobs stage their files separately, so several may write below one path at a time.
    """
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*columns)
        .parquet(path)
    )


# A lookup by id skips the row groups that cannot hold it; the filters adapt to the ids there are.
ID_FILTER = {"parquet.bloom.filter.enabled#event_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def storage_time() -> Column:
    """Second by which a delivery is stored: its window, else its source time, which a replay repeats."""
    return F.coalesce("window_bucket", F.unix_seconds("timestamp"), F.lit(0))


def latest_rejected(rows: DataFrame) -> DataFrame:
    """One row per rejected delivery of a storage folder: origin and text name it, the last segment wins.

    Deliveries without an offset cannot be told apart, so all of them stay.
    """
    order = Window.partitionBy("storage_bucket", *ORIGIN_COLUMNS, "key", "payload")
    order = order.orderBy(F.col("ingest_time").desc(), F.col("segment").desc())
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1 OR offset IS NULL").drop("_rn")


def _between(rows: DataFrame, first: int | None, last: int | None) -> DataFrame:
    if first is not None:
        rows = rows.where(F.col("window_bucket") >= first)
    if last is not None:
        rows = rows.where(F.col("window_bucket") <= last)
    return rows


@dataclass(frozen=True)
class InboxStore:
    spark: SparkSession
    root: str
    config: InboxConfig = field(default_factory=InboxConfig)

    def __post_init__(self) -> None:
        configure(self.spark)

    @property
    def deliveries_path(self) -> str:
        return f"{self.root}/deliveries"

    @property
    def progress_path(self) -> str:
        return f"{self.root}/progress"

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/metrics"

    @property
    def emitted_path(self) -> str:
        return f"{self.root}/emitted"

    @property
    def partitions_path(self) -> str:
        return f"{self.root}/partitions"

    @property
    def rates_path(self) -> str:
        return f"{self.root}/rates"

    # -- deliveries ---------------------------------------------------------

    def stored_form(self, decoded: DataFrame, segment: str) -> DataFrame:
        """Decoded deliveries with ingest time, laid out for storage.

        Both outcomes leave in one pass over the parsed text. The sort puts
        each file in key order, which keeps Parquet statistics selective.
        """
        accepted = F.col("reason").isNull()
        event_columns = [
            F.when(accepted, F.col(c)).alias(c)
            for c in EVENT_COLUMNS
            if c not in ("payload", "ingest_time")
        ]
        rows = decoded.select(
            *event_columns,
            "ingest_time",
            "payload",
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            "key",
            *ORIGIN_COLUMNS,
            "reason",
            "timestamp",
        ).select(
            *STORED.fieldNames(),
            F.when(accepted, ACCEPTED).otherwise(REJECTED).alias("outcome"),
            storage_bucket(storage_time(), self.config).alias("storage_bucket"),
            F.lit(segment).alias("segment"),
        )
        if self.config.rebalance_writes:
            rows = rows.hint("rebalance", "outcome", "storage_bucket")
        return rows.sortWithinPartitions(*STORED_PARTITIONS, *EVENT_KEY)

    def write_segment(self, stored: DataFrame) -> None:
        """Write one segment; the same segment written again replaces itself."""
        _replace_partitions(stored, STORED_PARTITIONS, self.deliveries_path, **ID_FILTER)

    def _folders(self, outcome: str, first: int | None, last: int | None) -> list[str]:
        """Storage folders that can hold the windows ``first``..``last``."""
        base = f"{self.deliveries_path}/outcome={outcome}"
        size = self.config.storage_seconds

        def holds(name: str) -> bool:
            # Folders count away from 1970, so the ones up to 0 also reach downwards.
            start = int(name.split("=")[1])
            lowest = start if start > 0 else start - size + 1
            return (first is None or start + size > first) and (last is None or lowest <= last)

        return [f"{base}/{name}" for name in list_dirs(self.spark, base) if holds(name)]

    def read(self, outcome: str, first: int | None = None, last: int | None = None) -> DataFrame:
        """Stored deliveries of one outcome; only folders in the given span are listed."""
        return self._read_folders(self._folders(outcome, first, last))

    def _read_folders(self, paths: list[str]) -> DataFrame:
        if not paths:
            return empty_table(self.spark, STORED_FULL)
        reader = self.spark.read.schema(STORED_FULL).option("basePath", self.deliveries_path)
        return reader.parquet(*paths)

    def accepted(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Every accepted write, optionally only of the windows ``first``..``last``."""
        return _between(self.read(ACCEPTED, first, last), first, last)

    def live(self, now: Column, first: int | None = None, last: int | None = None) -> DataFrame:
        """Accepted writes still retained. Expiry follows the last write, so it commutes with the upsert."""
        return live_rows(self.accepted(first, last), now, self.config.inbox_ttl_seconds)

    def inbox(self, first: int | None = None, last: int | None = None, now: Column | None = None) -> DataFrame:
        """The upserted table: the last write of every key, without rows past their retention.

        A key never leaves its storage folder, and a folder holding nothing but
        one compaction has each key once: those are read without an exchange.
        """
        merged, mixed = [], []
        for folder in self._folders(ACCEPTED, first, last):
            segments = list_dirs(self.spark, folder)
            if len(segments) == 1 and segments[0].startswith(f"segment={COMPACT}"):
                merged.append(f"{folder}/{segments[0]}")
            else:
                mixed.append(folder)
        now = F.current_timestamp() if now is None else now
        ttl = self.config.inbox_ttl_seconds
        unique = live_rows(_between(self._read_folders(merged), first, last), now, ttl).select(*EVENT_COLUMNS)
        if not mixed:
            return unique
        rows = live_rows(_between(self._read_folders(mixed), first, last), now, ttl)
        latest = self._by_address(rows, mixed)
        if latest is None:
            latest = upsert_latest(rows.select(*EVENT_COLUMNS, *ORIGIN_COLUMNS))
        latest = latest.select(*EVENT_COLUMNS)
        return latest.unionByName(unique) if merged else latest

    def _by_address(self, rows: DataFrame, folders: list[str]) -> DataFrame | None:
        """The last writes of ``rows``, stored in ``folders``, without an exchange of payloads; None if that does not pay.

        Keys alone say which rows were overwritten. These are kept as places in files, in a
        table whose size is known before every task is sent it, and left out of a plain scan.
        """
        config = self.config
        if stored_bytes(self.spark, folders) < config.address_from_bytes:
            return None
        place = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
        located = rows.withColumns(place)
        old = cut_lineage(overwritten(located, *place))
        if old.count() > config.most_overwritten:
            return None
        return located.join(F.broadcast(old), list(place), "left_anti").drop(*place)

    def segment_rows(self, outcome: str, segment: str, first: int, last: int) -> DataFrame:
        """Deliveries of one segment, stored for times between two.

        The segment is looked up by name in the folders of that span; other segments are not listed.
        """
        paths = [f"{folder}/segment={segment}" for folder in self._folders(outcome, first, last)]
        return self._read_folders([p for p in paths if exists(self.spark, p)])

    def rejected_segment(self, segment: str, first: int, last: int) -> DataFrame:
        return self.segment_rows(REJECTED, segment, first, last)

    def segment_folders(self, first: int | None = None, last: int | None = None) -> list[str]:
        """Names ``storage_bucket=<b>/segment=<s>`` of the accepted segments that can hold the windows of a span."""
        folders = self._folders(ACCEPTED, first, last)
        return [f"{f.rsplit('/', 1)[1]}/{s}" for f in folders for s in list_dirs(self.spark, f)]

    def read_segments(self, names: list[str]) -> DataFrame:
        """Every accepted write of segments named by ``segment_folders``."""
        return self._read_folders([f"{self.deliveries_path}/outcome={ACCEPTED}/{n}" for n in names])

    def dead_letters(self) -> DataFrame:
        """Every dead letter. One that a merge and its inputs both hold comes once, if it has an offset."""
        merged, mixed = [], []
        for folder in self._folders(REJECTED, None, None):
            names = list_dirs(self.spark, folder)
            held = any(n.startswith(f"segment={COMPACT}") for n in names)
            (mixed if held and len(names) > 1 else merged).append(folder)
        rows = self._read_folders(merged)
        if mixed:
            rows = rows.unionByName(latest_rejected(self._read_folders(mixed)))
        return rows.select("key", F.col("payload").alias("value"), "reason", *ORIGIN_COLUMNS)

    # -- maintenance --------------------------------------------------------

    def compact(self, first: int | None = None, last: int | None = None) -> list[str]:
        """Merge the segments of each storage folder in the span: one row per key, every dead letter once.

        Returns the superseded folders for ``drop`` to delete once no running
        job reads them; until then the accepted ones are only redundant. Writes arriving
        meanwhile are neither merged nor returned. Up to ``address_from_bytes`` range
        partitioning on the unique key gives even, ordered files however uneven the folders
        are; beyond, payloads are not exchanged and each file is in order by itself.
        """
        return self._merge(ACCEPTED, first, last) + self._merge(REJECTED, first, last)

    def _merge(self, outcome: str, first: int | None, last: int | None) -> list[str]:
        listed = {f: list_dirs(self.spark, f) for f in self._folders(outcome, first, last)}
        if outcome == REJECTED:
            # A folder of one segment has nothing to merge; dead letters have no key that could cut them.
            listed = {f: names for f, names in listed.items() if len(names) > 1}
        old = [f"{f}/{name}" for f, names in listed.items() for name in names]
        if not old:
            return []
        rows = self._read_folders(old)
        order = EVENT_KEY if outcome == ACCEPTED else ORIGIN_COLUMNS
        segment = F.lit(f"{COMPACT}-{uuid.uuid4().hex}")
        # Payloads stay where they are read: a task packs small files and sorts what they hold.
        merged = self._by_address(rows, old) if outcome == ACCEPTED else None
        if merged is None:
            merged = upsert_latest(rows) if outcome == ACCEPTED else latest_rejected(rows)
            files = max(1, -(-rows.count() // self.config.rows_per_file))
            merged = merged.repartitionByRange(files, "storage_bucket", *order)
        written = merged.withColumn("segment", segment).select(*STORED_FULL.fieldNames())
        self.write_segment(written.sortWithinPartitions(*STORED_PARTITIONS, *order))
        return old

    def drop(self, folders: list[str]) -> None:
        for path in folders:
            delete_dir(self.spark, path)

    def expire(self, now_epoch: int) -> list[int]:
        """Delete the segments in which every row has outlived its retention; returns their storage folders.

        Only segments listed at the start are judged and deleted, so a write that arrives
        meanwhile survives, and only folders whose events are older than the retention are read.
        """
        oldest = now_epoch - self.config.inbox_ttl_seconds
        dropped = set()
        for outcome in (ACCEPTED, REJECTED):
            old = [f for f in self._folders(outcome, None, oldest) if int(f.rsplit("=", 1)[1]) < oldest]
            listed = [f"{f}/{s}" for f in old for s in list_dirs(self.spark, f)]
            newest = (
                self._read_folders(listed)
                .groupBy("storage_bucket", "segment")
                .agg(F.max(F.unix_seconds("ingest_time")).alias("newest"))
                .where(F.col("newest") < oldest)
            )
            # One row per segment of the folders past retention, which the calls before have emptied.
            for row in newest.collect():
                path = f"{self.deliveries_path}/outcome={outcome}/storage_bucket={row.storage_bucket}"
                delete_dir(self.spark, f"{path}/segment={row.segment}")
                if not list_dirs(self.spark, path):
                    delete_dir(self.spark, path)
                dropped.add(row.storage_bucket)
        self._expire_emitted(now_epoch)
        self._expire_metrics(now_epoch)
        return sorted(dropped)

    def _expire_emitted(self, now_epoch: int) -> None:
        """Forget emitted keys of windows older than both retentions: neither rows nor ledger can name them."""
        config = self.config
        oldest = now_epoch - max(config.progress_ttl_seconds, config.inbox_ttl_seconds) - config.storage_seconds
        for drain in list_dirs(self.spark, self.emitted_path):
            base = f"{self.emitted_path}/{drain}"
            self.drop([f"{base}/{n}" for n in list_dirs(self.spark, base) if int(n.split("=")[1]) < oldest])

    def _expire_metrics(self, now_epoch: int) -> None:
        """Delete counters older than the ledger's retention and merge old ones into one row.

        Only the newest batch of a query can come again, so it is never merged: a replay replaces its own
        row. The merged row names what it stands for, and readers leave that out: a
        crash before the deletion counts nothing twice.
        """
        listed = list_dirs(self.spark, self.metrics_path)
        if len(listed) <= MAX_LEDGER_SEGMENTS:
            return
        # What an interrupted merge has left, ahead of the row that covers it.
        covered = self._covered_metrics()
        self.drop([f"{self.metrics_path}/{s}" for s in listed if s.removeprefix("segment=") in covered])
        rows = self._metrics_rows().withColumn("query", F.regexp_replace("segment", BATCH_NUMBER, ""))
        newest = Window.partitionBy("query").orderBy(F.col("segment").desc())
        single = F.col("segment").contains(FAILED) | F.col("segment").startswith(MERGED)
        done = single | ((F.col("query") != F.col("segment")) & (F.row_number().over(newest) > 1))
        oldest = F.timestamp_seconds(F.lit(now_epoch - self.config.progress_ttl_seconds))
        # One narrow row per batch since the last merge.
        old = cut_lineage(rows.withColumn("done", done).where("done").withColumn("live", F.col("recorded_at") > oldest))
        live = old.where("live")
        sums = [F.sum(c).cast("bigint").alias(c) for c in COUNTERS]
        merged = live.agg(
            *sums,
            *merged_sketches(),
            F.collect_set("segment").alias("covers"),
            F.max("recorded_at").alias("recorded_at"),
        ).where("recorded_at IS NOT NULL")
        self.write_metrics(merged.withColumn("segment", F.lit(f"{MERGED}-{uuid.uuid4().hex}")))
        self.drop([f"{self.metrics_path}/segment={r.segment}" for r in old.select("segment").collect()])
        self._merge_partitions()

    # -- ledger -------------------------------------------------------------

    def _progress_schema(self) -> T.StructType:
        return T.StructType([*PROGRESS.fields, T.StructField("segment", T.StringType())])

    def append_progress(self, windows: DataFrame, kind: str = "run", lease: DrainLease | None = None) -> None:
        """Record drained windows; repeating a record is harmless.

        A holder of a lease that was taken over meanwhile records nothing: it looks before it
        writes, and takes its segment back if the epoch has changed by the time it is there.
        """
        if lease is not None:
            lease.check()
        segment = f"{time.time_ns():020d}-{kind}"
        rows = windows.select(*PROGRESS.fieldNames()).withColumn("segment", F.lit(segment))
        if kind == MERGED:
            files = max(1, -(-rows.count() // self.config.rows_per_file))
            rows = rows.repartitionByRange(files, "window_bucket")
        else:
            # One file: a run records at most max_windows_per_run narrow rows.
            rows = rows.coalesce(1)
        _replace_partitions(rows, ["drain_id", "segment"], self.progress_path)
        if lease is not None:
            try:
                lease.check()
            except RuntimeError:
                self.drop([f"{self.progress_path}/drain_id={lease.drain_id}/segment={segment}"])
                raise

    def _progress_rows(self) -> DataFrame:
        if not list_dirs(self.spark, self.progress_path):
            return empty_table(self.spark, self._progress_schema())
        return self.spark.read.schema(self._progress_schema()).parquet(self.progress_path)

    def progress(self, now_epoch: int | None = None) -> DataFrame:
        """The ledger, one row per drained window; ``now_epoch`` applies its retention."""
        rows = self._progress_rows()
        if now_epoch is not None:
            rows = live_progress(rows, now_epoch, self.config.progress_ttl_seconds)
        return latest_progress(rows)

    def last_drained(self, drain_id: str, now_epoch: int | None = None) -> int | None:
        """Highest recorded window; a repeated record cannot change a maximum."""
        path = f"{self.progress_path}/drain_id={drain_id}"
        if not list_dirs(self.spark, path):
            return None
        rows = self.spark.read.schema(self._progress_schema()).parquet(path)
        if now_epoch is not None:
            rows = live_progress(rows, now_epoch, self.config.progress_ttl_seconds)
        return rows.agg(F.max("window_bucket").alias("last")).first()["last"]

    def forget_progress(self, drain_id: str, first: int, now_epoch: int | None = None) -> None:
        """Remove a drain identity's ledger rows from window ``first`` on, so they drain again.

        ``now_epoch`` applies the ledger's retention to the rows that stay.
        """
        old, rows = self._ledger_segments(drain_id)
        if old:
            if now_epoch is not None:
                rows = live_progress(rows, now_epoch, self.config.progress_ttl_seconds)
            self.append_progress(cut_lineage(rows.where(F.col("window_bucket") < first)), MERGED)
            self.drop(old)

    def compact_progress(self, drain_id: str, now_epoch: int) -> None:
        """Merge a ledger's small segments and leave out its expired rows.

        Deletes only what an earlier merge replaced, so a job that has just
        listed the ledger still finds its files. Run by the drainer itself.
        """
        old, rows = self._ledger_segments(drain_id)
        if old:
            kept = live_progress(rows, now_epoch, self.config.progress_ttl_seconds)
            merged = [i for i, path in enumerate(old) if path.endswith(MERGED)]
            self.append_progress(kept, MERGED)
            self.drop(old[: merged[-1]] if merged else [])

    def _ledger_segments(self, drain_id: str) -> tuple[list[str], DataFrame]:
        """Segment folders of one ledger, oldest first, and their latest rows."""
        base = f"{self.progress_path}/drain_id={drain_id}"
        old = [f"{base}/{s}" for s in list_dirs(self.spark, base)]
        if not old:
            return [], self.progress()
        reader = self.spark.read.schema(self._progress_schema())
        return old, latest_progress(reader.option("basePath", self.progress_path).parquet(*old))

    def ledger_is_fragmented(self, drain_id: str) -> bool:
        segments = list_dirs(self.spark, f"{self.progress_path}/drain_id={drain_id}")
        return len(segments) > MAX_LEDGER_SEGMENTS

    # -- counters -----------------------------------------------------------

    def _stored(self, path: str, schema: T.StructType) -> DataFrame:
        if not list_dirs(self.spark, path):
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    def _covered_metrics(self) -> set[str]:
        """Segments that a merged row stands for, deleted or not: names of one merge, at most."""
        rows = self._stored(self.metrics_path, METRICS).where(F.col("segment").startswith(MERGED))
        return {r.s for r in rows.select(F.explode("covers").alias("s")).collect()}

    def _metrics_rows(self) -> DataFrame:
        rows = self._stored(self.metrics_path, METRICS)
        covered = rows.select(F.explode("covers").alias("segment"))
        return rows.join(covered, "segment", "left_anti").select(*METRICS.fieldNames())

    def metrics(self) -> DataFrame:
        """Counters and sketches per micro-batch and failed attempt; a replayed batch replaces its own row."""
        return self._metrics_rows().drop("covers")

    def write_metrics(self, row: DataFrame) -> None:
        _replace_partitions(row.select(*METRICS.fieldNames()), ["segment"], self.metrics_path)

    def count_batch(self, segment: str, counters: dict[str, int], sketches: dict[str, bytes] | None = None) -> None:
        """Record the counters of one batch, and the sketches of its latencies and keys."""
        columns = [F.lit(counters.get(k, 0)).cast("bigint").alias(k) for k in COUNTERS]
        for name in SKETCHES:
            columns.append(F.lit((sketches or {}).get(name)).cast("binary").alias(name))
        covers = F.lit(None).cast("array<string>").alias("covers")
        row = self.spark.range(1).select(F.lit(segment).alias("segment"), *columns, covers, F.current_timestamp().alias("recorded_at"))
        self.write_metrics(row)

    def count_failure(self, segment: str) -> None:
        """Record one failed attempt at a batch; every attempt counts."""
        self.count_batch(f"{segment}{FAILED}{time.time_ns()}", {"write_error": 1})

    # -- source partitions and rates ------------------------------------------

    def write_partitions(self, rows: DataFrame, segment: str) -> None:
        """Record how far the deliveries of a segment reach in each source partition."""
        seen = rows.groupBy("topic", "partition").agg(
            (F.max("offset") + 1).alias("next_offset"),
            F.max("event_ts").alias("high_event_ts"),
            F.max("ingest_time").alias("last_seen"),
        )
        seen = seen.withColumn("segment", F.lit(segment)).select(*SOURCE_PARTITIONS.fieldNames())
        _replace_partitions(seen.coalesce(1), ["segment"], self.partitions_path)

    def partitions(self) -> DataFrame:
        """(topic, partition, next_offset, high_event_ts, last_seen) of every source partition met so far."""
        rows = self._stored(self.partitions_path, SOURCE_PARTITIONS)
        return rows.groupBy("topic", "partition").agg(
            *[F.max(c).alias(c) for c in ("next_offset", "high_event_ts", "last_seen")]
        )

    def _merge_partitions(self) -> None:
        """One row per source partition instead of one per batch; repeated rows cannot change a maximum."""
        listed = list_dirs(self.spark, self.partitions_path)
        if len(listed) > MAX_LEDGER_SEGMENTS:
            name = f"{MERGED}-{uuid.uuid4().hex}"
            rows = cut_lineage(self.partitions()).withColumn("segment", F.lit(name)).select(*SOURCE_PARTITIONS.fieldNames())
            _replace_partitions(rows.coalesce(1), ["segment"], self.partitions_path)
            self.drop([f"{self.partitions_path}/{s}" for s in listed])

    def stream_clock(self, expected: int | None = None) -> int | None:
        """Epoch second up to which every source partition that is not idle has come; None when not known.

        With ``expected`` partitions it stays unknown until all of them have sent an event.
        """
        row = stream_clock(self.partitions(), self.config.idle_seconds).first()
        return None if expected is not None and row["partitions"] < expected else row["clock"]

    def write_rates(self, rows: list[tuple]) -> None:
        """Record what a streaming query reported, by rows of RATES."""
        if rows:
            frame = self.spark.createDataFrame(rows, RATES).coalesce(1)
            _replace_partitions(frame, ["segment"], self.rates_path)

    def rates(self) -> DataFrame:
        return self._stored(self.rates_path, RATES)

    # -- late output ----------------------------------------------------------

    def append_emitted(self, keys: DataFrame, drain_id: str, run: str) -> None:
        """Log keys handed to a sink; the same run logged again replaces itself."""
        rows = keys.select(
            *EVENT_KEY,
            F.lit(drain_id).alias("drain_id"),
            storage_bucket(F.col("window_bucket"), self.config).alias("storage_bucket"),
            F.lit(run).alias("run"),
        ).hint("rebalance", "storage_bucket")
        _replace_partitions(rows, ["drain_id", "storage_bucket", "run"], self.emitted_path)

    def emitted(self, drain_id: str, buckets: list[int] | None = None) -> DataFrame:
        """Keys a drain identity and its late output have emitted; only the given storage folders are listed."""
        base = f"{self.emitted_path}/drain_id={drain_id}"
        names = list_dirs(self.spark, base)
        if buckets is not None:
            names = [n for n in names if int(n.split("=")[1]) in set(buckets)]
        if not names:
            return empty_table(self.spark, EMITTED)
        reader = self.spark.read.schema(EMITTED).option("basePath", self.emitted_path)
        return reader.parquet(*[f"{base}/{n}" for n in names])

    def _late_path(self, drain_id: str) -> str:
        return f"{self.root}/late/drain_id={drain_id}"

    def examined_segments(self, drain_id: str) -> tuple[int, set[str]]:
        """Number of the next late tick, and the segments the ticks before have looked at."""
        base = self._late_path(drain_id)
        ticks = [int(n.split("=")[1]) for n in list_dirs(self.spark, base) if exists(self.spark, f"{base}/{n}/_SUCCESS")]
        if not ticks:
            return 0, set()
        rows = self.spark.read.schema("name string").parquet(f"{base}/tick={max(ticks):010d}")
        # One name per segment the inbox holds now.
        return max(ticks) + 1, {r.name for r in rows.collect()}

    def mark_examined(self, drain_id: str, tick: int, names: list[str]) -> None:
        """Record the segments looked at up to a tick, and forget all earlier ticks."""
        base = self._late_path(drain_id)
        frame = self.spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)
        frame.write.mode("overwrite").parquet(f"{base}/tick={tick:010d}")
        self.drop([f"{base}/{n}" for n in list_dirs(self.spark, base) if int(n.split("=")[1]) < tick])

    def register_views(self) -> None:
        """Expose the tables to ``spark.sql``, as stored now: call again to see later segments."""
        self.inbox().createOrReplaceTempView("inbox")
        self.progress().createOrReplaceTempView("drain_progress")
        self.dead_letters().createOrReplaceTempView("dead_letter")
        self.metrics().createOrReplaceTempView("ingest_metrics")
