"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


STRING, LONG, TS = T.StringType(), T.LongType(), T.TimestampType()

DELIVERY = _struct(
    key=STRING, value=STRING, topic=STRING, partition=T.IntegerType(), offset=LONG, timestamp=TS
)

CORRUPT = "_corrupt"

# Field names of the envelope. Scalars are read as text and checked by expressions, because a JSON reader
# that casts them is either laxer or stricter than the envelope contract.
ENVELOPE = _struct(
    specversion=STRING,
    id=STRING,
    source=STRING,
    type=STRING,
    time=STRING,
    datacontenttype=STRING,
    data=_struct(
        guid=STRING,
        operation=STRING,
        requestName=STRING,
        applicationId=STRING,
        timestamp=STRING,
        slupTimestamp=STRING,
        clientAddress=STRING,
        fields=T.ArrayType(T.MapType(STRING, STRING)),
    ),
    **{CORRUPT: STRING},
)

EVENT = _struct(
    window_bucket=LONG,
    event_ts=TS,
    event_id=STRING,
    guid=STRING,
    operation=STRING,
    request_name=STRING,
    application_id=STRING,
    client_address=STRING,
    ingest_time=TS,
    payload=STRING,
)
EVENT_COLUMNS = EVENT.fieldNames()
EVENT_KEY = ["window_bucket", "event_ts", "event_id"]

# Where a delivery came from; orders writes that share one ingest_time.
ORIGIN_COLUMNS = ["topic", "partition", "offset"]

# One stored delivery: the event, its origin and its outcome. Rejected
# deliveries keep key and value and leave the event columns null.
STORED = T.StructType(
    [
        *EVENT.fields,
        T.StructField("payload_bytes", LONG),
        T.StructField("key", STRING),
        T.StructField("topic", STRING),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", LONG),
        T.StructField("reason", STRING),
    ]
)
STORED_PARTITIONS = ["outcome", "storage_bucket", "segment"]
STORED_FULL = T.StructType(
    [
        *STORED.fields,
        T.StructField("outcome", STRING),
        T.StructField("storage_bucket", LONG),
        T.StructField("segment", STRING),
    ]
)

PROGRESS = _struct(drain_id=STRING, window_bucket=LONG, event_count=LONG, drained_at=TS)

# Counters of one micro-batch, of one failed attempt at it, or of the segments a merged row stands for.
COUNTERS = ["success", "parse_error", "late_arrival", "write_error"]
METRICS = _struct(
    segment=STRING,
    success=LONG,
    parse_error=LONG,
    late_arrival=LONG,
    write_error=LONG,
    latency_sketch=T.BinaryType(),
    key_sketch=T.BinaryType(),
    covers=T.ArrayType(STRING),
    recorded_at=TS,
)

# How far one micro-batch came in each source partition: every column is a maximum, so rows may repeat.
SOURCE_PARTITIONS = _struct(
    segment=STRING,
    topic=STRING,
    partition=T.IntegerType(),
    next_offset=LONG,
    high_event_ts=TS,
    last_seen=TS,
)

# What a streaming query reported about one micro-batch; offsets as the source's own JSON.
RATES = _struct(
    segment=STRING,
    rows=LONG,
    seconds=T.DoubleType(),
    committed=STRING,
    latest=STRING,
    recorded_at=TS,
)

# Keys a drain or a late output has handed to its sink.
EMITTED = T.StructType(
    [
        *[EVENT[c] for c in EVENT_KEY],
        T.StructField("drain_id", STRING),
        T.StructField("storage_bucket", LONG),
        T.StructField("run", STRING),
    ]
)

OFFSETS = _struct(topic=STRING, partition=T.IntegerType(), offset=LONG)
