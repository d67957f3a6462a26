"""Deliveries derived from the ``events`` test table.

Each event is delivered once, some twice or three times; fixed residues of the
id are malformed in one of four ways or lack the inner timestamp. Every column
is arithmetic on the event, so an independent query can state the expected
answer without reading the generated text. One narrow pass, no exchange; works
on a batch and on a streaming table alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.timestamps import epoch_micros_ntz
from tidegate.session import spread

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Residues of event_id modulo 97 and what is wrong with them.
BROKEN_TEXT, NO_ID, NO_DATA, NO_TIMES, OUTER_TIME_ONLY = 13, 29, 41, 53, 61
TOPIC = "cloud-events"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, because a streaming source takes a plain path for a directory.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def _operation(event_type: Column) -> Column:
    return (
        F.when(event_type.isin("purchase", "signup"), "NEW")
        .when(event_type.isin("click", "view"), "SET")
        .when(event_type == "error", "DELETE")
    )


def _text(kind: Column) -> Column:
    event_id, user = F.col("event_id"), F.col("user_id")
    id_text = event_id.cast("string")
    instant = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    has_times = kind != NO_TIMES
    data = F.struct(
        F.lpad(user.cast("string"), 24, "0").alias("guid"),
        _operation(F.col("event_type")).alias("operation"),
        F.when(user % 3 != 0, F.concat(F.lit("req-"), user % 7)).alias("requestName"),
        F.col("event_type").alias("applicationId"),
        F.when(has_times & (kind != OUTER_TIME_ONLY), instant).alias("timestamp"),
        F.floor(epoch_micros_ntz(F.col("ts")) / 1000).alias("slupTimestamp"),
        F.when(event_id % 4 != 1, F.concat(F.lit("10.0."), user % 200, F.lit("."), event_id % 250)).alias(
            "clientAddress"
        ),
        F.array(F.create_map(F.lit("props"), F.col("props"))).alias("fields"),
    )
    envelope = F.struct(
        F.lit("1.0").alias("specversion"),
        F.when(kind != NO_ID, id_text).alias("id"),
        F.lit("urn:events").alias("source"),
        F.col("event_type").alias("type"),
        F.when(has_times, instant).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        F.when(kind != NO_DATA, data).alias("data"),
    )
    return F.when(kind == BROKEN_TEXT, "not-json").otherwise(F.to_json(envelope))


def deliveries(events: DataFrame) -> DataFrame:
    """Delivery rows; the timestamp is the arrival, up to three minutes after the event."""
    event_id = F.col("event_id")
    last_copy = F.when(event_id % 50 == 0, 2).when(event_id % 10 == 0, 1).otherwise(0)
    copies = events.select("*", F.explode(F.sequence(F.lit(0), last_copy)).alias("copy"))
    sent_ms = F.floor(epoch_micros_ntz(F.col("ts")) / 1000)
    delay_ms = (event_id * 37 + F.col("copy") * 61) % 181 * 1000
    return copies.select(
        event_id.cast("string").alias("key"),
        _text(event_id % 97).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (event_id % 6).cast("int").alias("partition"),
        (event_id * 3 + F.col("copy")).alias("offset"),
        F.timestamp_millis(sent_ms + delay_ms).alias("timestamp"),
    )
