"""Delivery sources: an at-least-once log of (key, value) records, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.schema import DELIVERY


def _kafka_columns(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Topic from the earliest offset; needs the Kafka connector on the class path.

    ``min_partitions`` splits the offset range of a topic partition that holds
    far more than the others over several tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return _kafka_columns(reader.load())


def kafka_batch(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return _kafka_columns(reader.load())


def file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Deliveries landed as Parquet, ORC, JSON or Avro files with the delivery schema."""
    reader = spark.readStream.format(fmt).schema(DELIVERY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def file_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(DELIVERY).load(path)
