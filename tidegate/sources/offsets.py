"""Committed and end offsets, from a table of deliveries or a streaming query's progress."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.schema import OFFSETS


def next_offsets(deliveries: DataFrame, only: Column | None = None) -> DataFrame:
    """Next offset per partition; ``only`` restricts it to the deliveries already processed."""
    rows = deliveries if only is None else deliveries.where(only)
    return rows.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))


def offsets_frame(spark: SparkSession, offsets: Mapping[str, Mapping[str, int]] | str | None) -> DataFrame:
    """Offsets in the ``{topic: {partition: offset}}`` form sources report, one row per partition."""
    decoded = json.loads(offsets) if isinstance(offsets, str) else offsets or {}
    rows = [(t, int(p), int(o)) for t, parts in decoded.items() for p, o in parts.items()]
    return spark.createDataFrame(rows, OFFSETS)


def source_offsets(progress: Mapping) -> tuple[dict, dict]:
    """Committed and end offsets ``{topic: {partition: offset}}`` of a progress report; other forms are left out."""
    found: tuple[dict, dict] = ({}, {})
    for source in progress["sources"]:
        for target, field in zip(found, ("endOffset", "latestOffset"), strict=True):
            value = source.get(field) or {}
            value = json.loads(value) if isinstance(value, str) else value
            if isinstance(value, dict):
                target.update({topic: parts for topic, parts in value.items() if isinstance(parts, dict)})
    return found


def progress_offsets(spark: SparkSession, progress: Mapping) -> tuple[DataFrame, DataFrame]:
    """Committed and end offsets of a Kafka-backed query from its ``lastProgress``."""
    committed, end = source_offsets(progress)
    return offsets_frame(spark, committed), offsets_frame(spark, end)
