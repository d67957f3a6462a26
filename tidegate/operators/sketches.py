"""Running answers about latency and redelivery from mergeable sketches, one pair per micro-batch.

The exact forms (``latency.percentiles``, ``latest.dedup_stats``) read every delivery; these
read the counters only. Sketches of batches are merged, never recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.schema import EVENT_KEY

SKETCHES = ["latency_sketch", "key_sketch"]


def sketch_columns() -> list[Column]:
    """Sketches of the accepted deliveries' latencies in ms and of their keys, as aggregates beside the counters."""
    accepted = F.col("reason").isNull()
    latency = F.unix_millis("ingest_time") - F.unix_millis("event_ts")
    return [
        F.kll_sketch_agg_bigint(F.when(accepted, latency)).alias("latency_sketch"),
        F.hll_sketch_agg(F.when(accepted, F.xxhash64(*EVENT_KEY)), F.lit(LG_K)).alias("key_sketch"),
    ]


#: Registers of the key sketch, as a power of two: a standard error below one percent.
LG_K = 14


def merged_sketches() -> list[Column]:
    return [
        F.kll_merge_agg_bigint("latency_sketch").alias("latency_sketch"),
        F.hll_union_agg("key_sketch").alias("key_sketch"),
    ]


def latency_estimates(metrics: DataFrame, fractions: list[float]) -> DataFrame:
    """(p, latency_ms): quantiles within about 1.7 percent of rank (of 99 in 100 answers), null without deliveries."""
    merged = metrics.agg(F.kll_merge_agg_bigint("latency_sketch").alias("k"))
    known = F.coalesce(F.kll_sketch_get_n_bigint("k"), F.lit(0)) > 0
    answers = [
        F.struct(F.lit(p).alias("p"), F.when(known, F.kll_sketch_get_quantile_bigint("k", F.lit(p))).alias("latency_ms"))
        for p in fractions
    ]
    return merged.select(F.inline(F.array(*answers)))


def redelivery_estimates(metrics: DataFrame) -> DataFrame:
    """Accepted deliveries (exact), about how many distinct events they hold, and the rest as redeliveries."""
    merged = metrics.agg(
        F.coalesce(F.sum("success"), F.lit(0)).alias("deliveries"), F.hll_union_agg("key_sketch").alias("h")
    )
    distinct = F.least(F.coalesce(F.hll_sketch_estimate("h"), F.lit(0)), F.col("deliveries"))
    return merged.select("deliveries", distinct.alias("distinct_events"), (F.col("deliveries") - distinct).alias("redeliveries"))
