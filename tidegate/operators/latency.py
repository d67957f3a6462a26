"""Ingest latency and throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import cut_lineage

# Latency steps per coarse bin; bins grow with the value so their number stays bounded.
MANTISSA_BITS = 7


def latency_histogram(deliveries: DataFrame) -> DataFrame:
    """Deliveries per latency in ms between event time and reception."""
    latency = F.unix_millis("ingest_time") - F.unix_millis("event_ts")
    return deliveries.groupBy(latency.alias("latency_ms")).agg(F.count("*").alias("n"))


def _coarse_bin(value):
    """Order-preserving bin with at most 2**MANTISSA_BITS bins per power of two."""
    magnitude = F.greatest(F.abs(value), F.lit(1).cast("bigint"))
    shift = F.greatest(F.length(F.bin(magnitude)) - F.lit(MANTISSA_BITS + 1), F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    return F.floor(value / step) * step


def percentiles(histogram: DataFrame, fractions: list[float]) -> DataFrame:
    """Exact value at zero-based position floor(n * p) of the sorted list, for each p.

    A running total over a bounded number of coarse bins finds the bin holding
    each position; only those bins are then walked value by value.
    """
    # Walked twice: the small table is kept, so the text behind it is parsed once.
    histogram = cut_lineage(histogram)
    bins = histogram.groupBy(_coarse_bin(F.col("latency_ms")).alias("bin")).agg(
        F.sum("n").alias("n")
    )
    below = F.coalesce(
        F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    total = F.sum("n").over(Window.partitionBy())
    placed = bins.select("bin", "n", below.alias("below"), total.alias("total"))
    wanted = F.explode(F.array(*[F.lit(p) for p in fractions])).alias("p")
    ranked = placed.select("bin", "n", "below", "total", wanted).withColumn(
        "rank", F.least(F.floor(F.col("total") * F.col("p")), F.col("total") - 1)
    )
    targets = ranked.where("rank >= below AND rank < below + n").select("bin", "below", "p", "rank")
    inside = histogram.withColumn("bin", _coarse_bin(F.col("latency_ms"))).join(
        F.broadcast(targets), "bin"
    )
    upto = F.col("below") + F.sum("n").over(
        Window.partitionBy("p").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = inside.withColumn("upto", upto).where("upto > rank")
    return reached.groupBy("p").agg(F.min("latency_ms").alias("latency_ms"))


def throughput(deliveries: DataFrame) -> DataFrame:
    """Deliveries per second between the first and the last reception."""
    seconds = (F.max(F.unix_millis("ingest_time")) - F.min(F.unix_millis("ingest_time"))) / 1000
    return deliveries.agg(
        F.count("*").alias("deliveries"), seconds.alias("elapsed_seconds")
    ).withColumn(
        "per_second",
        F.when(F.col("elapsed_seconds") > 0, F.col("deliveries") / F.col("elapsed_seconds")),
    )
