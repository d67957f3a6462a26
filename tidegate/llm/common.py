"""What the operators share: tables in the shared folder, whole-table order, test tables."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.tokens import drop_encoders
from tidegate.session import delete_dir, fresh_dir

#: Bytes that pass between the JVM and a Python worker at once.
BATCH_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds by bytes what passes to a Python worker at once; a longer row passes alone.

    Both sides of a task hold several batches, and Spark's own bound is 10 000 rows or 64 MB.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Scratch:
    """Tables of one operator run in the shared folder; written once, so later steps never recompute them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = fresh_dir(spark, name)

    def save(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more.

        It follows the driver's garbage collection, which a long job may not reach for hours.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            delete_dir(self.spark, f"{self.path}/{name}")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Range-partitions and sorts, then adds ``part`` and ``place`` (0, 1, ... in each part).

    The numbers hold only for one execution: write the result before using it twice.
    """
    place = F.monotonically_increasing_id()
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.shiftright(place, 33).cast("int"))
        .withColumn("place", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )


def prefix(counts: dict[int, int]) -> dict[int, int]:
    """Sum of the values of all smaller keys."""
    out, total = {}, 0
    for key in sorted(counts):
        out[key] = total
        total += counts[key]
    return out


def doc_batches(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The batches in slices that keep the memory of one step small.

    What other steps left in the worker goes first, and what Arrow holds without use goes at the end.
    """
    drop_encoders()
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where a table has a column of that name already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out
