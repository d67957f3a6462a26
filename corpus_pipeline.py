"""A training corpus from ``documents``: five stages, each reading what the one before wrote.

All but the last return the columns of ``documents``. A stage judges its own input: its
decisions follow from the documents that reached it (and from ``labels`` and ``benchmark``).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, free_names, small_batches, table
from tidegate.llm.decontamination import without_leaks
from tidegate.llm.line_dedup import dedup_lines
from tidegate.llm.near_dedup import near_duplicates
from tidegate.llm.packing import pack
from tidegate.llm.quality_model import fit_on_labels, keep_good
from tidegate.llm.queries import quality_labels
from tidegate.session import fresh_dir

#: Documents in which a line must occur to be removed from all of them.
LINE_DOCS = 10
#: Percent of common shingles from which documents count as near duplicates.
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    small_batches(spark)
    model, _ = fit_on_labels(docs, quality_labels(spark, sf_dir), Scratch(spark, "pipeline-quality"))
    return keep_good(docs, model, threshold=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; ``n_chars`` follows the text.

    A null text is one empty line and stays. Repeated rows are one document to the count. Columns of any other
    name stay as they are, those named like the operator's own included.
    """
    small_batches(spark)
    own = [c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")]
    aside = dict(zip(own, free_names([*docs.columns, "n_lines", "n_dropped"], *own), strict=True))
    kept = dedup_lines(docs.withColumnsRenamed(aside), min_docs=LINE_DOCS)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed)
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id, one without a doc_id last.

    Rows are told apart by a number of their own, so repeated rows are copies of each other, and a
    row that shares its doc_id with a copy of something else is judged by its own text. Texts without
    words are copies of nothing. Columns of any name are kept.
    """
    small_batches(spark)
    scratch = Scratch(spark, "pipeline-copies")
    row, component = free_names(docs.columns, "row", "component")
    rows = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent=SIMILARITY, words=5)
    groups = found.select(F.col("doc_id").alias(row), F.col("component_id").alias(component))
    first = F.min_by(F.col(row), F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias(row)
    kept = groups.join(rows.select(row, "doc_id"), row).groupBy(component).agg(first).select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), rate=0.1)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of 2048 tokens."""
    small_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier, near duplicates and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
