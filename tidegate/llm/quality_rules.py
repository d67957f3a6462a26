"""Keep or drop documents by rules and a log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into buckets. Two multinomials over the buckets, one of a
trusted target and one of the whole raw corpus, give each bucket a log-likelihood ratio; a
document's score is the mean ratio of its n-grams, and a fixed threshold decides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Ratios are kept as whole numbers of this fraction, so sums don't depend on order.
UNIT = 10_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas inside the body use it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(hashes: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, by position."""
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    return F.transform(starts, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, size))))


def _covered(runs: Column, size: int) -> Column:
    """Words inside windows found twice or more; windows are sorted once, no pairs are compared."""

    def of_positions(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, j: F.least(F.lit(size), F.coalesce(F.get(at, j + 1) - p, F.lit(size))).cast("long")
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)

    def of_sorted(run: Column) -> Column:
        same = F.filter(
            run,
            lambda x, j: (x["h"] == F.get(run, j + 1)["h"]) | ((j > 0) & (x["h"] == F.get(run, F.greatest(j - 1, F.lit(0)))["h"])),
        )
        return let(F.array_sort(F.transform(same, lambda x: x["at"])), of_positions)

    pairs = F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(let(pairs, of_sorted))


def repeated_words(hashes: Column, size: int = 5) -> Column:
    return let(hashes, lambda h: let(windows(h, size), lambda runs: _covered(runs, size)))


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(NOT_WHITE))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and word pairs."""
    return F.transform(
        F.concat(hashes, let(hashes, lambda h: windows(h, 2))), lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    )


def bucket_ratios(docs: DataFrame, trusted: DataFrame, buckets: int, smoothing: float = 1.0) -> list[int]:
    """Log-likelihood ratio of each bucket, target against raw corpus, in units of 1/UNIT.

    ``trusted`` (doc_id) must be small enough to be sent to every task.
    """
    marked = docs.select("doc_id", "text").join(
        F.broadcast(trusted.select("doc_id").distinct().withColumn("__trusted", F.lit(1))), "doc_id", "left"
    )
    counts = (
        marked.select("__trusted", F.explode(_buckets(hashes_of(words_of(F.col("text"))), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("target"))
        .collect()
    )
    raw, target = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not any(target):
        return [0] * buckets
    all_raw, all_target = sum(raw) + smoothing * buckets, sum(target) + smoothing * buckets
    return [
        round(UNIT * (math.log((t + smoothing) / all_target) - math.log((r + smoothing) / all_raw)))
        for t, r in zip(target, raw, strict=True)
    ]


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = 8192,
    threshold: float = -0.05,
    min_words: int = 10,
    most_repeated_percent: int = 20,
) -> DataFrame:
    """Measures and verdict of every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed (fewer words than ``min_words``, or more than the given percentage of them in
    repeated 5-word windows), kept (not base_failed and a mean ratio of at least the threshold) and
    ratio (null without words). Null text: no words, so base_failed. Repeated rows are
    judged alike, each for itself; a null doc_id is never trusted but judged; an empty table
    gives no rows; with no trusted text all ratios are zero
    and the rules alone decide. Other columns are not read.
    """
    ratios = bucket_ratios(docs, trusted, buckets)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("words")).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        let(
            hashes_of(F.col("words")),
            lambda h: F.struct(
                repeated_words(h).alias("repeated"),
                F.aggregate(
                    _buckets(h, buckets), F.lit(0).cast("long"), lambda total, b: total + F.get(table, b).cast("long")
                ).alias("sum"),
            ),
        ).alias("found"),
    )
    n = F.col("n_words")
    grams = n + F.greatest(n - 1, F.lit(0))
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("found.repeated").alias("n_repeat_words"),
        F.when(n > 0, F.col("found.sum") / (grams * UNIT)).alias("ratio"),
    ).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((n < min_words) | (100 * F.col("n_repeat_words") > most_repeated_percent * n)).alias("base_failed"),
        (
            (n >= min_words)
            & (100 * F.col("n_repeat_words") <= most_repeated_percent * n)
            & (F.coalesce(F.col("ratio"), F.lit(-1e9)) >= threshold)
        ).alias("kept"),
        "ratio",
    )


def trusted_sample(labels: DataFrame, most: int = 20_000) -> DataFrame:
    """At most ``most`` doc_ids of good, clean rows of labels, chosen by a hash of the doc_id."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
