"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, table
from tidegate.llm.conversations import conversation_report, damaged, digests, repair_conversations
from tidegate.llm.decontamination import find_leaks
from tidegate.llm.divergence import audit_sources
from tidegate.llm.language_id import identify
from tidegate.llm.line_dedup import dedup_lines
from tidegate.llm.lm_scoring import score_texts
from tidegate.llm.near_dedup import near_duplicates
from tidegate.llm.packing import pack
from tidegate.llm.quality_model import fit_on_labels, score_features
from tidegate.llm.quality_rules import judge, trusted_sample
from tidegate.llm.sharding import HashTree, assign_shards
from tidegate.llm.suffix_dedup import remove_repeats
from tidegate.llm.token_files import read_token_files, write_token_files
from tidegate.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 ids by minimum bin slack."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in shards 0 to 39, and where it goes with one shard more."""
    tree = HashTree.regular(40)
    return assign_shards(table(spark, sf_dir, "documents"), tree, tree.grow(region=0, rack=0))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"), trusted_sample(table(spark, sf_dir, "labels")))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with at most one edit in ten characters."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), rate=0.1)


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids in flat files, read back from them. The vocabulary's ids fit into 16 bits."""
    folder, vocabulary = fresh_dir(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary, end_id=2, width=2)
    return read_token_files(spark, folder, width=2)


def held_out(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels a quality model may learn from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return labels.where(~held_out(5, 0))


@query
def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = table(spark, sf_dir, "documents")
    model, found = fit_on_labels(docs, quality_labels(spark, sf_dir), Scratch(spark, "quality"))
    return score_features(found, model).select(
        "doc_id",
        F.coalesce(held_out(5, 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents share."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


# The blanks of a line's ends and the capitals are the contract's; DuckDB strips by pattern.
SQL["op10_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
    FROM documents
), keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(shared.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (WHERE shared.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates at 85 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, words=5)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings of earlier documents."""
    found = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the attention model and under the unigram base."""
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, held_out(7, 2), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the nearest rank-order profile."""
    judged = identify(table(spark, sf_dir, "documents"), ~held_out(4, 2), keep=["doc_id"])
    return judged.select("doc_id", F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms that set it apart."""
    return audit_sources(table(spark, sf_dir, "documents"), min_docs=10, top=10)


# The whole matrix of sources and kept terms, every cell by itself.
SQL["op12_source_divergence"] = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
           row_number() OVER () AS id
    FROM documents
), words AS (
    SELECT lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM d
), t AS (
    SELECT lang, source, id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM words
), kept AS (
    SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), found AS (
    SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), g AS (
    SELECT DISTINCT lang, source FROM d
), cell AS (
    SELECT g.lang, g.source, kept.term, kept.total, coalesce(found.n, 0) AS n
    FROM g JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)
), sizes AS (
    SELECT lang, source, sum(n) AS size, sum(total) AS lang_size, count(*) AS v FROM cell GROUP BY lang, source
), shares AS (
    SELECT lang, source, term, n,
           CAST(1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (size + 2 * v) AS BIGINT) AS p,
           CAST(1 + CAST(1000000000 AS HUGEINT) * (total + 2) // (lang_size + 2 * v) AS BIGINT) AS q
    FROM cell JOIN sizes USING (lang, source)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(apart.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation with its faults and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    scratch = Scratch(spark, "repair")
    pieces = scratch.save(repair_conversations(damaged(rows)), "pieces")
    found = conversation_report(rows, pieces).join(digests(pieces), "conv", "left").drop("conv")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.withColumn("repaired_sha256", F.coalesce("sha256", nothing)).drop("sha256")
