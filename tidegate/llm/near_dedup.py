"""Near duplicates by an inverted join on MinHash signature coordinates.

Documents with equal shingle sets are one class. Each class posts itself under its
coordinate-value pairs. Values that one class alone has can match nothing; a class with too
few others is done. The rest order their values from rare to frequent, and by the prefix
rule two classes that agree on at least ``least`` coordinates meet under the first value they
share, which lies in both prefixes. Further agreement is counted on the two lists and on
one-bit coordinates; survivors are confirmed on their full shingle sets.

Groups of near copies never expand into all pairs. Candidates of which too few shingles
occur in any other candidate are dropped, as no partner is possible. Then every posting list is a star
around one member, a different one in each list; then only members outside a list's
largest component are compared with the others, which loses no link between components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import Scratch, doc_batches, longs
from tidegate.llm.components import components
from tidegate.llm.tokens import PieceHash, worker_value

COORDINATES = 64
#: Further coordinates of which candidates keep one bit each, for a sharper count of agreements.
BITS = 2048
#: Chance that a pair at the threshold agrees on fewer coordinates than asked for.
MISS = 1e-6
BLOCK = 1 << 14

SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
    ]
)


def least_agreement(chance: float, coordinates: int = COORDINATES) -> int:
    """Largest count that a pair with this chance to agree on a coordinate reaches but for a chance of MISS."""
    if chance >= 1:
        return coordinates
    below = 0.0
    for count in range(coordinates + 1):
        ways = math.lgamma(coordinates + 1) - math.lgamma(count + 1) - math.lgamma(coordinates - count + 1)
        below += math.exp(ways + count * math.log(chance) + (coordinates - count) * math.log1p(-chance))
        if below > MISS:
            return max(1, count)
    return coordinates


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None, hasher: PieceHash) -> np.ndarray:
    """64-bit hash of each word, with ASCII letters folded, in order."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    step = np.diff(solid.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return mix(hasher.of(data, start, end) + (end - start).astype(np.uint64))


def shingle_set(text: str | None, words: int, hasher: PieceHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence when it is shorter."""
    h = word_hashes(text, hasher)
    if not len(h):
        return h
    size = min(words, len(h))
    draw = np.random.default_rng(words).integers(1, 1 << 62, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total += h[i : len(h) - size + 1 + i] * draw[i]
    return np.unique(mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest of the hashes under each of COORDINATES multiplications."""
    factors = np.random.default_rng(64).integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(COORDINATES, ~np.uint64(0))
    for i in range(0, len(hashes), BLOCK):
        out = np.minimum(out, (factors[:, None] * hashes[None, i : i + BLOCK]).min(axis=1))
    return (out >> np.uint64(32)).astype("<u4")


def bits(hashes: np.ndarray) -> np.ndarray:
    """One bit of the smallest hash under each of BITS multiplications, in 64-bit words."""
    factors = np.random.default_rng(1).integers(1, 1 << 62, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(BITS, ~np.uint64(0))
    for i in range(0, len(hashes), 256):
        np.minimum(out, (factors[:, None] * hashes[None, i : i + 256]).min(axis=1), out=out)
    return np.packbits(mix(out) >> np.uint64(63) == 1).view(np.int64)


def _agree(a: str, b: str, least: int) -> Column:
    """Whether two columns of bits agree on at least ``least`` of them."""
    words = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)]
    return reduce(Column.__add__, words) <= BITS - least


def _hasher() -> PieceHash:
    return worker_value("shingles", lambda: PieceHash(1 << 18, 5))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in doc_batches(batches):
            sets = [shingle_set(t, words, hasher) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    longs([len(s) for s in sets]),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ],
                names=SKETCH_SCHEMA.names,
            )

    return docs.select("doc_id", "text").mapInArrow(rows, SKETCH_SCHEMA)


def _postings(classes: DataFrame) -> DataFrame:
    """node and key of every coordinate; the key holds coordinate and value."""
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 8192):
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").astype(np.int64)
            keys = values.reshape(-1, COORDINATES) | coordinate
            nodes = np.repeat(batch.column("node").to_numpy(), COORDINATES)
            yield pa.RecordBatch.from_arrays([longs(nodes), longs(keys.ravel())], names=["node", "key"])

    return classes.select("node", "signature").mapInArrow(rows, "node long, key long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 256):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(rows, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked when 100 times the intersection of their shingle sets is at least
    ``percent`` times the union. component_id is the smallest doc_id reachable over links,
    and kept marks that document. Texts without words are linked with nothing. A null doc_id
    takes part but names no component unless it has no other; rows that share a doc_id are
    one document to ``kept``. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    least = least_agreement(percent / 100)
    # Bits of unequal coordinates are equal half of the time.
    least_bits = least_agreement((1 + percent / 100) / 2, BITS)
    found = scratch.save(sketches(docs, words), "sketches")
    classes = (
        found.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = scratch.save(classes, "classes")

    posts = _postings(classes)
    counts = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    nodes = (
        posts.join(counts, "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("shared"))
        .where(F.size("shared") >= least)
        .select("node", F.col("shared.key").alias("keys"))
    )
    nodes = scratch.save(nodes, "candidates")
    # Full sets of the classes that may have a partner, from one text of each.
    wanted = nodes.select("node").join(classes.select("node", "digest"), "node")
    sets = scratch.save(_sets(docs, found, wanted, words), "sets")
    nodes = nodes.join(_supported(sets, percent), "node", "left_semi").join(sets.select("node", "bits"), "node")
    nodes = scratch.save(nodes, "nodes")
    prefixes = nodes.select("node", F.explode(F.slice("keys", F.lit(1), F.size("keys") - (least - 1))).alias("key"))
    prefixes = scratch.save(prefixes, "prefixes")

    star = prefixes.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("b"), F.count(F.lit(1)).alias("n"))
    star = prefixes.join(star.where("n > 1"), "key").where("node <> b")
    pairs = star.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    bits_a = nodes.select(F.col("node").alias("a"), F.col("bits").alias("ba"))
    bits_b = nodes.select(F.col("node").alias("b"), F.col("bits").alias("bb"))
    pairs = pairs.join(bits_a, "a").join(bits_b, "b").where(_agree("ba", "bb", least_bits))
    links = scratch.save(_confirmed(pairs, sets, percent), "links")

    labels = components(links, scratch, "first")
    labelled = nodes.join(labels, "node", "left").select("node", "keys", "bits", F.coalesce("component", "node").alias("component"))
    labelled = scratch.save(labelled, "labelled")
    more = scratch.save(_confirmed(_across(prefixes, labelled, least, least_bits), sets, percent), "more")
    labels = components(links.union(more), scratch, "second")
    scratch.drop("candidates", "nodes", "prefixes", "sets", "links", "labelled", "more")

    own = classes.join(labels, "node", "left").select(
        "digest", "rep", F.coalesce("component", "node").alias("component")
    )
    smallest = own.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = own.join(smallest, "component").select("digest", "component_id")
    out = found.join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets(docs: DataFrame, found: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node and full shingle set of the wanted classes (node, digest)."""
    # Any one text of a class will do; the null-safe key also finds rows without a doc_id.
    one = found.join(wanted, "digest").groupBy("node", "digest").agg(F.min("doc_id").alias("doc"))
    joined = docs.select("doc_id", "text").join(one.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("doc")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in doc_batches(batches, 512):
            digests = batch.column("digest").to_pylist()
            sets = [shingle_set(t, words, hasher) for t in batch.column("text").to_pylist()]
            # Rows that share a doc_id may hold other texts.
            fits = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, digests, strict=True)]
            columns = [
                batch.column("node"),
                pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array([bits(s) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "hashes", "bits"]).filter(pa.array(fits, pa.bool_()))

    sets = joined.select("node", "digest", "text").mapInArrow(rows, "node long, hashes binary, bits array<long>")
    return sets.groupBy("node").agg(F.first("hashes").alias("hashes"), F.first("bits").alias("bits"))


def _supported(sets: DataFrame, percent: int) -> DataFrame:
    """The classes (node) of which enough shingles occur in another candidate as well.

    A partner must hold ``percent`` of a class's shingles, so a class with more shingles of
    its own has none. This takes most members of a family of loosely similar texts out before any pair is made.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 256):
            hashes = [np.frombuffer(raw, np.int64) for raw in batch.column("hashes").to_pylist()]
            sizes = [len(h) for h in hashes]
            nodes = np.repeat(batch.column("node").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays(
                [longs(nodes), longs(np.repeat(sizes, sizes)), longs(np.concatenate(hashes))],
                names=["node", "size", "hash"],
            )

    each = sets.mapInArrow(rows, "node long, size long, hash long")
    shared = each.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    held = each.join(shared, "hash").groupBy("node", "size").agg(F.count(F.lit(1)).alias("n"))
    return held.where(100 * F.col("n") >= percent * F.col("size")).select("node")


def _across(prefixes: DataFrame, labelled: DataFrame, least: int, least_bits: int) -> DataFrame:
    """Pairs of different components that agree on enough coordinates.

    In each posting list the members outside its largest component are the few; each pair
    across components has one of them, so the few are joined with all, never all with all.
    A pair is made under the first value it shares only.
    """
    posts = prefixes.join(labelled, "node")
    sizes = posts.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("components")
    )
    open_ = posts.join(largest.where("components > 1"), "key")
    few = open_.where("component <> largest").select(
        "key",
        F.col("node").alias("a"),
        F.col("component").alias("ca"),
        F.col("keys").alias("ka"),
        F.col("bits").alias("ba"),
    )
    every = open_.select(
        "key",
        F.col("node").alias("b"),
        F.col("component").alias("cb"),
        F.col("keys").alias("kb"),
        F.col("bits").alias("bb"),
        (F.col("component") == F.col("largest")).alias("many"),
    )
    shared = F.array_intersect("ka", "kb")
    return (
        few.join(every, "key")
        .where(F.col("ca") != F.col("cb"))
        .where(F.col("many") | (F.col("a") < F.col("b")))
        .where(_agree("ba", "bb", least_bits))
        .where((F.size(shared) >= least) & (F.get(shared, F.lit(0)) == F.col("key")))
        .select("a", "b")
    )
