"""Removal of lines that many documents share.

Two Bloom filters find suspects: hashes seen once, and hashes seen in a second document.
Every task sends each hash it met once; the hashes are dealt over slices, each slice
keeps its own pair of filters, and only the second filter leaves it. Lines outside that
filter occur in one document only and never move. Suspected lines are confirmed by
counting their 128-bit digests, with sums made before the exchange.

The second filter has a fixed upper size. When more lines repeat than it can tell apart,
more lines are sent to confirmation; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import Scratch, doc_batches, free_names, longs

BLANKS = b" \t\n\x0b\x0c\r"
PROBES = 4
#: Hashes one layer of the first filter takes before another is added.
LAYER = 1 << 20
#: Hashes one task holds before it sends them.
HELD = 1 << 20


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def doc_lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Positions of hashes in a filter of a power of two of bits."""
    return positions(hashes, np.uint64(64 - bits.bit_length() + 1))


def positions(hashes: np.ndarray, shift) -> Iterator[np.ndarray]:
    """The digits above ``shift`` (of each hash its own, if an array) of PROBES products of each hash."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        mixed = (hashes + np.uint64(i) * step) * np.uint64(0x9E3779B97F4A7C15)
        yield (mixed >> shift).astype(np.int64)


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each hash, by the same signed remainder that deals them to tasks."""
    return hashes.view(np.int64) % np.int64(slices)


class Seen:
    """A Bloom filter that grows in layers."""

    def __init__(self) -> None:
        self.layers: list[np.ndarray] = []
        self.room = 0

    def test(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        for layer in self.layers:
            hit = np.ones(len(hashes), bool)
            for at in probes(hashes, len(layer)):
                hit &= layer[at]
            found |= hit
        return found

    def add(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        if self.room <= 0:
            self.layers.append(np.zeros(LAYER * 16, bool))
            self.room = LAYER
        for at in probes(hashes, len(self.layers[-1])):
            self.layers[-1][at] = True
        self.room -= len(hashes)


def _hashes_of_task(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Each line hash the task met, and whether two of its documents have it."""
    seen: dict[int, bool] = {}

    def send() -> pa.RecordBatch:
        keys = np.fromiter(seen.keys(), np.uint64, len(seen)).view(np.int64)
        return pa.RecordBatch.from_arrays([longs(keys), pa.array(list(seen.values()), pa.bool_())], names=["hash", "twice"])

    hash_of = xxhash.xxh3_64_intdigest
    for batch in doc_batches(batches):
        for text in batch.column("text").to_pylist():
            own = {hash_of(k) for k in map(line_key, doc_lines(text)) if len(k) >= min_chars}
            for h in own:
                seen[h] = h in seen
        if len(seen) >= HELD:
            yield send()
            seen.clear()
    if seen:
        yield send()


def _twice_of_slice(batches: Iterator[pa.RecordBatch], slices: int, most_bits: int) -> Iterator[pa.RecordBatch]:
    """Streams the hashes of slices through both filters; returns the second filter of each."""
    once: dict[int, Seen] = {}
    twice: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        hashes = batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
        sure = batch.column("twice").to_numpy(zero_copy_only=False)
        home = slice_of(hashes, slices)
        for k in np.unique(home).tolist():
            mine = home == k
            own, counts = np.unique(hashes[mine], return_counts=True)
            filter_ = once.setdefault(k, Seen())
            again = (counts > 1) | np.isin(own, hashes[mine & sure]) | filter_.test(own)
            filter_.add(own[~again])
            # A second filter as large as it may become; it is folded to fit at the end.
            bits = twice.setdefault(k, [np.zeros(most_bits, bool), np.zeros(1, np.int64)])
            for at in probes(own[again], most_bits):
                bits[0][at] = True
            bits[1] += int(again.sum())
    for k, (bits, count) in twice.items():
        # The position is the top digits of a product, so halving merges neighbours.
        while len(bits) > 1024 and len(bits) > 32 * int(count[0]):
            bits = bits[0::2] | bits[1::2]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["slice", "bits"]
        )


class Suspects:
    """The second filters of all slices, as one bounded value for every task."""

    def __init__(self, filters: dict[int, bytes], slices: int) -> None:
        self.slices = slices
        self.filters = {k: np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for k, b in filters.items()}

    def test(self, hashes: np.ndarray) -> np.ndarray:
        home = slice_of(hashes, self.slices)
        found = np.zeros(len(hashes), bool)
        for k in np.unique(home).tolist():
            if k in self.filters:
                mine = np.flatnonzero(home == k)
                hit = np.ones(len(mine), bool)
                for at in probes(hashes[mine], len(self.filters[k])):
                    hit &= self.filters[k][at]
                found[mine] = hit
        return found


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 2,
    min_chars: int = 1,
    keep_first: bool = False,
    filter_bits: int = 1 << 26,
    most_shipped: int = 200_000,
) -> DataFrame:
    """Documents without the lines whose key at least ``min_docs`` documents hold.

    A key is the line without ASCII white space at its ends and with ASCII letters folded;
    keys of fewer than ``min_chars`` bytes are never removed. With ``keep_first`` the
    first such line by (doc_id, line number) stays. Returns the columns of ``docs`` with the
    remaining lines as ``text``, and n_lines (before), n_dropped; columns of these two
    names are replaced. A null text is one empty line and stays null; rows that share a doc_id
    count as one document, rows without one each as their own; an empty table gives no rows.

    Up to ``most_shipped`` confirmed keys are sent to every task; beyond that the keys
    of each document reach it by a join on doc_id. ``filter_bits`` bounds the second filter.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*keep)
    texts = docs.select("text")

    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most_bits = max(1024, 1 << (filter_bits // slices).bit_length() - 1)
    met = texts.mapInArrow(lambda b: _hashes_of_task(b, min_chars), "hash long, twice boolean")
    dealt = met.withColumn("slice", F.pmod(F.col("hash"), F.lit(slices))).repartition(slices, "slice").drop("slice")
    filters = dealt.mapInArrow(lambda b: _twice_of_slice(b, slices, most_bits), "slice int, bits binary").collect()
    shared = spark.sparkContext.broadcast(Suspects({r["slice"]: bytes(r["bits"]) for r in filters}, slices))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, hash_of = shared.value, xxhash.xxh3_64_intdigest
        for batch in doc_batches(batches):
            keys, places, owners = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                first: dict[bytes, int] = {}
                for i, key in enumerate(map(line_key, doc_lines(text))):
                    if len(key) >= min_chars:
                        first.setdefault(key, i)
                keys += first.keys()
                places += first.values()
                owners += [doc_id] * len(first)
            hit = np.flatnonzero(filter_.test(np.array([hash_of(k) for k in keys], np.uint64))).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(keys[i]) for i in hit], pa.binary()),
                    pa.array([owners[i] for i in hit], pa.int64()),
                    pa.array([places[i] for i in hit], pa.int32()),
                ],
                names=["key", "doc_id", "line"],
            )

    suspects = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    suspects = scratch.save(suspects.mapInArrow(suspected, "key binary, doc_id long, line int"), "suspects")
    # Rows that share a doc_id are one document; rows without one are documents of their own.
    own_docs = F.when(F.col("doc_id").isNull(), F.count(F.lit(1))).otherwise(F.lit(1))
    confirmed = (
        suspects.groupBy("key", "doc_id")
        .agg(own_docs.alias("docs"), F.min("line").alias("line"))
        .groupBy("key")
        .agg(F.sum("docs").alias("docs"), F.min(F.struct("doc_id", "line")).alias("first"))
        .where(F.col("docs") >= min_docs)
        .select("key", F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line"))
    )
    confirmed = scratch.save(confirmed, "confirmed")

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_lines", "n_dropped"))])
    names = schema.names

    def rewrite(batch: pa.RecordBatch, dropped_of: list[dict]) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        doc_ids = batch.column("doc_id").to_pylist()
        for doc_id, text, gone in zip(doc_ids, batch.column("text").to_pylist(), dropped_of, strict=True):
            lines = doc_lines(text)
            stay = []
            for i, line in enumerate(lines):
                key = line_key(line)
                first = gone.get(_digest(key)) if len(key) >= min_chars else None
                if first is None or (keep_first and first == (doc_id, i)):
                    stay.append(line)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(text if len(stay) == len(lines) else b"\n".join(stay).decode())
        columns = [pa.array(kept, pa.string()) if n == "text" else batch.column(n) for n in keep]
        return pa.RecordBatch.from_arrays([*columns, longs(n_lines), longs(n_dropped)], names=names)

    if confirmed.count() <= most_shipped:
        rows = confirmed.collect()
        gone = spark.sparkContext.broadcast({bytes(r["key"]): (r["first_doc"], r["first_line"]) for r in rows})

        def shipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in doc_batches(batches):
                yield rewrite(batch, [gone.value] * batch.num_rows)

        return docs.mapInArrow(shipped, schema)

    owner, listed = free_names(docs.columns, "owner", "gone")
    own = (
        suspects.drop("line")
        .join(confirmed, "key")
        .groupBy(F.col("doc_id").alias(owner))
        .agg(F.collect_set(F.struct("key", "first_doc", "first_line")).alias(listed))
    )
    joined = docs.join(own.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(owner)), "left").drop(owner)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches):
            lists = batch.column(listed).to_pylist()
            yield rewrite(
                batch, [{g["key"]: (g["first_doc"], g["first_line"]) for g in own or []} for own in lists]
            )

    return joined.mapInArrow(matched, schema)
