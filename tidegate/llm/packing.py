"""Packing of token sequences by minimum bin slack.

Whole windows are cut off the front of each document. What remains is shorter than a
window, so all remainders together are a histogram with fewer bins than the window has
tokens; its size doesn't depend on the corpus. On that histogram a bitset subset-sum
program picks, for the longest remainder, the multiset of further lengths that fills
the window closest to capacity; the counts are read off by backtracking, and the pattern
is repeated as often as the histogram allows. Remainders whose closest fill leaves more than
``max_padding`` empty are cut into powers of two, which fill windows without a gap.
Documents find their place in the plan by arithmetic on their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import Scratch, doc_batches, longs, numbered, prefix
from tidegate.llm.tokens import encoder


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Multiset of lengths, at most ``counts`` of each, whose sum is as close to the capacity as can be.

    Ties: longer lengths are preferred. The reachable sums are the bits of one integer.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        lot = 1
        while left > 0 and not reach >> capacity & 1:
            lot = min(lot, left)
            steps.append((length, lot, reach))
            reach |= reach << (lot * length) & mask
            left -= lot
            lot *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, lot, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + lot
            total -= lot * length
    return chosen


@dataclass
class WindowPlan:
    """Where the remainder of a length and rank goes; bounded by the window, not by the corpus."""

    capacity: int
    windows: int = 0
    #: Per length: ranks from which a pattern holds, its first window, its copies a window, its offset.
    ranges: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    #: Per length: ranks below this are placed whole, the others are cut into powers of two.
    whole: dict[int, int] = field(default_factory=dict)
    #: Per length and power of two: rank of its first piece among those of that size.
    piece_base: dict[tuple[int, int], int] = field(default_factory=dict)
    #: Per power of two: offset of its first piece in the gapless run of all pieces.
    run_base: dict[int, int] = field(default_factory=dict)
    run_tokens: int = 0


def plan_windows(histogram: dict[int, int], capacity: int, max_padding: int = 0) -> WindowPlan:
    """Fill windows with remainders (length to count) by minimum bin slack."""
    plan = WindowPlan(capacity)
    left = {n: c for n, c in histogram.items() if c > 0 and 0 < n < capacity}
    used = dict.fromkeys(left, 0)
    cut: dict[int, int] = {}
    while left:
        seed = max(left)
        others = {n: c - (n == seed) for n, c in left.items() if n <= capacity - seed and c > (n == seed)}
        fill = closest_fill(others, capacity - seed)
        fill[seed] = fill.get(seed, 0) + 1
        total = sum(n * c for n, c in fill.items())
        if capacity - total > max_padding and total & (total - 1):
            cut[seed] = left.pop(seed)
            continue
        times = min(left[n] // c for n, c in fill.items())
        offset = 0
        for n in sorted(fill, reverse=True):
            plan.ranges.setdefault(n, []).append((used[n], plan.windows, fill[n], offset))
            offset += n * fill[n]
            used[n] += times * fill[n]
            left[n] -= times * fill[n]
            if not left[n]:
                del left[n]
        plan.windows += times
    plan.whole = used
    sizes: dict[int, int] = {}
    for n in sorted(cut):
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                plan.piece_base[n, bit] = sizes.get(bit, 0)
                sizes[bit] = sizes.get(bit, 0) + cut[n]
    for bit in sorted(sizes, reverse=True):
        plan.run_base[bit] = plan.run_tokens
        plan.run_tokens += sizes[bit] << bit
    return plan


def _run_place(plan: WindowPlan, at: int, first: int) -> tuple[int, int]:
    """Sequence and offset of a token of the gapless run of powers of two.

    The last, unfilled window is split where its length has a binary digit, so each
    of these shorter sequences has a power of two of tokens.
    """
    window, offset = divmod(at, plan.capacity)
    whole, rest = divmod(plan.run_tokens, plan.capacity)
    if window < whole:
        return first + window, offset
    sequence, start = first + whole, 0
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            if offset < start + (1 << bit):
                break
            start += 1 << bit
            sequence += 1
    return sequence, offset - start


def _bits(length: int) -> list[int]:
    return [b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def _cut_crcs(raw: bytes, capacity: int) -> tuple[list[int], int, list[int]]:
    """Checksums of the whole windows, of the remainder, and of the remainder's power-of-two pieces."""
    step = 4 * capacity
    whole = len(raw) // step * step
    tail = raw[whole:]
    pieces, at = [], 0
    for bit in _bits(len(tail) // 4):
        pieces.append(zlib.crc32(tail[at : at + (4 << bit)]))
        at += 4 << bit
    return [zlib.crc32(raw[i : i + step]) for i in range(0, whole, step)], zlib.crc32(tail), pieces


CUT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("tail", T.IntegerType()),
        T.StructField("crcs", T.ArrayType(T.LongType())),
        T.StructField("tail_crc", T.LongType()),
        T.StructField("piece_crcs", T.ArrayType(T.LongType())),
    ]
)

PIECE_SCHEMA = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
)


def token_cuts(docs: DataFrame, vocabulary: str, kind: str, end_id: int, capacity: int) -> DataFrame:
    """Per document its number of tokens and the checksums of every piece it may be cut into."""

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, kind).encode
        end = np.array([end_id], np.uint32)
        for batch in doc_batches(batches):
            sizes, found = [], []
            for ids in encode(batch.column("text").to_pylist()):
                found.append(_cut_crcs(np.concatenate([ids, end]).astype("<u4").tobytes(), capacity))
                sizes.append(len(ids) + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    longs(sizes),
                    pa.array([n % capacity for n in sizes], pa.int32()),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                ],
                names=CUT_SCHEMA.names,
            )

    return docs.select("doc_id", "text").mapInArrow(cuts, CUT_SCHEMA)


PLACED_SCHEMA = T.StructType(
    [
        *CUT_SCHEMA.fields,
        T.StructField("part", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("windows_before", T.LongType()),
    ]
)


def _with_windows_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the whole windows of the earlier rows of the same partition."""
    seen = 0
    for batch in batches:
        lists = batch.column("crcs")
        counts = np.diff(lists.offsets.to_numpy())
        before = seen + np.cumsum(counts) - counts
        seen += int(counts.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, longs(before)], names=PLACED_SCHEMA.names)


def pack(
    docs: DataFrame,
    vocabulary: str,
    kind: str = "byte_level",
    end_id: int = 1,
    capacity: int = 2048,
    max_padding: int = 0,
) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens (a power of two).

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. Every sequence is full, has a power of two of tokens, or is at most
    ``max_padding`` short. A null or empty text is its end id alone; repeated rows are
    packed once each; a null doc_id stays null; an empty table gives no rows; columns
    other than doc_id and text are not read.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    cuts = scratch.save(token_cuts(docs, vocabulary, kind, end_id, capacity), "cuts")
    ordered = numbered(cuts, "tail", "doc_id", "tokens", "tail_crc")
    placed = scratch.save(ordered.mapInArrow(_with_windows_before, PLACED_SCHEMA), "placed")
    scratch.drop("cuts")
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    row_base = prefix({r["part"]: r["n"] for r in parts})
    # One row per distinct remainder length: fewer than the window has tokens.
    lengths = placed.groupBy("tail").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r["tail"]: r["n"] for r in lengths}
    first_of = prefix(histogram)
    whole_windows = placed.groupBy("part").agg(F.sum(F.size("crcs")).alias("n")).collect()
    window_base = prefix({r["part"]: r["n"] for r in whole_windows})
    windows = sum(r["n"] for r in whole_windows)
    plan = plan_windows(histogram, capacity, max_padding)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches):
            out: list[tuple] = []
            for row in batch.to_pylist():
                doc, tokens, tail = row["doc_id"], row["tokens"], row["tail"]
                for k, crc in enumerate(row["crcs"]):
                    sequence = window_base[row["part"]] + row["windows_before"] + k
                    out.append((doc, k * capacity, capacity, crc, tokens, sequence, 0))
                if not tail:
                    continue
                start = tokens - tail
                rank = row_base[row["part"]] + row["place"] - first_of[tail]
                if rank < plan.whole[tail]:
                    since, window, copies, offset = next(r for r in reversed(plan.ranges[tail]) if r[0] <= rank)
                    turn, copy = divmod(rank - since, copies)
                    sequence = windows + window + turn
                    out.append((doc, start, tail, row["tail_crc"], tokens, sequence, offset + copy * tail))
                    continue
                for bit, crc in zip(_bits(tail), row["piece_crcs"], strict=True):
                    nth = plan.piece_base[tail, bit] + rank - plan.whole[tail]
                    sequence, offset = _run_place(plan, plan.run_base[bit] + (nth << bit), windows + plan.windows)
                    out.append((doc, start, 1 << bit, crc, tokens, sequence, offset))
                    start += 1 << bit
            columns = zip(*out, strict=True) if out else [()] * len(PIECE_SCHEMA.names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=PIECE_SCHEMA.names)

    return placed.mapInArrow(pieces, PIECE_SCHEMA)
