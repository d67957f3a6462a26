"""Benchmark passages in documents, by q-gram lemma filtering.

Texts are compared with ASCII letters folded and runs of ASCII white space as one blank. A
passage of ``m`` characters with at most ``k`` edits shares at least ``m + 1 - q (k + 1)``
character q-grams with its copy, and these lie on ``k + 1`` neighbouring diagonals. So
shared q-grams are counted in overlapping diagonal bands; bands that reach the bound are
verified by banded alignment. Benchmark items are the stated query set: they go to the
tasks in blocks of a bounded number of characters, and documents are never exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidegate.llm.common import doc_batches, longs

#: Lengths of q-grams. An item takes the longest at which copies with all its edits still share one.
GRAMS = (8, 4, 2, 1)
#: Shared q-grams that are expanded at once.
HITS = 1 << 21
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Code points of text handled at once.
CHUNK = 1 << 20
FAR = 1 << 30

LEAK_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "item_id", "distance", "start", "length")]
)


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points, and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    place = np.flatnonzero(keep)
    codes = np.where(white, np.uint32(32), codes)[place]
    return np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes).astype(np.uint32), place


def trimmed(codes: np.ndarray) -> np.ndarray:
    if len(codes) and codes[0] == 32:
        codes = codes[1:]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


def grams(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` characters (a power of two) from each position on."""
    h = codes.astype(np.uint64) + np.uint64(1)
    span = 1
    for mix in MIX[: gram.bit_length() - 1]:
        if len(h) <= span:
            return np.empty(0, np.uint64)
        h = h[:-span] * np.uint64(mix) + h[span:]
        h ^= h >> np.uint64(29)
        span *= 2
    return h * np.uint64(MIX[0])


def banded_ends(item: np.ndarray, text: np.ndarray, first: int, last: int, most: int) -> np.ndarray | None:
    """Fewest edits that align the whole item to text ending on each diagonal of [first, last].

    The alignment may start anywhere on these diagonals and stays on them. Returns the
    distances by diagonal (diagonal d ends before text position len(item) + d), or None
    as soon as all of them exceed ``most``.
    """
    width = last - first + 1
    pad = np.full(len(item) + width + 1, np.uint32(0xFFFFFFFF))
    lo, hi = max(0, first), min(len(text), first + len(pad))
    if hi > lo:
        pad[lo - first : hi - first] = text[lo:hi]
    diagonals = np.arange(first, last + 1)
    ramp = np.arange(width)
    row = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, FAR)
    for i, symbol in enumerate(item):
        new = row + (pad[i : i + width] != symbol)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
        ends = diagonals + i + 1
        if ends[0] < 0 or ends[-1] > len(text):
            row[(ends < 0) | (ends > len(text))] = FAR
        if not i % 8 and row.min() > most:
            return None
    return row


class GramIndex:
    """The q-grams of the items that one length of q-grams serves."""

    def __init__(self, gram: int, items: list[int], codes: list[np.ndarray]) -> None:
        self.gram = gram
        hashes = [grams(codes[i], gram) for i in items]
        item = np.repeat(np.array(items, np.int64), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        self.known, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]
        self.shift = np.uint64(64 - max(16, (16 * max(1, len(self.known))).bit_length()))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), bool)
        self.maybe[(self.known >> self.shift).astype(np.int64)] = True

    def found(self, codes: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the text's known q-grams, and which they are.

        Of a q-gram's occurrences in one stretch of positions the first and the last are enough: in bands at least
        that wide all of them lie in the bands of these two.
        """
        h = grams(codes, self.gram)
        at = np.flatnonzero(self.maybe[(h >> self.shift).astype(np.int64)])
        entry = np.searchsorted(self.known, h[at])
        good = entry < len(self.known)
        good[good] = self.known[entry[good]] == h[at[good]]
        at, entry = at[good], entry[good]
        if stretch > 2 and len(at):
            order = np.lexsort((at, at // stretch, entry))
            at, entry = at[order], entry[order]
            new = (entry[1:] != entry[:-1]) | (at[1:] // stretch != at[:-1] // stretch)
            keep = np.append(True, new) | np.append(new, True)
            at, entry = at[keep], entry[keep]
        return at, entry

    def hits(self, at: np.ndarray, entry: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text position, item and item position of shared q-grams, a bounded number at a time."""
        n = self.count[entry]
        upto = np.cumsum(n)
        begin = 0
        while begin < len(at):
            before = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + HITS, side="right")))
            some = n[begin:end]
            posting = np.repeat(self.first[entry[begin:end]] - (np.cumsum(some) - some), some) + np.arange(some.sum())
            yield np.repeat(at[begin:end], some), self.item[posting], self.place[posting]
            begin = end


@dataclass
class Block:
    """Benchmark items with the indexes of their q-grams."""

    ids: list = field(default_factory=list)
    codes: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, item_id, codes: np.ndarray) -> None:
        self.ids.append(item_id)
        self.codes.append(codes)
        self.size += len(codes)

    def close(self, rate: float) -> Block:
        length = np.array([len(c) for c in self.codes], np.int64)
        self.length = length
        # An item of nothing but edits would be found everywhere.
        self.edits = np.minimum((rate * length + 1e-9).astype(np.int64), length - 1)
        shared = [length + 1 - gram * (self.edits + 1) for gram in GRAMS]
        which = np.argmax(np.array(shared) >= 1, axis=0)
        self.least = np.array(shared)[which, np.arange(len(length))]
        lists = [np.flatnonzero(which == i).tolist() for i in range(len(GRAMS))]
        self.indexes = [GramIndex(gram, items, self.codes) for gram, items in zip(GRAMS, lists, strict=True) if items]
        return self

    def matches(self, codes: np.ndarray, edge: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item, distance, start, end) of verified regions; texts lie between edges."""
        for index in self.indexes:
            yield from self._matches(index, codes, edge)

    def _matches(self, index: GramIndex, codes: np.ndarray, edge: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        low = longest = int(self.length.max(initial=0)) + 1
        bands = (int(np.diff(edge).max(initial=0)) + 2 * low) + 2
        at, entry = index.found(codes, int(self.edits[index.item].min(initial=0)) + 1)
        # A q-gram over the edge of two texts belongs to neither.
        inside = at + index.gram <= edge[np.searchsorted(edge, at, side="right")]
        keys = np.empty(0, np.int64)
        for position, item, place in index.hits(at[inside], entry[inside]):
            text = np.searchsorted(edge, position, side="right") - 1
            band = (position - edge[text] - place + low) // (self.edits[item] + 1)
            own = (text * len(self.ids) + item) * bands + band
            # Each q-gram of an item counts once in a stretch of diagonals, however often it occurs there.
            keys = np.unique(np.concatenate([keys, own * longest + place]))
        key, count = np.unique(keys // longest, return_counts=True)
        nxt = np.zeros(len(key), np.int64)
        nxt[:-1] = np.where(key[1:] == key[:-1] + 1, count[1:], 0)
        owner = key // bands
        which = owner % len(self.ids)
        done = -1
        # A band covers its own and the next stretch of diagonals, so neighbours overlap; the
        # stretch before the first filled one needs no test of its own.
        for i in np.flatnonzero(count + nxt >= self.least[which]).tolist():
            if owner[i] == done:
                continue
            t, it = divmod(int(owner[i]), len(self.ids))
            w, k = int(self.edits[it]) + 1, int(self.edits[it])
            first = int(key[i] % bands) * w - low - k
            own = codes[edge[t] : edge[t + 1]]
            found = self.verify(it, own, first, first + 2 * w + 2 * k)
            if found:
                yield (t, it, *found)
                # Bands come in ascending order: nothing is closer than an exact copy, and later ones start later.
                done = owner[i] if found[0] == 0 else done

    def verify(self, it: int, text: np.ndarray, first: int, last: int) -> tuple[int, int, int] | None:
        """Distance, start and end of the best alignment on the diagonals, if within the budget."""
        item = self.codes[it]
        m = len(item)
        low = max(0, first)
        region = text[low : max(low, last + m)].tobytes()
        same = region.find(item.tobytes())
        while same > 0 and same % 4:
            same = region.find(item.tobytes(), same + 1)
        if same >= 0:
            return 0, low + same // 4, low + same // 4 + m
        row = banded_ends(item, text, first, last, int(self.edits[it]))
        if row is None or row.min() > self.edits[it]:
            return None
        best = int(np.argmin(row))
        distance, end = int(row[best]), m + first + best
        # The same alignment read backwards from its end gives its start.
        back = text[:end][::-1]
        k = int(self.edits[it])
        starts = np.full(2 * k + 1, FAR)
        for extra in range(-k, k + 1):
            starts[extra + k] = _distance_to(item[::-1], back, m + extra, k)
        start = end - (m - k + int(np.argmin(starts)))
        return distance, start, end


def _distance_to(item: np.ndarray, text: np.ndarray, size: int, k: int) -> int:
    """Edits between the item and the first ``size`` characters of the text."""
    if size < 0 or size > len(text):
        return FAR
    other, ramp = text[:size], np.arange(size + 1)
    row = ramp.copy()
    for i, symbol in enumerate(item):
        new = np.empty(size + 1, np.int64)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (other != symbol), row[1:] + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row[-1])


def blocks(benchmark: DataFrame, rate: float, most_chars: int) -> Iterator[Block]:
    """The items in blocks; items of no character but white space match nothing and are left out."""
    block = Block()
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        codes = trimmed(normal(row["text"])[0])
        if not len(codes):
            continue
        if block.ids and block.size + len(codes) > most_chars:
            yield block.close(rate)
            block = Block()
        block.add(row["item_id"], codes)
    if block.ids:
        yield block.close(rate)


def _text_matches(block: Block, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, start, length in the original text) of the best region of each row and item."""
    held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    overlap = int(2 * block.length.max(initial=0) + 4 * block.edits.max(initial=0) + max(GRAMS))

    def note(row: int, item: int, distance: int, start: int, end: int) -> None:
        found = (distance, start, end - start)
        if (row, item) not in best or found < best[row, item]:
            best[row, item] = found

    def flush() -> None:
        if held:
            edge = np.append(0, np.cumsum([len(c) for _, _, c, _ in held]))
            for t, item, distance, start, end in block.matches(np.concatenate([c for _, _, c, _ in held]), edge):
                row, _, _, place = held[t]
                start = min(max(start, 0), len(place) - 1)
                note(row, item, distance, int(place[start]), int(place[min(end, len(place)) - 1]) + 1)
            held.clear()

    size = 0
    for row, text in enumerate(texts):
        if not text:
            continue
        codes, place = normal(text)
        for begin in range(0, max(1, len(codes) - overlap), CHUNK):
            part = slice(begin, begin + CHUNK + overlap)
            held.append((row, begin, codes[part], place[part]))
            size += len(held[-1][2])
            if size >= CHUNK:
                flush()
                size = 0
    flush()
    for (row, item), (distance, start, length) in sorted(best.items()):
        yield row, item, distance, start, length


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, most_chars: int = 4_000_000) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds with at most ``rate`` edits a character.

    Returns doc_id, item_id, distance, start, length: the closest region of each pair, in code
    points of the text, the first of equal ones. Null and empty texts and items match nothing; repeated rows
    are reported each; null ids stay null; empty tables give no rows; other columns are not read.
    An item may have ``rate`` times its characters in edits, but one character less than it has at most.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], LEAK_SCHEMA)
    for block in blocks(benchmark, rate, most_chars):
        shared = spark.sparkContext.broadcast(block)

        def leaks(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in doc_batches(batches, 512):
                ids = batch.column("doc_id").to_pylist()
                rows = list(_text_matches(shared.value, batch.column("text").to_pylist()))
                names = [pa.array([ids[r[0]] for r in rows], pa.int64())]
                names.append(pa.array([shared.value.ids[r[1]] for r in rows], pa.int64()))
                columns = [longs([r[i] for r in rows]) for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([*names, *columns], names=LEAK_SCHEMA.names)

        found = found.union(docs.select("doc_id", "text").mapInArrow(leaks, LEAK_SCHEMA))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, most_chars: int = 4_000_000) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; see ``find_leaks``."""
    for block in blocks(benchmark, rate, most_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in doc_batches(batches, 512):
                good = np.ones(batch.num_rows, bool)
                for row, *_ in _text_matches(shared.value, batch.column("text").to_pylist()):
                    good[row] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
