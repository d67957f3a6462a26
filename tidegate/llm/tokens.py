"""Token ids of whole texts, made piece by piece through a table each Python worker keeps.

Byte-pair encoding never merges across the boundaries of its word pattern. A text is
cut at boundaries that hold in any context, each distinct piece is encoded once by the
``tokenizers`` library, and the ids of a text are the ids of its pieces in order. Pieces
are found and looked up with numpy, by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark import TaskContext

#: Bytes of text handled at once; longer texts are cut between pieces.
BLOCK_BYTES = 1 << 19
#: Pieces one worker keeps; beyond it the table starts anew.
MOST_KEPT = 1_500_000
#: Words given to the library in one call.
WORDS_A_CALL = 256

BLANK, NEWLINE = 0x20, 0x0A


def worker_value(key, make: Callable):
    """Value that stays with the Python worker process from task to task."""
    home = sys.modules.setdefault("_tidegate_worker", types.ModuleType("_tidegate_worker"))
    values = home.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


def _stage() -> int:
    task = TaskContext.get()
    return task.stageId() if task else -1


def _encoders() -> dict:
    """By vocabulary, the stage whose tasks use an encoder, and the encoder."""
    return worker_value("encoders", dict)


def drop_encoders() -> None:
    """Frees the encoders that tasks of other stages left in this worker; they hold a hundred MB or more."""
    kept, stage = _encoders(), _stage()
    for key in [key for key, (owner, _) in kept.items() if owner != stage]:
        del kept[key]


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class PieceHash:
    """Hash of any byte range of a block by prefix sums: sum of value(byte) * base^position."""

    def __init__(self, length: int = 2 * BLOCK_BYTES, seed: int = 20240229) -> None:
        self.seed = seed
        self.values = _byte_values(seed)
        base = 0x9E3779B97F4A7C15
        self.power = self._powers(base, length)
        self.inverse = self._powers(pow(base, -1, 1 << 64), length)

    @staticmethod
    def _powers(base: int, length: int) -> np.ndarray:
        out = np.full(length, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def grow(self, length: int) -> None:
        if length > len(self.power):
            self.__init__(2 * length, self.seed)

    def _sums(self, data: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        return sums

    @staticmethod
    def _mixed(out: np.ndarray) -> np.ndarray:
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return out

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self._sums(data)
        return self._mixed((sums[end] - sums[start]) * self.inverse[start])

    def every(self, data: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all ranges of ``width`` bytes, as ``of`` makes them."""
        sums = self._sums(data)
        out = sums[width:] - sums[:-width]
        out *= self.inverse[: len(out)]
        return self._mixed(out)


def _solid(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the character that starts, and the one that ends, at a byte is surely no white space."""
    ascii_ = (data > 0x20) & (data < 0x7F)
    starts = ascii_ | ((data >= 0xC3) & (data != 0xE1) & (data != 0xE2) & (data != 0xE3))
    ends = ascii_.copy()
    for back, low, high in ((1, 0xC3, 0xDF), (2, 0xE4, 0xEF), (3, 0xF0, 0xF4)):
        ends[back:] |= (data[:-back] >= low) & (data[:-back] <= high)
    return starts, ends


def byte_level_pieces(data: np.ndarray, doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces for vocabularies whose words take a leading blank: all bytes, cut before single blanks and around newlines."""
    starts, ends = _solid(data)
    inner = np.zeros(len(data), bool)
    inner[1:-1] = ends[:-2] & starts[2:]
    inner[doc_start[doc_start < len(data)]] = False
    last = doc_start[(doc_start > 0) & (doc_start <= len(data))] - 1
    inner[last] = False
    cut = inner & ((data == BLANK) | (data == NEWLINE))
    cut[1:] |= inner[:-1] & (data[:-1] == NEWLINE)
    cut[doc_start[doc_start < len(data)]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(data))


def spaced_pieces(data: np.ndarray, doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces for vocabularies that drop white space: what stands between blanks and newlines."""
    word = (data != BLANK) & (data != NEWLINE)
    edge = np.zeros(len(data) + 1, bool)
    edge[doc_start] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    start = word & (~before | edge[:-1])
    end = word & (~after | edge[1:])
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def folded(data: bytes) -> bytes:
    """ASCII letters in lower case, but for pieces that hold ``<|``: special tokens are known in one case only."""
    small = data.lower()
    at = data.find(b"<|")
    if at < 0:
        return small
    out, done = [], 0
    while at >= 0:
        begin = max(data.rfind(b" ", done, at), data.rfind(b"\n", done, at), done - 1) + 1
        ends = [e for e in (data.find(b" ", at), data.find(b"\n", at)) if e >= 0]
        end = min(ends, default=len(data))
        out += [small[done:begin], data[begin:end]]
        done, at = end, data.find(b"<|", end)
    return b"".join([*out, small[done:]])


class Encoder:
    """Encodes texts to ids with a vocabulary file of the ``tokenizers`` library.

    ``kind`` says how texts may be cut: ``byte_level`` or ``spaced`` (the latter for
    vocabularies that fold case as well, so ASCII capitals are folded first, see ``folded``).
    """

    def __init__(self, path: str, kind: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fold = kind == "spaced"
        self.cut = spaced_pieces if self.fold else byte_level_pieces
        self.hash = PieceHash()
        self._empty()

    def _empty(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.length = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, before: np.ndarray, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Adds pieces; ``before`` are the places of their ascending hashes in the table."""
        texts = [p.decode() for p in pieces]
        ids, words = [], []
        for i in range(0, len(texts), WORDS_A_CALL):
            found = self.tokenizer.encode(texts[i : i + WORDS_A_CALL], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            words.append(np.array(found.word_ids, np.int64) + i)
        length = np.bincount(np.concatenate(words), minlength=len(texts))
        at = np.cumsum(length) - length + len(self.ids)
        self.ids = np.concatenate([self.ids, *ids])
        self.known = np.insert(self.known, before, hashes)
        self.at = np.insert(self.at, before, at)
        self.length = np.insert(self.length, before, length.astype(np.int32))

    def block(self, data: bytes, doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts in one buffer and, per text, the number of its ids."""
        if self.fold:
            data = folded(data)
        codes = np.frombuffer(data, np.uint8)
        start, end = self.cut(codes, doc_start)
        hashes = self.hash.of(codes, start, end)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MOST_KEPT:
            self._empty()
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            where = first[new]
            spans = zip(start[where].tolist(), end[where].tolist(), strict=True)
            self._learn(at[new], unique[new], [data[a:b] for a, b in spans])
            at = np.searchsorted(self.known, unique)
        length = self.length[at][which].astype(np.int64)
        total = np.cumsum(length)
        source = np.repeat(self.at[at][which] - (total - length), length) + np.arange(total[-1] if len(total) else 0)
        before = np.append(0, total)
        edges = before[np.searchsorted(start, np.append(doc_start, len(codes)))]
        return self.ids[source], np.diff(edges)

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; a null text counts as empty."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode() if text else b""
            if held and size + len(raw) > BLOCK_BYTES:
                yield from self._several(held)
                held, size = [], 0
            if len(raw) > BLOCK_BYTES:
                yield np.concatenate([next(self._several([part])) for part in self._parts(raw)])
            else:
                held.append(raw)
                size += len(raw)
        yield from self._several(held)

    def _several(self, raws: list[bytes]) -> Iterator[np.ndarray]:
        sizes = np.array([len(r) for r in raws], np.int64)
        if not sizes.sum():
            yield from (np.empty(0, np.uint32) for _ in raws)
            return
        full = sizes > 0
        starts = np.cumsum(sizes[full]) - sizes[full]
        ids, counts = self.block(b"".join(raws), starts)
        parts = iter(np.split(ids, np.cumsum(counts)[:-1]))
        yield from (next(parts) if f else np.empty(0, np.uint32) for f in full.tolist())

    def _parts(self, raw: bytes) -> Iterator[bytes]:
        """A long text in blocks that end between two pieces."""
        while len(raw) > BLOCK_BYTES:
            size = BLOCK_BYTES
            while True:
                head = folded(raw[:size]) if self.fold else raw[:size]
                start, _ = self.cut(np.frombuffer(head, np.uint8), np.zeros(1, np.int64))
                # The last cut was judged with all its neighbours in view; later ones may not have been.
                if len(start) > 1 and start[-1] > 0:
                    yield raw[: start[-1]]
                    raw = raw[start[-1] :]
                    break
                if size >= len(raw):
                    yield raw
                    return
                size *= 2
        if raw:
            yield raw


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it stays for the tasks of a stage."""
    kept = _encoders()
    _, found = kept.get((path, kind), (None, None))
    kept[path, kind] = _stage(), found or Encoder(path, kind)
    return kept[path, kind][1]
