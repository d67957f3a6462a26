"""Language identification by rank-order profiles.

A profile ranks the most frequent character n-grams of a language. A document's own most
frequent n-grams are ranked in the same way; its distance to a language is the sum, over
them, of how far each is out of place in the profile. The nearest language is predicted.

N-grams have one to three characters and stay inside words, whose ends count as a blank.
Three code points fit into one integer, so n-grams are counted exactly, without a hash,
and ties in frequency go by the n-gram itself.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import Scratch, doc_batches, free_names, longs
from tidegate.llm.tokens import worker_value

#: Ranks of a profile and of a document.
RANKS = 400
#: Characters handled at once.
BLOCK_CHARS = 1 << 20
#: N-grams of all languages one task holds before it sends them.
HELD = 1 << 20
#: Languages whose profiles are sent to every task at once; more languages take more passes.
LANGUAGES_A_PASS = 256
UNKNOWN = "und"
BLANK = 32
_BITS = 21
_BETWEEN_WORDS = regex.compile(r"[^\p{L}\p{M}]")
_OWN = ("lang_pred", "score")


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind of every code point (1 letter, 2 mark, 0 other), and its lower case if that is one letter."""
    kind = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.int64)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category == "L":
            kind[code] = 1
            small = chr(code).lower()
            if len(small) == 1:
                lower[code] = ord(small)
        elif category == "M":
            kind[code] = 2
    return kind, lower


def _grams_of_block(text: str) -> np.ndarray:
    """Every n-gram of a text as an integer, in code point order; empty if it has no letter."""
    kind, lower = worker_value("character tables", _character_tables)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = kind[codes]
    if not (kinds == 1).any():
        return np.empty(0, np.int64)
    word = kinds > 0
    # One blank after each word: a place that is no word character but follows one.
    keep = word.copy()
    keep[1:] |= word[:-1]
    clean = np.full(int(keep.sum()) + 3, 0, np.int64)
    clean[0] = BLANK
    clean[1:-2] = np.where(word, lower[codes], BLANK)[keep]
    if clean[-3] != BLANK:
        clean[-2] = BLANK
    one, two, three = clean[:-2], clean[1:-1], clean[2:]
    letter, before_end = one != BLANK, (one > 0) & (two > 0)
    inside = before_end & (two != BLANK) & (three > 0)
    single = one[letter & (one > 0)] << 2 * _BITS
    pair = (one << 2 * _BITS | two << _BITS)[before_end]
    triple = (one << 2 * _BITS | two << _BITS | three)[inside]
    return np.concatenate([single, pair, triple])


def add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys and summed counts of several such pairs."""
    if len(parts) == 1:
        return parts[0]
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, where, np.concatenate([n for _, n in parts]))
    return keys, sums


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending n-grams of a whole text and how often each occurs."""
    text = text or ""
    parts, begin = [], 0
    while begin < len(text) or not parts:
        cut = _BETWEEN_WORDS.search(text, begin + BLOCK_CHARS)
        end = cut.start() if cut else len(text)
        parts.append(np.unique(_grams_of_block(text[begin:end]), return_counts=True))
        begin = max(end, begin + 1)
    return add_up(parts)


def ranked(grams: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; equal counts by ascending n-gram."""
    if len(grams) > ranks:
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:ranks]


def gram_text(gram: int) -> str:
    codes = (gram >> 2 * _BITS, gram >> _BITS & 0x1FFFFF, gram & 0x1FFFFF)
    return "".join(chr(c) for c in codes if c)


def learn_profiles(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, gram, rank, n): the ``ranks`` most frequent n-grams of each language, rank 0 first.

    Learns from all rows with a ``lang``; a null or letterless text adds nothing, and a
    language without any letter has no profile. Rows that repeat count each time.
    Every task adds up its n-grams before they move, so their number does not follow
    the length of the texts.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[str]] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting = 0

        def count() -> None:
            for lang, some in texts.items():
                found = gram_counts("\n".join(some))
                held[lang] = add_up([held[lang], found]) if lang in held else found
            texts.clear()

        def send() -> Iterator[pa.RecordBatch]:
            for lang, (grams, counts) in held.items():
                names = pa.array([lang] * len(grams), pa.string())
                yield pa.RecordBatch.from_arrays([names, longs(grams), longs(counts)], names=["lang", "gram", "n"])
            held.clear()

        for batch in doc_batches(batches, 256):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    texts.setdefault(lang, []).append(text)
                    waiting += len(text)
                if waiting > BLOCK_CHARS:
                    count()
                    waiting = 0
                    if sum(len(grams) for grams, _ in held.values()) > HELD:
                        yield from send()
        count()
        yield from send()

    rows = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    counted = rows.mapInArrow(sums, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    # The limit on the rank is applied in every task before rows of a language meet.
    return counted.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < ranks)


class Profiles:
    """Profiles of some languages, as ranks by language and n-gram."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int) -> None:
        self.ranks = ranks
        self.langs = sorted({lang for lang, _, _ in rows}, key=str.encode)
        place = {lang: i for i, lang in enumerate(self.langs)}
        grams = np.array([gram for _, gram, _ in rows], np.int64)
        self.grams = np.unique(grams)
        # The last column stands for n-grams that no profile holds.
        self.rank = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        self.rank[[place[lang] for lang, _, _ in rows], np.searchsorted(self.grams, grams)] = [rank for _, _, rank in rows]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document's ranked n-grams to each language."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at[self.grams[at] != own] = len(self.grams)
        rank = self.rank[:, at]
        return np.where(rank < 0, self.ranks, np.abs(rank - np.arange(len(own)))).sum(axis=1)


def detect(docs: DataFrame, profiles: DataFrame, ranks: int = RANKS, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or those in ``keep``) with ``lang_pred`` and ``score``; columns of these names are replaced.

    ``lang_pred`` is the language of the nearest profile, the smaller name among equally
    near ones. ``score`` is the share of the second nearest's distance that the nearest
    saves: 0 when two are equally near, 1 when the ranks are the profile's own. With one
    profile the second distance is that of a document without any known n-gram. A null
    text, a text without a letter, and any text when there is no profile at all get
    ``und`` and 0. Repeated rows are judged one by one; an empty table gives no rows.

    Profiles go to every task, ``LANGUAGES_A_PASS`` languages at a time; further
    languages take further passes over the texts, which carry the two best distances on.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in _OWN]
    names = [r["lang"] for r in profiles.select("lang").distinct().orderBy("lang").collect()]
    best, first, second = state = free_names(docs.columns, "best", "first", "second")
    found = docs.select(*dict.fromkeys([*keep, "text"]))
    found = found.withColumns({n: F.lit(None).cast("string" if n == best else "long") for n in state})

    for begin in range(0, len(names), LANGUAGES_A_PASS):
        end = min(begin + LANGUAGES_A_PASS, len(names))
        some = profiles.where(F.col("lang").between(names[begin], names[end - 1]))
        shared = docs.sparkSession.sparkContext.broadcast([(r["lang"], r["gram"], r["rank"]) for r in some.collect()])
        if end == len(names):
            schema = T.StructType([f for f in found.schema if f.name in keep or f.name in state])
        else:
            schema = found.schema
        found = found.mapInArrow(_nearest(shared, ranks, state, schema.names), schema)

    gap = F.try_divide(F.col(second) - F.col(first), F.col(second))
    return found.select(
        *keep,
        F.coalesce(best, F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(gap, F.lit(0.0)).alias("score"),
    )


def _nearest(shared, ranks: int, state: list[str], names: list[str]):
    """Carries the nearest language and the two least distances over batches; returns the columns ``names``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(shared.value, ranks)
        for batch in doc_batches(batches, 256):
            columns = {n: batch.column(n) for n in batch.schema.names}
            before = zip(*(columns[n].to_pylist() for n in state), strict=True)
            out = []
            for text, (best, first, second) in zip(columns["text"].to_pylist(), before, strict=True):
                own = ranked(*gram_counts(text), profiles.ranks)
                if len(own):
                    near = sorted(zip(profiles.distances(own).tolist(), profiles.langs, strict=True), key=lambda x: x[0])[:2]
                    if best is None:
                        near.append((len(own) * profiles.ranks, None))
                    else:
                        # Languages of earlier passes have smaller names and stay ahead of equals.
                        near = sorted([(first, best), (second, None), *near], key=lambda x: x[0])
                    (first, best), second = near[0], near[1][0]
                out.append((best, first, second))
            for n, values in zip(state, zip(*out, strict=True), strict=True):
                columns[n] = pa.array(values, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return rows


def profile_table(profiles: DataFrame) -> DataFrame:
    """The profiles with their n-grams as text, to read or to keep."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = pa.array([gram_text(g) for g in batch.column("gram").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), grams], names=["lang", "rank", "gram"])

    return profiles.select("lang", "rank", "gram").mapInArrow(rows, "lang string, rank int, gram string")


def identify(docs: DataFrame, learn_from: Column, ranks: int = RANKS, keep: list[str] | None = None) -> DataFrame:
    """Learns profiles from the rows where ``learn_from`` holds and judges every row by them."""
    scratch = Scratch(docs.sparkSession, "languages")
    profiles = scratch.save(learn_profiles(docs.where(learn_from), ranks), "profiles")
    return detect(docs, profiles, ranks, keep)
