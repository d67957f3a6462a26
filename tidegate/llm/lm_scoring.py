"""Log probabilities of whole texts under a self-attention model and a word-frequency base.

The corpus gives word counts, counts of neighbouring ids, and the training texts; each is
gathered from all training documents. Training is data-parallel: in each round every partition
trains from the same weights on its share of the windows of each of its texts, and the weights
are averaged, first in tasks; the rounds together learn every window once.

Counts of frequent words and of frequent pairs of ids go to every task, up to a bound; those of
all other words and pairs reach the documents by a join.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.attention_model import (
    FREQUENT,
    GROUPS,
    OVERLAP,
    Prior,
    Trainer,
    Weights,
    assign_classes,
    average,
    count_neighbours,
    frequent_ids,
    log_chances,
    text_windows,
)
from tidegate.llm.common import Scratch, doc_batches, longs
from tidegate.llm.near_dedup import mix, word_hashes
from tidegate.llm.tokens import PieceHash, encoder, worker_value

#: Weight of the class-wide chance of an id against its counts after one class.
PRIOR = 20.0
#: Taken off the count of every pair of ids for what was not seen after the first.
DISCOUNT = 0.75
RATES = (0.012, 0.008, 0.005, 0.003, 0.0015)
#: Entries a counting task holds before it sends them.
HELD = 1 << 20
#: Rows a counting task sends in one batch.
SENT = 1 << 16
#: Bytes of training text that one partition trains on; its weights come to the driver.
PART_BYTES = 16_000_000
#: Ids whose counts a task sends in one value.
BLOCK = 4
#: Windows scored or learned at once.
CHUNK = 2048
#: Ids whose pairs are looked up at once.
LOOKED_UP = 1 << 15


@dataclass
class Context:
    """Classes of ids, and log p(class | id before), from which the attention model starts."""

    classes: np.ndarray
    prior: np.ndarray

    def __getstate__(self) -> dict:
        """Compressed: what is sent lies on disk twice, and most places are alike where a table of texts is small."""
        return {
            name: (a.dtype.str, a.shape, pa.compress(np.ascontiguousarray(a), "zstd", asbytes=True) if a.size else b"")
            for name, a in self.__dict__.items()
        }

    def __setstate__(self, state: dict) -> None:
        for name in list(state):
            kind, shape, raw = state.pop(name)
            room = math.prod(shape) * np.dtype(kind).itemsize
            plain = pa.decompress(raw, room, "zstd") if room else b""
            setattr(self, name, np.frombuffer(plain, kind).reshape(shape))

    def windows(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and ids before the targets, of windows of ids as ``text_windows`` makes them."""
        classes = np.append(self.classes, [self.prior.shape[1], -1]).astype(np.int32)[own]
        return classes[:, :-1], classes[:, OVERLAP + 1 :], own[:, OVERLAP:-1]


@dataclass
class Emission(Context):
    """p(id | class of the id, id before): counts of pairs, and beneath them p(id | its class, class before).

    ``table`` has the latter, one row per class before. By the id before and the class, ``left`` is what all pairs
    of ids leave to ``table``, and ``kinds`` how many pairs there are if ``pairs`` lacks some of them, else 0.
    ``share`` is the part of each of ``pairs`` in all pairs of its first id with that class.
    """

    table: np.ndarray
    pairs: np.ndarray
    share: np.ndarray
    left: np.ndarray
    kinds: np.ndarray

    def log_chances(self, ids: np.ndarray) -> np.ndarray:
        """By ``pairs``; an id whose pair may be one beyond them follows the class before."""
        return self.parted(ids)[0]

    def parted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log chances by ``pairs``, and of the pairs that may be beyond them the key, ``left`` and a unit.

        Such an id, here at the chance after the class before, has this chance times left * (1 + (n - DISCOUNT) / unit)
        if its pair has a count n, and times left if it has none.
        """
        return self.parted_texts(ids, np.zeros(1, np.int64))[:4]

    def parted_texts(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """``parted`` of texts that follow each other in ``ids`` from the places ``first`` on, and the places of the pairs beyond."""
        size = len(self.classes)
        own = self.classes[ids]
        before, above = np.roll(ids, 1), np.roll(own, 1)
        before[first], above[first] = size, len(self.table) - 1
        alone = self.table[above, ids]
        left = self.left[before, own]
        chance = left * alone
        wanted, there = before * size + ids, np.zeros(len(ids), bool)
        if len(self.pairs):
            # In ascending order most steps of a search find their place in the processor's cache. Sorting by halves of
            # 16 bits is the fastest; a half that doesn't fit costs some of that order only.
            order = np.argsort(ids.astype(np.uint16), kind="stable")
            order = order[np.argsort(before[order].astype(np.uint16), kind="stable")]
            at = np.empty(len(wanted), np.int64)
            at[order] = np.searchsorted(self.pairs, wanted[order])
            at[at == len(self.pairs)] = 0
            there = self.pairs[at] == wanted
            chance += np.where(there, self.share[at], np.float32(0))
        kinds = self.kinds[before, own]
        beyond = np.flatnonzero((kinds > 0) & ~there)
        chance[beyond] = alone[beyond]
        unit = kinds[beyond] * np.float32(DISCOUNT) * alone[beyond]
        return np.log(chance), wanted[beyond], left[beyond], unit, beyond


@dataclass
class PairCounts:
    """What an emission is made of, on the driver: counts of ids after each class (``place``: class before, id), of all
    pairs of ids by the id before and the class (``cells``: pairs in ``total``, different ones in ``kinds``), and of ``pairs``.
    """

    classes: np.ndarray
    place: np.ndarray
    times: np.ndarray
    cells: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    pairs: np.ndarray
    n: np.ndarray

    def emission(self) -> Emission:
        classes, size, number = self.classes, len(self.classes), int(self.classes.max()) + 1
        table = np.zeros((number + 1, size), np.float32)
        table.ravel()[self.place] = self.times
        alone = table.sum(0) + np.float32(0.1)
        of_class = np.bincount(classes, weights=alone, minlength=number)
        chance = (alone / of_class[classes]).astype(np.float32)
        follow = np.zeros((number + 1, number))
        for before in range(number + 1):
            total = np.bincount(classes, weights=table[before], minlength=number)
            follow[before] = (total + of_class / of_class.sum()) / (total.sum() + 1)
            table[before] = (table[before] + PRIOR * chance) / (total[classes] + PRIOR)
        shape, cells = (size + 1, number), (size + 1) * number
        left, total = np.ones(cells, np.float32), np.zeros(cells, np.float32)
        left[self.cells], total[self.cells] = self.kinds * DISCOUNT / self.total, self.total
        # Pairs of a cell that all are in ``pairs`` leave none beyond it.
        place = self.pairs // size * number + classes[self.pairs % size]
        kinds = np.zeros(cells, np.uint16)
        kinds[self.cells] = np.where(self.kinds > np.bincount(place, minlength=cells)[self.cells], self.kinds, 0)
        exact = np.zeros(cells)
        exact[self.cells] = self.total
        share = ((self.n - DISCOUNT) / exact[place]).astype(np.float32)
        left, total, kinds = (a.reshape(shape) for a in (left, total, kinds))
        # Classes after an id by its pairs, and what they leave by the classes after its class.
        every = np.maximum(total.sum(1, keepdims=True), 1)
        prior = follow.astype(np.float32)[np.append(classes, number)]
        some = total > 0
        prior *= np.where(total.any(1, keepdims=True), DISCOUNT * some.sum(1, keepdims=True) / every, 1)
        prior += np.where(some, total - DISCOUNT, 0) / every
        return Emission(classes, np.log(prior, dtype=np.float32), table, self.pairs, share, left, kinds)


def _hasher() -> PieceHash:
    return worker_value("words", lambda: PieceHash(1 << 18, 7))


def _ids(vocabulary: str, end_id: int, texts: list[str]) -> Iterator[np.ndarray]:
    for ids in encoder(vocabulary, "spaced").encode(texts):
        yield np.append(ids, end_id).astype(np.int64)


class _Counter:
    """Counts of 64-bit keys, sent in sorted lots."""

    def __init__(self, kind: int) -> None:
        self.kind, self.held, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> None:
        self.held.append(keys)
        self.size += len(keys)

    def send(self) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(self.held), return_counts=True)
        self.held, self.size = [], 0
        for i in range(0, len(keys), SENT):
            part = keys[i : i + SENT]
            kinds = pa.array(np.full(len(part), self.kind, np.int32))
            columns = [kinds, longs(part), longs(counts[i : i + SENT])]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n"])


WORDS, PAIRS = 0, 1
PART_NAMES = ["doc_id", "text_hash", "key", "times", "n_tokens", "n_known", "base"]


def _counted(frame: DataFrame, kind: int, keys_of) -> DataFrame:
    """kind, key and n: counts of the 64-bit keys that ``keys_of`` finds in each value of the one column."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(kind)
        for batch in doc_batches(batches, 256):
            for value in batch.column(0).to_pylist():
                counter.add(keys_of(value))
            if counter.size >= HELD:
                yield from counter.send()
        if counter.size:
            yield from counter.send()

    return frame.mapInArrow(rows, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _summed(dealt: DataFrame, size: int, width: int, add_to) -> np.ndarray:
    """``width`` sums per id over the texts; ``add_to`` adds some texts to a flat table.

    Tasks send the blocks of ids that they met; one summed row per block comes to the driver, whatever the corpus.
    """

    def sent(places: list[int], blocks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(places), 256):
            raw = pa.array([block.tobytes() for block in blocks[i : i + 256]], pa.binary())
            yield pa.RecordBatch.from_arrays([longs(places[i : i + 256]), raw], names=["block", "n"])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A part of PART_BYTES stays far below 32 bits; sums of parts have 64.
        own = np.zeros((-(-size // BLOCK), BLOCK * width), np.uint32)
        for batch in doc_batches(batches, 64):
            add_to([np.frombuffer(raw, "<u2").astype(np.int64) for raw in batch.column("ids").to_pylist()], own.reshape(-1))
        met = np.flatnonzero(own.any(1))
        yield from sent(met.tolist(), [own[i] for i in met])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), strict=True):
                held.setdefault(i, np.zeros(BLOCK * width, np.int64))[:] += np.frombuffer(raw, np.uint32)
        yield from sent(list(held), list(held.values()))

    kind = "block long, n binary"
    found = dealt.mapInArrow(tables, kind).repartition("block").mapInArrow(merged, kind)
    out = np.zeros((-(-size // BLOCK), BLOCK * width), np.int64)
    for r in found.collect():
        out[r["block"]] = np.frombuffer(bytes(r["n"]), np.int64)
    return out.reshape(-1, width)[:size]


def _classes(dealt: DataFrame, counts: DataFrame, size: int) -> np.ndarray:
    """The classes of ids, from the counts and neighbours of all training ids."""
    found = counts.where(F.col("kind") == PAIRS).groupBy((F.col("key") % size).alias("id")).agg(F.sum("n").alias("n")).toArrow()
    times = np.zeros(size, np.int64)
    times[found.column("id").to_numpy()] = found.column("n").to_numpy()
    anchor = frequent_ids(times)
    table = _summed(dealt, size, GROUPS * (FREQUENT + 1), lambda texts, own: count_neighbours(texts, anchor, own))
    return assign_classes(times, table.reshape(size, GROUPS, FREQUENT + 1))


def _pair_counts(counts: DataFrame, classes: np.ndarray, size: int, most: int) -> PairCounts:
    """One vector per class, sums by id before and class, and ``most`` pairs come to the driver, whatever the corpus."""
    number = int(classes.max()) + 1
    shared = counts.sparkSession.sparkContext.broadcast(np.append(classes, number).astype(np.int64))

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            columns = [longs(shared.value[key // size]), longs(key % size), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, names=["before", "id", "n"])

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            cell = key // size * number + shared.value[key % size]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column("n")], names=["cell", "n"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            first, ids, n = (batch.column(c).to_numpy() for c in ("before", "id", "n"))
            for before in np.unique(first).tolist():
                mine = first == before
                held.setdefault(before, np.zeros(size, np.float32))[ids[mine]] += n[mine]
        for before, vector in held.items():
            yield pa.RecordBatch.from_arrays([longs([before]), pa.array([vector.tobytes()], pa.binary())], names=["before", "n"])

    pairs = counts.where(F.col("kind") == PAIRS).select("key", "n")
    summed = pairs.mapInArrow(by_class, "before long, id long, n long").groupBy("before", "id").agg(F.sum("n").alias("n"))
    found = summed.repartition("before").mapInArrow(vectors, "before long, n binary").collect()
    table = np.zeros((number + 1, size), np.float32)
    for r in found:
        table[r["before"]] += np.frombuffer(bytes(r["n"]), np.float32)
    place = np.flatnonzero(table)
    # Each pair is one row of the counts.
    sums = pairs.mapInArrow(by_cell, "cell int, n long").groupBy("cell")
    sums = sums.agg(F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("kinds")).toArrow()
    cells, total, kinds = (sums.column(c).to_numpy() for c in ("cell", "n", "kinds"))
    keys, n = _frequent(counts, PAIRS, most)
    return PairCounts(classes, place.astype(np.int32), table.ravel()[place], cells, total, kinds, keys, n)


def _train(dealt: DataFrame, parts: int, classes: int, shared: Broadcast) -> Weights:
    """Every round learns another share of the windows of each text; together they learn each window once."""
    weights = Weights.fresh(classes)
    # The first round starts from the prior alone.
    weights.arrays["out"][:] = 0

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(n, w) for b in batches for n, w in zip(b.column("seen").to_pylist(), b.column("weights").to_pylist(), strict=True)]
        if found:
            # In order of content, so that the mean doesn't depend on arrival.
            mean = average([(n, Weights(pickle.loads(w))) for n, w in sorted(found)])
            raw = pa.array([pickle.dumps(mean.arrays)], pa.binary())
            yield pa.RecordBatch.from_arrays([longs([sum(n for n, _ in found)]), raw], names=["seen", "weights"])

    for turn, rate in enumerate(RATES):
        given = pickle.dumps(weights.arrays)

        def learn(batches: Iterator[pa.RecordBatch], given=given, rate=rate, turn=turn) -> Iterator[pa.RecordBatch]:
            context = shared.value
            trainer = Trainer(Weights(pickle.loads(given)), rate)
            lot, held = [], 0

            def learn_lot() -> None:
                x, y, before = context.windows(np.concatenate(lot))
                trainer.learn(x, y, Prior(context.prior, before))
                lot.clear()

            for batch in doc_batches(batches, 64):
                for raw in batch.column("ids").to_pylist():
                    # Texts of few windows begin with different rounds.
                    first = (turn - len(raw) // 2) % len(RATES)
                    for own in text_windows(np.frombuffer(raw, "<u2"), len(context.classes), first, len(RATES), CHUNK):
                        lot.append(own)
                        held += len(own)
                        if held >= CHUNK:
                            learn_lot()
                            held = 0
            if held:
                learn_lot()
            if trainer.seen:
                yield pa.RecordBatch.from_arrays(
                    [longs([trainer.seen]), pa.array([pickle.dumps(trainer.weights.arrays)], pa.binary())],
                    names=["seen", "weights"],
                )

        kind = "seen long, weights binary"
        means = dealt.mapInArrow(learn, kind).repartition(math.isqrt(parts), "weights").mapInArrow(averaged, kind).collect()
        found = sorted((r["seen"], bytes(r["weights"])) for r in means)
        if found:
            weights = average([(n, Weights(pickle.loads(w))) for n, w in found])
    return weights


def _lots(texts: list[np.ndarray]) -> Iterator[range]:
    """Places of texts that follow each other and have LOOKED_UP ids or little more together; a longer one may end a lot."""
    start, held = 0, 0
    for i, ids in enumerate(texts):
        held += len(ids)
        if held >= LOOKED_UP or i + 1 == len(texts):
            yield range(start, i + 1)
            start, held = i + 1, 0


def _log10_texts(
    texts: list[np.ndarray], weights: Weights, emission: Emission, beyond: list[tuple[np.ndarray, np.ndarray]] | None = None
) -> np.ndarray:
    """log10 probability of each id sequence; windows of many texts are scored together.

    ``beyond`` receives keys and units of each text's pairs that may be beyond those of ``emission``; they are
    then scored as having no count.
    """
    out = np.zeros(len(texts))
    lot, owner, held = [], [], 0

    def score() -> None:
        x, y, before = emission.windows(np.concatenate(lot))
        np.add.at(out, np.concatenate(owner), log_chances(weights, x, y, Prior(emission.prior, before)).sum(1))
        lot.clear()
        owner.clear()

    for part in _lots(texts):
        first = np.cumsum([0, *(len(texts[i]) for i in part)])
        chances, keys, left, unit, places = emission.parted_texts(np.concatenate([texts[i] for i in part]), first[:-1])
        edge = np.searchsorted(places, first)
        for i, a, b, c, d in zip(part, first, first[1:], edge, edge[1:], strict=False):
            out[i] += chances[a:b].sum(dtype=np.float64)
            if beyond is not None:
                out[i] += np.log(left[c:d]).sum(dtype=np.float64)
                beyond.append((keys[c:d], unit[c:d]))
    for i, ids in enumerate(texts):
        for own in text_windows(ids, len(emission.classes), most=CHUNK):
            lot.append(own)
            owner.append(np.full(len(own), i))
            held += len(owner[-1])
            if held >= CHUNK:
                score()
                held = 0
    if held:
        score()
    return out / math.log(10)


def _frequent(counts: DataFrame, kind: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the highest counts, at most ``most``: all above a power of two."""
    own = counts.where(F.col("kind") == kind)
    sizes = own.groupBy(F.floor(F.log2("n")).alias("log")).agg(F.count(F.lit(1)).alias("keys")).collect()
    least, total = 64, 0
    for r in sorted(sizes, key=lambda r: -r["log"]):
        if total + r["keys"] > most:
            break
        least, total = r["log"], total + r["keys"]
    found = own.where(F.floor(F.log2("n")) >= least).select("key", "n").toArrow()
    keys, n = found.column("key").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def score_texts(
    docs: DataFrame,
    held_out: Column,
    vocabulary: str,
    size: int = 49_408,
    end_id: int = 49_407,
    most_frequent: int = 400_000,
    most_pairs: int = 2_000_000,
) -> DataFrame:
    """Scores of every whole text; rows where ``held_out`` is true are not learned from.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens of the training
    texts among them), train_tokens, base_score (log10, add-one unigram) and score (log10,
    the model over the subword ids of ``vocabulary`` and an end id). The model trains on all training
    texts and has the counts of all their pairs of ids: the ``most_pairs`` most frequent ones go to every task, the
    others reach the texts by a join. A null text is empty: its end is scored. A null doc_id is never held out; repeated rows are scored each;
    an empty table gives no rows; other columns are not read.
    """
    if size > 1 << 16:
        raise ValueError("ids are kept in 16 bits")
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    ).withColumn("text_hash", F.xxhash64("text"))
    training = texts.where("not held_out")
    whole = training.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    train_docs, train_bytes = whole[0], whole[1] or 0

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 256):
            ids = [i.astype("<u2").tobytes() for i in _ids(vocabulary, end_id, batch.column("text").to_pylist())]
            columns = [*(batch.column(c) for c in ("doc_id", "held_out", "text_hash")), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "text_hash", "ids"])

    # Texts are encoded once; counting, training and scoring read the 16-bit ids.
    encoded = texts.mapInArrow(to_ids, "doc_id long, held_out boolean, text_hash long, ids binary")
    encoded = scratch.save(encoded, "ids")
    learned = encoded.where("not held_out")
    parts = max(1, math.ceil(train_bytes / PART_BYTES))
    dealt = scratch.save(learned.select("ids").repartition(parts), "dealt").coalesce(parts)

    def pair_keys(raw: bytes) -> np.ndarray:
        ids = np.frombuffer(raw, "<u2").astype(np.int64)
        return np.append(size, ids[:-1]) * size + ids

    words = _counted(training.select("text"), WORDS, lambda text: word_hashes(text, _hasher()).view(np.int64))
    counts = scratch.save(words.union(_counted(dealt, PAIRS, pair_keys)), "counts")
    words = counts.where(F.col("kind") == WORDS)
    sums = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    distinct, tokens = sums[0] + (train_docs > 0), (sums[1] or 0) + train_docs
    keys, n = _frequent(counts, WORDS, most_frequent)
    classes = _classes(dealt, counts, size)
    shared_counts = _pair_counts(counts, classes, size, most_pairs)
    emission = shared_counts.emission()
    # Training reads the prior alone; a worker lets go of it when scoring sends the rest.
    context = spark.sparkContext.broadcast(Context(classes, emission.prior))
    weights = _train(dealt, parts, int(classes.max()) + 1, context)
    context.unpersist()
    scratch.drop("dealt")
    model = spark.sparkContext.broadcast(emission)
    has_beyond = bool(emission.kinds.any())
    # Every pair that tasks don't have has a smaller count than those that they have.
    least_pair = int(shared_counts.n.min()) if len(shared_counts.n) else (1 << 63) - 1
    del emission, shared_counts
    common = spark.sparkContext.broadcast((keys.view(np.uint64), n))

    def known(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, n = common.value
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        there = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
        return there, n[at[there]] if len(keys) else np.empty(0, np.int64)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 256):
            own = [np.frombuffer(raw, "<u2").astype(np.int64) for raw in batch.column("ids").to_pylist()]
            names, beyond = ["doc_id", "held_out", "text_hash"], []
            score = pa.array(_log10_texts(own, weights, model.value, beyond))
            keys, units = (np.concatenate(part) for part in zip(*beyond, strict=True))
            edge = np.cumsum([0, *(len(k) for k, _ in beyond)]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([longs(keys), pa.array(units, pa.float32())], names=["key", "unit"])
            columns = [*(batch.column(c) for c in names), score, pa.ListArray.from_arrays(pa.array(edge), pairs)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score", "beyond"])

    def base_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document one row with its sums over frequent words, and a row for each other word."""
        for batch in doc_batches(batches, 512):
            keys, times, owners, parts = [], [], [], []
            own = hash((batch.column("doc_id")[0].as_py(), batch.column("text_hash")[0].as_py())) if batch.num_rows else 0
            # Keys of the rows of sums: of no word, and spread over all partitions.
            alone = mix(np.arange(batch.num_rows, dtype=np.uint64) + np.uint64(own & (1 << 63) - 1))
            for i, text in enumerate(batch.column("text").to_pylist()):
                hashes = word_hashes(text, _hasher())
                there, count = known(hashes)
                other, often = np.unique(hashes[~there], return_counts=True)
                keys.append(np.append(other, alone[i]))
                times.append(np.append(often, 0))
                owners.append(np.full(len(other) + 1, i))
                sums = (float(np.log10(count + 1.0).sum()) + math.log10(train_docs + 1), int(there.sum()) + (train_docs > 0))
                parts += [(0, 0, 0.0)] * len(other) + [(len(hashes) + 1, sums[1], sums[0])]
            owner = pa.array(np.concatenate(owners))
            n_tokens, n_known, base = zip(*parts, strict=True)
            columns = [
                batch.column("doc_id").take(owner),
                batch.column("text_hash").take(owner),
                longs(np.concatenate(keys).view(np.int64)),
                longs(np.concatenate(times)),
                longs(n_tokens),
                longs(n_known),
                pa.array(base, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=PART_NAMES)

    main = "doc_id long, held_out boolean, text_hash long, score double, beyond array<struct<key: long, unit: float>>"
    done = scratch.save(encoded.mapInArrow(scored, main), "scored")
    model.unpersist()
    scratch.drop("ids")
    parts = texts.select("doc_id", "text", "text_hash").mapInArrow(
        base_parts,
        "doc_id long, text_hash long, key long, times long, n_tokens long, n_known long, base double",
    )
    found = parts.join(words.select("key", "n"), "key", "left").select(
        "doc_id",
        "text_hash",
        "n_tokens",
        (F.col("n_known") + F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        (F.col("base") + F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("base"),
        F.lit(0.0).alias("gain"),
    )
    if has_beyond:
        others = counts.where((F.col("kind") == PAIRS) & (F.col("n") < least_pair)).select("key", "n")
        met = done.select("doc_id", "text_hash", F.inline("beyond")).join(others, "key")
        gain = F.log10(1 + (F.col("n") - DISCOUNT) / F.col("unit").cast("double"))
        none = [F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0.0)]
        found = found.union(met.select("doc_id", "text_hash", *none, gain))
    sums = (
        found.groupBy("doc_id", "text_hash")
        .agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "gain")))
        .withColumnsRenamed({"doc_id": "d", "text_hash": "t"})
    )
    # Rows that share doc_id and text each sent the same parts.
    copies = done.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    sums = copies.join(sums, same).select(
        "d",
        "t",
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        (F.col("base") / F.col("copies")).alias("base"),
        (F.col("gain") / F.col("copies")).alias("gain"),
    )
    joined = done.join(sums, same)
    norm = math.log10(tokens + distinct + 1)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("score") + F.col("gain")).alias("score"),
    )
