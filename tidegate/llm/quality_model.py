"""Quality scores from document statistics.

Random Fourier features approximate a Gaussian kernel over the standardised statistics.
Ridge regression on them needs only sums over the labelled rows: each partition sums its
normal equations, the sums are added and solved once. Isotonic regression on a histogram
of the raw scores turns them into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import Scratch, doc_batches

#: Bytes handled at once.
BLOCK_BYTES = 1 << 22
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?'\"()-"
STATISTICS = (
    "log_bytes",
    "symbols",
    "capitals",
    "punctuation",
    "exclamations",
    "digits",
    "blanks",
    "non_ascii",
    "lines_a_word",
    "word_length",
    "distinct_words",
    "distinct_lines",
    "distinct_pairs",
    "common_word",
    "long_words",
)
FEATURE_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.FloatType(), False))]
)


def _class_table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


CLASSES = [
    _class_table(SYMBOLS),
    _class_table(bytes(range(65, 91))),
    _class_table(PUNCTUATION),
    _class_table(b"!"),
    _class_table(bytes(range(48, 58))),
    _class_table(b" \t\n\x0b\x0c\r"),
    _class_table(bytes(range(128, 256))),
]


def _byte_shares(raws: list[bytes]) -> np.ndarray:
    """Share of each byte class in each text."""
    out = np.zeros((len(raws), len(CLASSES)))
    begin = 0
    while begin < len(raws):
        end, size = begin, 0
        while end < len(raws) and (end == begin or size + len(raws[end]) <= BLOCK_BYTES):
            size += len(raws[end])
            end += 1
        data = np.frombuffer(b"".join(raws[begin:end]), np.uint8)
        edge = np.append(0, np.cumsum([len(r) for r in raws[begin:end]]))
        for k, members in enumerate(CLASSES):
            sums = np.append(0, np.cumsum(members[data], dtype=np.int64))
            out[begin:end, k] = np.diff(sums[edge]) / np.maximum(np.diff(edge), 1)
        begin = end
    return out


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of statistics per text; an empty or null text gives zeros."""
    raws = [t.encode() if t else b"" for t in texts]
    out = np.zeros((len(texts), len(STATISTICS)))
    out[:, 0] = np.log1p([len(r) for r in raws])
    out[:, 1:8] = _byte_shares(raws)
    for i, raw in enumerate(raws):
        words = raw.split()
        n = len(words)
        if not n:
            continue
        lines = [line for line in raw.split(b"\n") if line.strip()]
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        lengths = np.fromiter(map(len, words), np.int64, n)
        pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
        out[i, 8:] = (
            len(lines) / n,
            lengths.mean(),
            len(counts) / n,
            len(set(lines)) / len(lines),
            pairs,
            max(counts.values()) / n,
            (lengths > 12).mean(),
        )
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id and statistics ``x`` of every whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1024):
            x = statistics(batch.column("text").to_pylist()).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(list(x), pa.list_(pa.float32()))],
                names=FEATURE_SCHEMA.names,
            )

    return docs.select("doc_id", "text").mapInArrow(rows, FEATURE_SCHEMA)


@dataclass
class QualityModel:
    """Bounded by its parameters: statistics times Fourier features, and the bins of the calibration."""

    centre: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    bins: np.ndarray
    chances: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -5, 5)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.bins, self.chances)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Closest ascending sequence, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten().to_numpy(zero_copy_only=False), float).reshape(-1, len(STATISTICS))


def fit(
    found: DataFrame,
    labels: DataFrame,
    waves: int = 256,
    ridge: float = 1e-3,
    width: float = 3.0,
    bins: int = 1024,
    sums: int = 32,
    seed: int = 11,
) -> QualityModel:
    """Fits on the statistics (of ``features``) of all labelled rows (doc_id, y).

    A doc_id with several rows on either side counts once per pair; rows without statistics,
    doc_id or label are not learned from. Without any labelled row every score is 0.5. The
    driver receives ``sums`` matrices of ``waves`` squared and ``bins`` counts, whatever the
    number of rows.
    """
    rows = found.join(labels.where("y IS NOT NULL"), "doc_id").select("x", F.col("y").cast("double").alias("y"))
    rows = rows.repartition(sums)
    k = len(STATISTICS)
    moments = rows.select(
        F.count(F.lit(1)),
        *(F.avg(F.col("x")[i].cast("double")) for i in range(k)),
        *(F.stddev_pop(F.col("x")[i].cast("double")) for i in range(k)),
    ).first()
    draw = np.random.default_rng(seed)
    model = QualityModel(
        np.array([m or 0.0 for m in moments[1 : k + 1]]),
        np.array([s if s and s > 1e-9 else 1.0 for s in moments[k + 1 :]]),
        draw.normal(0, 1 / width, (k, waves)),
        draw.uniform(0, 2 * np.pi, waves),
        np.zeros(waves + 1),
        np.array([0.0, 1.0]),
        np.array([0.5, 0.5]),
    )
    if not moments[0]:
        return model

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((waves + 1, waves + 2))
        for batch in doc_batches(batches, 8192):
            z = model.fourier(_matrix(batch))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros((waves + 1, waves + 2))
    # In order of content, so that the floating-point sum doesn't depend on arrival.
    for part in sorted(bytes(r["sums"]) for r in rows.mapInArrow(normal_equations, "sums binary").collect()):
        total += np.frombuffer(part).reshape(total.shape)
    penalty = ridge * moments[0] * np.eye(waves + 1) / waves
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    low, high = -0.5, 1.5

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, bins))
        for batch in doc_batches(batches, 8192):
            place = (np.clip(model.raw(_matrix(batch)), low, high - 1e-9) - low) / (high - low) * bins
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for label in (0, 1):
                counts[label] += np.bincount(place[y == label].astype(int), minlength=bins)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])

    counts = np.zeros((2, bins))
    for r in rows.mapInArrow(histogram, "counts binary").collect():
        counts += np.frombuffer(bytes(r["counts"])).reshape(2, bins)
    some = np.flatnonzero(counts.sum(0))
    centres = low + (some + 0.5) * (high - low) / bins
    model.bins = centres
    model.chances = isotonic(counts[1][some] / counts[:, some].sum(0), counts[:, some].sum(0))
    return model


def score_features(found: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of rows of ``features``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 4096):
            scores = np.clip(model.score(_matrix(batch)), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return found.mapInArrow(rows, "doc_id long, score double")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The documents the model scores at the threshold or above, with all their columns, in one pass over the texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1024):
            good = model.score(statistics(batch.column("text").to_pylist()).astype(np.float32)) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(rows, docs.schema)


def fit_on_labels(docs: DataFrame, labels: DataFrame, scratch: Scratch, **settings) -> tuple[QualityModel, DataFrame]:
    """Model learned from labels (doc_id, y), and the saved statistics of all documents."""
    found = scratch.save(features(docs), "features")
    return fit(found, labels, **settings), found
