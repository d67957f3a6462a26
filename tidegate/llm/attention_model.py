"""A small causal self-attention model over classes of subword ids, in numpy.

``p(id | before) = p(class | classes before) * p(id | class)``. One attention layer over a
window of earlier classes predicts the next class, on top of log chances of classes after the
id before that counts give (``prior``); ids of a class share its probability by their corpus counts. Windows overlap: a window's first ``overlap`` positions are context
only, so each token is scored once and, but for the start of a text, has that much context.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WIDTH = 16
HIDDEN = 32
OVERLAP = 16
STRIDE = 32
#: Windows in one step of scoring; a log chance does not depend on it.
BATCH = 128


#: Ids that have a class of their own; the neighbours of an id are counted by these and one class of all others.
FREQUENT = 63
#: Distances of a neighbour: just before, just after, and others within REACH.
GROUPS = 3
REACH = 8
#: Ids whose neighbours are counted at once.
LOT = 1 << 16


def frequent_ids(counts: np.ndarray) -> np.ndarray:
    """The place of each id among the most frequent ones; FREQUENT for all others."""
    anchor = np.full(len(counts), FREQUENT)
    anchor[np.argsort(-counts, kind="stable")[:FREQUENT]] = np.arange(min(FREQUENT, len(counts)))
    return anchor


def count_neighbours(texts: list[np.ndarray], anchor: np.ndarray, table: np.ndarray) -> None:
    """Adds to ``table`` (id, group, frequent neighbour; flat) the neighbours of each id inside its text.

    A lot counts in a table of the ids that it holds, which stays in the processor's cache.
    """
    gap = np.full(REACH, -1, np.int64)
    ids = np.concatenate([part for own in texts for part in (own, gap)])
    width = FREQUENT + 1
    wide = GROUPS * width
    rows, place = table.reshape(-1, wide), np.zeros(len(anchor), np.int32)
    for i in range(0, len(ids), LOT):
        lot = ids[i : i + LOT + REACH]
        met = np.zeros(len(anchor), bool)
        met[lot[lot >= 0]] = True
        met = np.flatnonzero(met)
        place[met] = np.arange(len(met), dtype=np.int32)
        # Pairs with a gap fall into a row behind the others.
        row = np.where(lot < 0, len(met), place[lot]) * np.int32(wide)
        seen = np.where(lot < 0, len(met) * wide, anchor[lot]).astype(np.int32)
        keys = []
        for o in range(1, REACH + 1):
            end = max(0, min(LOT, len(lot) - o))
            before, after = (0, width) if o == 1 else (2 * width, 2 * width)
            keys.append(row[o : end + o] + (seen[:end] + np.int32(before)))
            keys.append(row[:end] + (seen[o : end + o] + np.int32(after)))
        own = np.concatenate(keys)
        own = np.bincount(own[own < len(met) * wide], minlength=len(met) * wide)
        rows[met] += own.reshape(-1, wide).astype(table.dtype)


def assign_classes(counts: np.ndarray, table: np.ndarray, clusters: int = 64, seed: int = 3) -> np.ndarray:
    """Class of every id: the most frequent ids alone, the others clustered by their neighbours.

    ``counts`` and ``table`` (id, group, frequent neighbour) are those of all training ids.
    """
    width = FREQUENT + 1
    classes = frequent_ids(counts)
    rest = np.flatnonzero(classes == FREQUENT)
    seen = rest[counts[rest] > 0]
    features = np.zeros((len(seen) + 1, GROUPS * width), np.float32)
    for g in range(GROUPS):
        own = np.zeros((len(seen) + 1, width), np.float32)
        own[:-1] = table[seen, g]
        prior = (own.sum(0, dtype=np.float64) + 1) / (own.sum(dtype=np.float64) + width)
        own = (own + 4 * prior) / (own.sum(1, keepdims=True) + 4)
        features[:, g * width : (g + 1) * width] = np.sqrt(own)
    draw = np.random.default_rng(seed)
    weight = np.append(np.sqrt(counts[seen]), 1.0)
    centres = features[draw.choice(len(features), min(clusters, len(features)), replace=False, p=weight / weight.sum())]
    for _ in range(8):
        near = np.argmax(features @ centres.T - 0.5 * (centres**2).sum(1), axis=1)
        for k in range(len(centres)):
            mine = near == k
            if mine.any():
                centres[k] = np.average(features[mine], axis=0, weights=weight[mine])
    near = np.argmax(features @ centres.T - 0.5 * (centres**2).sum(1), axis=1)
    classes[seen] = FREQUENT + near[:-1]
    classes[rest[counts[rest] == 0]] = FREQUENT + near[-1]
    return classes.astype(np.int32)


@dataclass
class Weights:
    """Parameters; ``classes`` outputs, one input more for the start of a text."""

    arrays: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, classes: int, seed: int = 1) -> Weights:
        draw = np.random.default_rng(seed)
        shapes = {
            "embed": (classes + 1, WIDTH),
            "place": (OVERLAP + STRIDE, WIDTH),
            "query": (WIDTH, WIDTH),
            "key": (WIDTH, WIDTH),
            "value": (WIDTH, WIDTH),
            "mix": (WIDTH, WIDTH),
            "up": (WIDTH, HIDDEN),
            "down": (HIDDEN, WIDTH),
            "out": (WIDTH, classes),
        }
        arrays = {n: (draw.normal(0, 0.3, s) * (0.3 if n == "place" else 1)).astype(np.float32) for n, s in shapes.items()}
        arrays["up_bias"] = np.zeros(HIDDEN, np.float32)
        arrays["out_bias"] = np.zeros(classes, np.float32)
        return cls(arrays)


def text_windows(ids: np.ndarray, start: int, first: int = 0, step: int = 1, most: int = 1 << 11) -> Iterator[np.ndarray]:
    """Every ``step``-th window of one text from ``first`` on, at most ``most`` at once; places outside the text hold -1.

    A row is one longer than a window's inputs: they are all but its last place, the targets all behind OVERLAP.
    """
    n = -(-len(ids) // STRIDE)
    padded = np.full(n * STRIDE + OVERLAP + 1, -1, np.int32)
    padded[OVERLAP] = start
    padded[OVERLAP + 1 : OVERLAP + 1 + len(ids)] = ids
    begin = np.arange(first, n, step) * STRIDE
    for i in range(0, len(begin), most):
        yield padded[begin[i : i + most, None] + _SPAN]


def windows(classes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets (-1: none) of the windows of one text."""
    own = np.concatenate([np.empty((0, len(_SPAN)), np.int32), *text_windows(classes, start)])
    return own[:, :-1], own[:, OVERLAP + 1 :]


_SPAN = np.arange(OVERLAP + STRIDE + 1)
_CAUSAL = np.where(
    np.arange(OVERLAP + STRIDE)[None, :] <= np.arange(STRIDE)[:, None] + OVERLAP, np.float32(0), np.float32(-1e9)
)


class Room:
    """Arrays used again from step to step: fresh ones of this size cost more than the arithmetic in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, np.float32)
        return self.held[name][:size].reshape(shape)


def _exp_sum(s: np.ndarray) -> np.ndarray:
    """Replaces values by their exponentials, shifted only if they need it, and returns the sums over the last axis."""
    if s.max() > 60:
        s -= s.max(-1, keepdims=True)
    np.exp(s, out=s)
    return s @ np.ones(s.shape[-1], np.float32)


@dataclass
class Prior:
    """Log chances of classes after each id before, for the targets of some windows; ``before`` has their ids before."""

    table: np.ndarray
    before: np.ndarray

    def of(self, rows) -> Prior:
        return Prior(self.table, self.before[rows])


def _projected(w: dict[str, np.ndarray], x: np.ndarray, room: Room) -> dict[str, np.ndarray]:
    """Inputs, those of the scored places alone, and what attention compares and takes of them."""
    n, length = x.shape
    # A place without a class is masked by attention; it reads any row.
    e = np.take(w["embed"], x, axis=0, out=room("e", n, length, WIDTH), mode="clip")
    e += w["place"]
    own = room("own", n, STRIDE, WIDTH)
    own[:] = e[:, OVERLAP:]
    flat, mine = e.reshape(-1, WIDTH), own.reshape(-1, WIDTH)
    q = np.matmul(mine, w["query"] * np.float32(WIDTH**-0.5), out=room("q", n * STRIDE, WIDTH)).reshape(own.shape)
    k = np.matmul(flat, w["key"], out=room("k", n * length, WIDTH)).reshape(e.shape)
    v = np.matmul(flat, w["value"], out=room("v", n * length, WIDTH)).reshape(e.shape)
    return {"e": e, "own": own, "q": q, "k": k, "v": v}


class Places:
    """``_projected`` for weights that stay: what it makes of each class at each place, made once and looked up."""

    def __init__(self, w: dict[str, np.ndarray]) -> None:
        classes = len(w["embed"])
        made = _projected(w, np.repeat(np.arange(classes)[:, None], OVERLAP + STRIDE, axis=1), Room())
        self.rows = {name: made[name].reshape(-1, WIDTH) for name in ("own", "q", "k", "v")}

    def __call__(self, w: dict[str, np.ndarray], x: np.ndarray, room: Room) -> dict[str, np.ndarray]:
        n, length = x.shape
        # A place without a class reads any row, as above.
        x = np.maximum(x, 0).astype(np.intp)
        at, scored = x * length + np.arange(length), x[:, OVERLAP:] * STRIDE + np.arange(STRIDE)
        return {
            name: np.take(rows, i, axis=0, out=room(name, *i.shape, WIDTH), mode="clip")
            for (name, rows), i in zip(self.rows.items(), (scored, scored, at, at), strict=True)
        }


def _forward(
    w: dict[str, np.ndarray], x: np.ndarray, room: Room, prior: Prior | None = None, projected=_projected
) -> dict[str, np.ndarray]:
    n, length, rows = len(x), x.shape[1], len(x) * STRIDE
    f = projected(w, x, room)
    own, q, k, v = f["own"], f["q"], f["k"], f["v"]
    p = np.matmul(q, k.transpose(0, 2, 1), out=room("p", n, STRIDE, length))
    p += _CAUSAL
    # Only the first or last places of a window may lie outside its text.
    short = np.flatnonzero((x[:, 0] < 0) | (x[:, -1] < 0))
    p[short] += np.where(x[short] < 0, np.float32(-1e9), np.float32(0))[:, None, :]
    # A position behind the end of a text may see no key at all; its row is never used.
    p *= (1 / np.maximum(_exp_sum(p), np.float32(1e-30)))[..., None]
    a = np.matmul(p, v, out=room("a", n, STRIDE, WIDTH)).reshape(-1, WIDTH)
    z = np.matmul(a, w["mix"], out=room("z", rows, WIDTH))
    z += own.reshape(-1, WIDTH)
    r = np.matmul(z, w["up"], out=room("r", rows, HIDDEN))
    r += w["up_bias"]
    np.maximum(r, 0, out=r)
    # The last column is 1, for the bias.
    u = room("u", rows, WIDTH + 1)
    np.add(z, np.matmul(r, w["down"], out=room("d", rows, WIDTH)), out=u[:, :WIDTH])
    u[:, WIDTH] = 1
    g = np.matmul(u, np.vstack([w["out"], w["out_bias"]]), out=room("g", rows, w["out"].shape[1]))
    if prior is not None:
        g += np.take(prior.table, prior.before.ravel(), axis=0, out=room("prior", *g.shape), mode="clip")
    return {**f, "p": p, "a": a, "z": z, "r": r, "u": u, "g": g}


def log_chances(weights: Weights, x: np.ndarray, y: np.ndarray, prior: Prior | None = None) -> np.ndarray:
    """Natural log chance of each target; 0 where there is none."""
    out, room = np.zeros(y.size, np.float64), Room()
    # Few windows cost less than every class at every place; the rows are the same.
    projected = Places(weights.arrays) if len(x) > 2 * len(weights.arrays["embed"]) else _projected
    for i in range(0, len(x), BATCH):
        rows = slice(i, i + BATCH)
        g = _forward(weights.arrays, x[rows], room, prior and prior.of(rows), projected)["g"]
        target = y[rows].ravel()
        if g.max() > 60:
            g -= g.max(-1, keepdims=True)
        chosen = g[np.arange(len(g)), np.maximum(target, 0)]
        norm = np.log(_exp_sum(g))
        out[i * STRIDE : i * STRIDE + len(g)] = np.where(target >= 0, chosen - norm, 0)
    return out.reshape(y.shape)


def gradients(
    weights: Weights, x: np.ndarray, y: np.ndarray, prior: Prior | None = None, room: Room | None = None
) -> dict[str, np.ndarray]:
    """Of the mean negative log chance of the targets."""
    w, room = weights.arrays, room or Room()
    f = _forward(w, x, room, prior)
    n, length, rows = len(x), x.shape[1], len(x) * STRIDE
    target = y.ravel()
    none = np.flatnonzero(target < 0)
    dg = f["g"]
    dg *= (1 / _exp_sum(dg))[:, None]
    dg[np.arange(rows), np.maximum(target, 0)] -= 1
    dg[none] = 0
    both = f["u"].T @ dg
    out = {"out": both[:WIDTH], "out_bias": both[WIDTH]}
    du = np.matmul(dg, w["out"].T, out=room("du", rows, WIDTH))
    out["down"] = f["r"].T @ du
    dr = np.matmul(du, w["down"].T, out=room("dr", rows, HIDDEN))
    dr *= f["r"] > 0
    out["up"], out["up_bias"] = f["z"].T @ dr, np.ones(rows, np.float32) @ dr
    dz = np.matmul(dr, w["up"].T, out=room("dz", rows, WIDTH))
    dz += du
    out["mix"] = f["a"].T @ dz
    da = np.matmul(dz, w["mix"].T, out=room("da", rows, WIDTH))
    # The mean of dp under p is da * a, without a pass over the square.
    mean = (da * f["a"]) @ np.ones(WIDTH, np.float32)
    da = da.reshape(n, STRIDE, WIDTH)
    dv = np.matmul(f["p"].transpose(0, 2, 1), da, out=room("dv", n, length, WIDTH)).reshape(-1, WIDTH)
    ds = np.matmul(da, f["v"].transpose(0, 2, 1), out=room("ds", n, STRIDE, length))
    ds -= mean.reshape(n, STRIDE, 1)
    ds *= f["p"]
    dq = np.matmul(ds, f["k"], out=room("dq", n, STRIDE, WIDTH)).reshape(-1, WIDTH)
    dq *= np.float32(WIDTH**-0.5)
    dk = np.matmul(ds.transpose(0, 2, 1), f["q"], out=room("dk", n, length, WIDTH)).reshape(-1, WIDTH)
    flat = f["e"].reshape(-1, WIDTH)
    out["query"] = f["own"].reshape(-1, WIDTH).T @ dq
    out["key"], out["value"] = flat.T @ dk, flat.T @ dv
    de = np.matmul(dk, w["key"].T, out=room("de", n * length, WIDTH))
    de += np.matmul(dv, w["value"].T, out=room("dev", n * length, WIDTH))
    dz += np.matmul(dq, w["query"].T, out=room("deq", rows, WIDTH))
    de = de.reshape(n, length, WIDTH)
    de[:, OVERLAP:] += dz.reshape(n, STRIDE, WIDTH)
    out["place"] = (np.ones(n, np.float32) @ de.reshape(n, -1)).reshape(length, WIDTH)
    at = np.take(np.arange(w["embed"].size).reshape(-1, WIDTH), x, axis=0, mode="clip").ravel()
    out["embed"] = np.bincount(at, weights=de.ravel(), minlength=w["embed"].size).reshape(-1, WIDTH)
    scale = np.float32(1 / max(1, rows - len(none)))
    return {name: (g * scale).astype(np.float32) for name, g in out.items()}


class Trainer:
    """Adam over batches of windows; all parameters lie in one vector."""

    def __init__(self, weights: Weights, rate: float) -> None:
        self.names = list(weights.arrays)
        self.flat = np.concatenate([weights.arrays[n].ravel() for n in self.names])
        ends = np.cumsum([weights.arrays[n].size for n in self.names])
        parts = np.split(self.flat, ends[:-1])
        shapes = [weights.arrays[n].shape for n in self.names]
        self.weights = Weights({n: part.reshape(s) for n, part, s in zip(self.names, parts, shapes, strict=True)})
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.rate, self.steps, self.seen, self.room = rate, 0, 0, Room()

    def learn(self, x: np.ndarray, y: np.ndarray, prior: Prior | None = None, batch: int = 64) -> None:
        """One pass over the windows, in a drawn order."""
        order = np.random.default_rng(self.steps).permutation(len(x))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            self.steps += 1
            pace = self.rate * min(1.0, self.steps / 20)
            found = gradients(self.weights, x[rows], y[rows], prior and prior.of(rows), self.room)
            g = np.concatenate([found[n].ravel() for n in self.names])
            self.first += np.float32(0.1) * (g - self.first)
            self.second += np.float32(0.02) * (g * g - self.second)
            size = np.sqrt(self.second / np.float32(1 - 0.98**self.steps)) + np.float32(1e-8)
            self.flat -= np.float32(pace / (1 - 0.9**self.steps)) * self.first / size
            self.seen += len(rows)


def average(parts: list[tuple[int, Weights]]) -> Weights:
    """Mean of parameters, weighted by the windows each was trained on."""
    total = sum(n for n, _ in parts)
    names = parts[0][1].arrays
    return Weights({k: sum((n / total) * w.arrays[k] for n, w in parts).astype(np.float32) for k in names})
