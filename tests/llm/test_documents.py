"""Operators on documents against brute force, and the hard cases each must handle."""

from __future__ import annotations

import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidegate.llm import attention_model, decontamination, line_dedup, lm_scoring, near_dedup, suffix_dedup
from tidegate.llm.common import Scratch
from tidegate.llm.components import components
from tidegate.llm.decontamination import find_leaks, without_leaks
from tidegate.llm.line_dedup import dedup_lines
from tidegate.llm.lm_scoring import score_texts
from tidegate.llm.near_dedup import least_agreement, near_duplicates
from tidegate.llm.quality_model import fit, features, isotonic, keep_good, score_features
from tidegate.llm.quality_rules import judge
from tidegate.llm.suffix_dedup import remove_repeats, smallest_docs, suffix_array

from .conftest import doc_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}
WORDS = public_tokenizers.path("word_bpe_49k.json")


def prose(draw, words, stock=400):
    return " ".join(f"w{draw.randrange(stock)}" for _ in range(words))


def corpus(seed=5):
    """Texts with exact and near copies, shared lines and passages."""
    draw = random.Random(seed)
    line, passage = "Shared  Line of this corpus", prose(draw, 60)
    texts = [prose(draw, draw.randint(1, 120)) for _ in range(60)]
    texts += [texts[3]] * 12 + [texts[0].upper()] * 2
    base = prose(draw, 150).split()
    for _ in range(25):
        own = list(base)
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [f"{prose(draw, 20)}\n {line.lower() if i % 2 else line}\t\n{prose(draw, 5)}" for i in range(14)]
    texts += [f"{prose(draw, 9)} {passage} {prose(draw, 9)}" for _ in range(5)]
    return texts


# --- line dedup -------------------------------------------------------------------------


def lines_by_hand(texts, min_docs, keep_first=False):
    split = [(t or "").split("\n") for t in texts]
    key = lambda x: x.strip(" \t\n\v\f\r").translate(FOLD)
    docs = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    first = {}
    for d, lines in enumerate(split):
        for i, x in enumerate(lines):
            first.setdefault(key(x), (d, i))
    out = []
    for d, lines in enumerate(split):
        stay = [x for i, x in enumerate(lines) if docs.get(key(x), 0) < min_docs or keep_first and first[key(x)] == (d, i)]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("settings", [{}, {"most_shipped": 0}, {"filter_bits": 64}, {"keep_first": True}])
def test_line_dedup(spark, hard_texts, settings):
    texts = corpus() + hard_texts + ["é\nA\n a ", "B\nA\r", "\n\n", None]
    rows = dedup_lines(doc_frame(spark, texts).repartition(5), min_docs=3, **settings).collect()
    expected = lines_by_hand(texts, 3, settings.get("keep_first", False))
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_lines, r.n_dropped, r.text or "") == expected[r.doc_id]
        assert (r.text is None) == (texts[r.doc_id] is None) and r.shard == "x"


def test_line_dedup_hard_tables(spark):
    assert dedup_lines(doc_frame(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "a\nb", 1), (None, "a", 2), (7, "a\nc", 3)], "doc_id long, text string, n_lines int")
    for most in (0, 10):
        found = dedup_lines(rows, min_docs=2, most_shipped=most)
        assert sorted((r.text, r.n_lines, r.n_dropped) for r in found.collect()) == [("", 1, 1), ("b", 2, 1), ("c", 2, 1)]


def test_line_dedup_with_any_number_of_slices(spark):
    texts = [f"own {i}\nshared line {i // 2}" for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for slices in (3, 12, 211):
            spark.conf.set("spark.sql.shuffle.partitions", slices)
            rows = dedup_lines(doc_frame(spark, texts).repartition(4), min_docs=2).collect()
            assert {r.n_dropped for r in rows} == {1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_second_filter_holds_every_repeat():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    seen = line_dedup.Seen()
    seen.add(hashes[:300])
    assert seen.test(hashes[:300]).all() and seen.test(hashes[300:]).sum() < 5


# --- near duplicates --------------------------------------------------------------------


def components_by_hand(texts, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(spark, hard_texts, percent):
    texts = corpus() + hard_texts
    rows = near_duplicates(doc_frame(spark, texts).repartition(6), percent=percent).collect()
    expected = components_by_hand(texts, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(expected))
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)


def test_near_duplicates_hard_tables(spark):
    assert near_duplicates(doc_frame(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (4, "c"), (None, "q r s")], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(rows).collect())
    assert found == [
        ("4", 1, "4", True), ("4", 1, "4", True), ("4", 1, "4", True), ("None", 1, "4", False), ("None", 1, "None", True)
    ]


def test_agreement_bound_leaves_few_out():
    for percent in (50, 80, 85):
        p, least = percent / 100, least_agreement(percent / 100)
        miss = sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(least))
        assert miss <= near_dedup.MISS < miss + math.comb(64, least) * p**least * (1 - p) ** (64 - least)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(139, 200), (300, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(frame, Scratch(spark, "c"), "t").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 100}


# --- long repeats -----------------------------------------------------------------------


def repeats_by_hand(texts, length):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        own = [raw[i : i + length] for i in range(len(raw) - length + 1)]
        gone = np.zeros(len(raw) + 1, bool)
        for i, s in enumerate(own):
            if s in seen:
                gone[i : i + length] = True
        seen.update(own)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


@pytest.mark.parametrize("settings", [{}, {"filter_bits": 64}, {"most_shipped": 3}, {"heavy": 3}])
def test_repeats(spark, settings, monkeypatch):
    settings = dict(settings)
    monkeypatch.setattr(suffix_dedup, "HEAVY", settings.pop("heavy", 1000))
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 2000)
    texts = corpus() + [None, "", "é" * 40, "x" * 300, "x" * 200 + "y", "日本語" * 30, "z日本語" * 20 + "日本語" * 30]
    rows = remove_repeats(doc_frame(spark, texts).repartition(5), **settings).collect()
    expected = repeats_by_hand(texts, 50)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id]
        assert sum(r.lengths) == r.n_removed and len(r.starts) == r.n_spans


def test_long_runs_under_one_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LONG_RUN", 300)
    texts = ["a" * (20_000 + i) for i in range(30)] + ["ab" * 3000 + str(i) for i in range(10)] + ["b" + "a" * 60]
    rows = {r.doc_id: r for r in remove_repeats(doc_frame(spark, texts)).collect()}
    assert rows[0].n_removed == 0 and rows[30].n_removed == 0
    assert all(rows[i].n_removed == len(texts[i]) and rows[i].n_spans == 1 for i in range(1, 30))
    # The last byte of the others of period two is their own; it follows 6000 shared ones.
    assert all(bytes(rows[i].kept) == texts[i][6000:].encode() for i in range(31, 40))
    assert bytes(rows[40].kept) == b"b"


def test_lots_of_long_runs_stay_small():
    # What a task sorts for many long one-letter documents: single strings, one of each kind.
    filter_ = type("All", (), {"repeated": 0, "heavy": 1, "test": lambda self, values, which: np.ones(len(values), bool)})()
    start, end, key = suffix_dedup._pieces(b"a" * 1_000_000, filter_, 50)
    assert set((end - start).tolist()) == {50} and len(set(key.tolist())) == 1


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_pieces_of_many_texts_at_once_are_those_of_each(monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "LOT_BYTES", 900)
    draw = random.Random(14)
    texts = ["", "x" * 49, *corpus()[:40], "", "é" * 400, "ab" * 700, "y" * 50, "y" * 50, "z"]
    draw.shuffle(texts)

    def test(self, values, which):
        return values % np.uint64(3) != 0 if which == 0 else values % np.uint64(4) == 0

    filter_ = type("Some", (), {"repeated": 0, "heavy": 1, "test": test})()
    lots = list(suffix_dedup._lots(texts))
    assert [t.encode() for t in texts] == [raw[a:b] for _, raw, at in lots for a, b in zip(at[:-1], at[1:])]
    assert 1 < len(lots) < len(texts) and [f for f, *_ in lots][1:] == list(np.cumsum([len(at) - 1 for *_, at in lots])[:-1])
    got, want = [], []
    for first, raw, bounds in lots:
        start, end, key = suffix_dedup._pieces(raw, filter_, 50, bounds)
        own = np.searchsorted(bounds, start, "right") - 1
        got += zip((first + own).tolist(), (start - bounds[own]).tolist(), (end - bounds[own]).tolist(), key.tolist(), strict=True)
    for i, text in enumerate(texts):
        raw = text.encode()
        values = suffix_dedup.anchors(raw, 50)
        edge = [j for j in range(len(values)) if j == 0 or values[j] != values[j - 1]]
        for a, b in zip(edge, [*edge[1:], len(values)]):
            if values[a] % np.uint64(3) == 0:
                continue
            if values[a] % np.uint64(4):
                want.append((i, a, b + 49, int(values[a])))
            else:
                for j in range(a, b):
                    own = suffix_dedup._hasher().of(np.frombuffer(raw[j : j + 50], np.uint8), np.array([0]), np.array([50]))
                    want.append((i, j, j + 50, int(own[0])))
    assert sorted(got) == sorted(want) and len({i for i, *_ in want}) > 30


def test_repeats_hard_tables(spark):
    assert remove_repeats(doc_frame(spark, [])).collect() == []
    long = "a long line that is surely longer than fifty bytes, is it not? yes"
    rows = spark.createDataFrame([(None, long), (2, long), (2, long), (3, long), (None, None)], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_removed) for r in remove_repeats(rows).collect())
    assert found == [("2", 0), ("2", 0), ("3", len(long)), ("None", 0), ("None", 0)]


def test_suffix_array_and_groups():
    draw = random.Random(2)
    for _ in range(150):
        raw = bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 70)))
        order = suffix_array(np.frombuffer(raw, np.uint8)).tolist()
        assert order == sorted(range(len(raw)), key=lambda i: raw[i:])
    for _ in range(60):
        pieces = [bytes(draw.choice(b"ab") for _ in range(draw.randint(10, 40))) for _ in range(8)]
        docs = np.array([draw.randrange(5) for _ in pieces])
        least = smallest_docs(pieces, docs, 10)
        for p, found in zip(pieces, least):
            for i, d in enumerate(found.tolist()):
                assert d == min(docs[k] for k, q in enumerate(pieces) if p[i : i + 10] in q)


# --- decontamination --------------------------------------------------------------------


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        i = draw.randrange(len(out))
        draw.choice([lambda: out.__setitem__(i, "#"), lambda: out.insert(i, "+"), lambda: out.pop(i)])()
    return "".join(out)


@pytest.mark.parametrize("chunk", [1 << 20, 3000])
def test_leaks(spark, hard_texts, chunk, monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    draw = random.Random(4)
    items = [prose(draw, draw.randint(12, 40), 10**6) for _ in range(20)] + ["tiny", "Ab", None, " \n", "exactly8", "x" * 90]
    texts, expected = list(hard_texts), {(9, 25, 0)}
    for i in range(20):
        before, after = prose(draw, draw.randint(0, 900), 10**6), prose(draw, 30, 10**6)
        edits = i % 3 * len(items[i]) // 25
        texts.append(f"{before}\n{edited(draw, items[i].replace(' ', '  ').upper() if i % 2 else items[i], edits)} {after}")
        expected.add((len(texts) - 1, i, None))
    texts += ["a TINY\nthing", "tin y", "has ab in", edited(draw, items[0], len(items[0]) // 4)]
    expected |= {(len(texts) - 4, 20, 0), (len(texts) - 2, 21, 0)}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = find_leaks(doc_frame(spark, texts), bench, most_chars=1500).collect()
    pairs = {(r.doc_id, r.item_id) for r in rows if r.item_id != 21}
    assert pairs == {(d, i) for d, i, _ in expected if i != 21}
    assert {r.doc_id for r in rows if r.item_id == 21} == {
        d for d, t in enumerate(texts) if "ab" in " ".join((t or "").translate(FOLD).split())
    }
    flat = lambda t: " ".join(t.translate(FOLD).split())
    for r in rows:
        found = flat(texts[r.doc_id][r.start : r.start + r.length])
        if not r.distance:
            assert found == flat(items[r.item_id])
        assert r.distance <= 0.1 * len(flat(items[r.item_id])) + 1e-9
    clean = without_leaks(doc_frame(spark, texts), bench, most_chars=1500)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {r.doc_id for r in rows}
    assert clean.columns == doc_frame(spark, []).columns


def closest(item, text):
    """Fewest edits between an item and any stretch of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("rate", [0.1, 0.25, 0.4])
def test_short_items_have_their_whole_budget(spark, rate, monkeypatch):
    monkeypatch.setattr(decontamination, "HITS", 50)
    draw = random.Random(int(rate * 100))
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    items = ["".join(draw.choice(letters) for _ in range(n)) for n in range(1, 41)]
    texts = []
    for item in items:
        for _ in range(3):
            around = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(2)]
            texts.append(around[0] + edited(draw, item, draw.randint(0, int(rate * len(item)) + 1)) + around[1])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r.distance for r in find_leaks(doc_frame(spark, texts), bench, rate=rate).collect()}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            least = closest(item, text)
            budget = min(int(rate * len(item) + 1e-9), len(item) - 1)
            assert rows.get((d, i)) == (least if least <= budget else None), (item, text)


def test_repetitive_texts_need_little_memory():
    import tracemalloc

    block = decontamination.Block()
    block.add(0, decontamination.normal("ab" * 500)[0])
    block.close(0.1)
    tracemalloc.start()
    (found,) = decontamination._text_matches(block, ["ab" * 300_000])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == (0, 0, 0, 0, 1000) and most < 400 << 20


def test_leaks_hard_tables(spark):
    bench = spark.createDataFrame([(None, "some benchmark passage of words")], "item_id long, text string")
    assert find_leaks(doc_frame(spark, []), bench).collect() == []
    assert find_leaks(doc_frame(spark, ["a"]), bench.where("false")).collect() == []
    assert without_leaks(doc_frame(spark, ["a", None]), bench.where("false")).count() == 2
    rows = spark.createDataFrame([(None, "some benchmark passage of words")] * 2, "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.distance) for r in find_leaks(rows, bench).collect()] == [(None, None, 0)] * 2


# --- quality ----------------------------------------------------------------------------


def rules_by_hand(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if counts[run] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules(spark, hard_texts):
    draw = random.Random(8)
    texts = corpus() + hard_texts + ["a b c d e " * 30, "a a a a a a a a a a a", "#x|y\n#x|y\n \n \n", "one two three four five six"]
    texts += [" ".join(f"junk{draw.randrange(30)}***" for _ in range(80)) for _ in range(15)]
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(None,)], "doc_id long")
    rows = judge(doc_frame(spark, texts), trusted, buckets=1 << 15).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = rules_by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert r.kept == (not r.base_failed and r.ratio >= -0.05)
    assert not any(r.kept for r in rows if r.doc_id >= len(texts) - 15)
    assert sum(r.kept for r in rows if r.doc_id < 60 and not r.base_failed) > 40


def test_rules_hard_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert judge(doc_frame(spark, []), none).collect() == []
    rows = spark.createDataFrame([(None, None), (None, "a b c d e f g h i j"), (1, "a"), (1, "a")], "doc_id long, text string")
    found = judge(rows, none, buckets=16).collect()
    assert sorted((r.n_words, r.base_failed, r.kept) for r in found) == [
        (0, True, False), (1, True, False), (1, True, False), (10, False, True)
    ]


def test_quality_model(spark, hard_texts):
    draw = random.Random(9)
    texts = [prose(draw, 60) if i % 3 else " ".join(f"J{draw.randrange(99)}!!" for _ in range(40)) for i in range(300)]
    docs = doc_frame(spark, texts + hard_texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(1, None), (None, 1)], "doc_id long, y int")
    found = features(docs)
    model = fit(found, labels, waves=64)
    scores = {r.doc_id: r.score for r in score_features(found, model).collect()}
    assert len(scores) == len(texts) + len(hard_texts) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[i] > 0.5) == (i % 3 > 0) for i in range(200, 300))
    kept = {r.doc_id for r in keep_good(docs, model, 0.5).collect()}
    assert kept == {d for d, s in scores.items() if s >= 0.5}
    empty = fit(found, labels.where("false"), waves=8)
    assert {r.score for r in score_features(found, empty).collect()} == {0.5}
    assert score_features(features(doc_frame(spark, [])), model).collect() == []


def test_isotonic():
    values = isotonic(np.array([1.0, 3.0, 2.0, 2.0, 5.0, 4.0]), np.array([1.0, 1.0, 1.0, 2.0, 1.0, 3.0]))
    assert np.allclose(values, [1, 2.25, 2.25, 2.25, 4.25, 4.25])


# --- language model ---------------------------------------------------------------------


def test_gradients_are_the_slopes():
    draw = np.random.default_rng(3)
    weights = attention_model.Weights.fresh(9)
    x, y = attention_model.windows(draw.integers(0, 9, 70).astype(np.int32), 9)
    x, y = np.array(x), np.array(y)
    grads = attention_model.gradients(weights, x, y)

    def loss():
        return -attention_model.log_chances(weights, x, y).sum() / (y >= 0).sum()

    for name, array in weights.arrays.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), array.shape)
        old = array[at]
        array[at] = old + 5e-3
        up = loss()
        array[at] = old - 5e-3
        down = loss()
        array[at] = old
        assert (up - down) / 1e-2 == pytest.approx(float(grads[name][at]), rel=0.1, abs=1e-3)


def test_chances_sum_to_one_and_see_no_later_token():
    weights = attention_model.Weights.fresh(5)
    seq = np.array([1, 4, 2, 0] * 20, np.int32)
    x, y = attention_model.windows(seq, 5)
    total = np.zeros(y.shape)
    for k in range(5):
        total += np.exp(attention_model.log_chances(weights, x, np.where(y >= 0, k, -1)))
    assert np.allclose(total[y >= 0], 1, atol=1e-5)
    other = seq.copy()
    other[60:] = 3
    x2, y2 = attention_model.windows(other, 5)
    a, b = (attention_model.log_chances(weights, *w).ravel()[:60] for w in ((x, y), (x2, y2)))
    assert np.allclose(a, b, atol=1e-6) and (y >= 0).sum() == len(seq)


def _emission(draw, size, number):
    """An emission of drawn pair counts, made by hand: p(class | before) and p(id | class, before)."""
    classes = np.append(np.arange(number), draw.integers(0, number, size - number)).astype(np.int32)
    n = draw.integers(0, 4, (size + 1, size))
    of = np.append(classes, number)
    by_class = np.zeros((number + 1, size))
    np.add.at(by_class, of, n)
    alone = by_class.sum(0) + 0.1
    mass = np.array([alone[classes == c].sum() for c in range(number)])
    under, prior, after = np.zeros((number + 1, size)), np.zeros((size + 1, number)), np.zeros((size + 1, size))
    follow = np.zeros((number + 1, number))
    for b in range(number + 1):
        for c in range(number):
            mine = classes == c
            under[b, mine] = (by_class[b, mine] + 20 * alone[mine] / mass[c]) / (by_class[b, mine].sum() + 20)
            follow[b, c] = (by_class[b, mine].sum() + mass[c] / mass.sum()) / (by_class[b].sum() + 1)
    for b in range(size + 1):
        met = 0
        for c in range(number):
            mine = classes == c
            total, kinds = n[b, mine].sum(), (n[b, mine] > 0).sum()
            met += total > 0
            after[b, mine] = under[of[b], mine]
            if total:
                after[b, mine] = (np.where(n[b, mine] > 0, n[b, mine] - 0.75, 0) + 0.75 * kinds * under[of[b], mine]) / total
        for c in range(number):
            total = n[b, classes == c].sum()
            prior[b, c] = (max(total - 0.75, 0) + 0.75 * met * follow[of[b], c]) / n[b].sum() if n[b].sum() else follow[of[b], c]
    return classes, n, prior, after


def test_emission_by_hand(spark):
    size, number = 40, 6
    classes, n, prior, after = _emission(np.random.default_rng(4), size, number)
    rows = [(lm_scoring.PAIRS, int(b * size + i), int(n[b, i])) for b, i in zip(*np.nonzero(n), strict=True)]
    counts = spark.createDataFrame(rows, "kind int, key long, n long")
    found = lm_scoring._pair_counts(counts, classes, size, 10**6).emission()
    assert np.allclose(np.exp(found.prior), prior, rtol=1e-4) and np.allclose(prior.sum(1), 1)
    for b in range(size):
        got = [found.log_chances(np.array([b, i]))[1] for i in range(size)]
        assert np.allclose(np.exp(got), after[b], rtol=1e-4)
        assert np.allclose(np.bincount(classes, weights=np.exp(got)), 1, rtol=1e-4)
    # Without pairs of their own, ids follow the class before; chances still add up.
    few = lm_scoring._pair_counts(counts, classes, size, 0).emission()
    got = np.exp([few.log_chances(np.array([3, i]))[1] for i in range(size)])
    assert len(few.pairs) == 0 and np.allclose(np.bincount(classes, weights=got), 1, rtol=1e-4)
    assert np.allclose(np.exp(few.prior).sum(1), 1, rtol=1e-4)


def test_pairs_beyond_the_bound_by_hand(spark):
    size, number = 40, 6
    classes, n, prior, after = _emission(np.random.default_rng(4), size, number)
    rows = [(lm_scoring.PAIRS, int(b * size + i), int(n[b, i])) for b, i in zip(*np.nonzero(n), strict=True)]
    counts = spark.createDataFrame(rows, "kind int, key long, n long")
    for most in (0, len(rows) * 3 // 4):
        few = lm_scoring._pair_counts(counts, classes, size, most).emission()
        assert np.allclose(np.exp(few.prior), prior, rtol=1e-4) and len(few.pairs) <= most < len(rows)
        assert (len(few.pairs) > 0) == (most > 0)
        for b, i in np.ndindex(size, size):
            chances, keys, left, unit = few.parted(np.array([b, i]))
            got = chances[1]
            if b * size + i in keys:
                at = keys.tolist().index(b * size + i)
                got += np.log(left[at]) + (np.log(1 + (n[b, i] - 0.75) / unit[at]) if n[b, i] else 0)
            assert got == pytest.approx(np.log(after[b, i]), rel=1e-4)


@pytest.mark.parametrize("most", [0, 150])
def test_scores_do_not_depend_on_the_pairs_sent(spark, most):
    draw = random.Random(13)
    texts = [None, "", *(prose(draw, draw.randint(1, 90), 40) for _ in range(60))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    held = F.col("doc_id") % 4 == 1
    key = lambda r: (str(r.doc_id), r.n_tokens)
    whole = sorted(score_texts(docs, held, WORDS).collect(), key=key)
    part = sorted(score_texts(docs, held, WORDS, most_pairs=most).collect(), key=key)
    assert len(part) == len(whole) == len(rows)
    for a, b in zip(whole, part, strict=True):
        assert a[:6] == b[:6] and b.score == pytest.approx(a.score, rel=1e-5)


def test_tables_sent_to_tasks_are_small_and_come_back_whole(spark):
    size, number = 5000, 100
    classes = np.arange(size, dtype=np.int32) % number
    rows = [(lm_scoring.PAIRS, b * size + i, b + i) for b in range(1, 40) for i in range(20)]
    counts = spark.createDataFrame(rows, "kind int, key long, n long")
    for most in (0, 10**6):
        sent = lm_scoring._pair_counts(counts, classes, size, most).emission()
        raw = pickle.dumps(sent)
        back = pickle.loads(raw)
        assert len(raw) < 1_000_000 < sent.prior.nbytes
        for name, values in vars(sent).items():
            got = vars(back)[name]
            assert got.dtype == values.dtype and np.array_equal(got, values)


def _chance_by_hand(w, classes, prior, ids, at):
    """Chances of classes at one place of a text, from the classes before it in its window."""
    first = at // attention_model.STRIDE * attention_model.STRIDE - attention_model.OVERLAP
    seen = [(j - first, len(w["embed"]) - 1 if j == 0 else classes[ids[j - 1]]) for j in range(max(0, first), at + 1)]
    e = [w["embed"][c] + w["place"][place] for place, c in seen]
    q = e[-1] @ w["query"] / math.sqrt(attention_model.WIDTH)
    weight = np.exp([q @ (own @ w["key"]) for own in e])
    z = e[-1] + (weight / weight.sum()) @ np.array([own @ w["value"] for own in e]) @ w["mix"]
    u = z + np.maximum(z @ w["up"] + w["up_bias"], 0) @ w["down"]
    g = np.exp(u @ w["out"] + w["out_bias"] + np.log(prior[ids[at - 1] if at else len(classes)]))
    return g / g.sum()


def test_scores_by_hand(spark):
    size, number = 40, 6
    draw = np.random.default_rng(5)
    classes, n, prior, after = _emission(draw, size, number)
    rows = [(lm_scoring.PAIRS, int(b * size + i), int(n[b, i])) for b, i in zip(*np.nonzero(n), strict=True)]
    counts = spark.createDataFrame(rows, "kind int, key long, n long")
    emission = lm_scoring._pair_counts(counts, classes, size, 10**6).emission()
    weights = attention_model.Weights.fresh(number)
    w = {k: a.astype(np.float64) for k, a in weights.arrays.items()}
    texts = [draw.integers(0, size, k) for k in (1, 2, 31, 32, 33, 100, 250)]
    want = []
    for ids in texts:
        chances = [_chance_by_hand(w, classes, prior, ids, i)[classes[x]] for i, x in enumerate(ids)]
        emitted = [after[ids[i - 1] if i else size, x] for i, x in enumerate(ids)]
        want.append(np.log10(chances).sum() + np.log10(emitted).sum())
    assert np.allclose(lm_scoring._log10_texts(texts, weights, emission), want, rtol=1e-4)


def test_held_out_order_scores_above_the_base(spark):
    # Each word has three successors; the same words in drawn order have the same base.
    draw = random.Random(12)
    words = "the of and to in is you that it he was for on are as with his they at be this have from or one".split()
    after = {w: draw.sample(words, 3) for w in words}
    texts = []
    for i in range(400):
        own = [draw.choice(words)]
        while len(own) < 80:
            own.append(draw.choice(after[own[-1]]))
        texts.append(" ".join(own))
        if i % 5 == 0:
            texts.append(" ".join(draw.sample(texts[-1].split(), 80)))
    held = F.col("doc_id") % 6 < 2
    rows = {r.doc_id: r for r in score_texts(doc_frame(spark, texts), held, WORDS).where("held_out").collect()}
    assert len(rows) == 160
    for i in range(0, 480, 6):
        assert rows[i].score > rows[i].base_score and rows[i].score > rows[i + 1].score
        assert rows[i].base_score == pytest.approx(rows[i + 1].base_score)


def test_scores(spark, hard_texts):
    draw = random.Random(6)
    texts = hard_texts + [prose(draw, draw.randint(1, 90), 40) for _ in range(150)] + ["unseen zzz zzz"]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    docs = doc_frame(spark, texts).repartition(4)
    rows = score_texts(docs, held, WORDS, most_frequent=20).collect()
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    tokens = [WORD.findall((t or "").translate(FOLD)) + ["\n"] for t in texts]
    counts = Counter(w for own, o in zip(tokens, out) if not o for w in own)
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        known = sum(counts[w] > 0 for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(own), known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0 and math.isfinite(r.score)


def test_windows_keep_their_context():
    x, y = attention_model.windows(np.arange(200, dtype=np.int32), 200)
    before = {}
    for own, targets in zip(x, y, strict=True):
        for j, target in enumerate(targets):
            # The start of the text counts as one.
            before[target] = int((own[: attention_model.OVERLAP + j + 1] >= 0).sum())
    inside = [n for target, n in before.items() if target >= 48]
    assert (min(inside), max(inside)) == (17, 48) and before[0] == 1 and before[20] == 21


def test_rounds_make_only_their_own_windows():
    draw = np.random.default_rng(2)
    for size in (1, 16, 31, 32, 33, 64, 500):
        ids = draw.integers(0, 90, size)
        x, y = attention_model.windows(ids, 90)
        seen = 0
        for first in range(5):
            parts = list(attention_model.text_windows(ids, 90, first, 5, 2))
            assert all(0 < len(own) <= 2 for own in parts)
            own = np.concatenate([np.empty((0, x.shape[1] + 1), int), *parts])
            assert np.array_equal(own[:, :-1], x[first::5])
            assert np.array_equal(own[:, attention_model.OVERLAP + 1 :], y[first::5])
            seen += len(own)
        assert seen == len(x) and np.array_equal(y[y >= 0], ids)


def test_scoring_projects_each_class_and_place_once(monkeypatch):
    draw = np.random.default_rng(6)
    weights = attention_model.Weights.fresh(9)
    ids = [draw.integers(0, 9, k).astype(np.int32) for k in (1, 20, 33, 700, 5000)]
    x, y = (np.concatenate(part) for part in zip(*(attention_model.windows(own, 9) for own in ids), strict=True))
    few = np.concatenate([attention_model.log_chances(weights, x[i : i + 8], y[i : i + 8]) for i in range(0, len(x), 8)])
    made, projected = [], attention_model._projected
    monkeypatch.setattr(attention_model, "_projected", lambda w, x, room: made.append(len(x)) or projected(w, x, room))
    many = attention_model.log_chances(weights, x, y)
    # One window per class and the start instead of all, and the same chances to the last bit.
    assert len(x) > 150 and made == [10] and np.array_equal(many, few)


@pytest.mark.parametrize("most", [0, 300, 10**6])
def test_pairs_of_several_texts_are_looked_up_together(spark, monkeypatch, most):
    size, number = 40, 6
    draw = np.random.default_rng(7)
    classes, n, _, _ = _emission(draw, size, number)
    rows = [(lm_scoring.PAIRS, int(b * size + i), int(n[b, i])) for b, i in zip(*np.nonzero(n), strict=True)]
    counts = spark.createDataFrame(rows, "kind int, key long, n long")
    emission = lm_scoring._pair_counts(counts, classes, size, most).emission()
    weights = attention_model.Weights.fresh(number)
    texts = [draw.integers(0, size, k) for k in (1, 2, 31, 1, 100, 250, 7)]
    alone, apart = [], []
    for own in texts:
        alone += lm_scoring._log10_texts([own], weights, emission, apart).tolist()
    asked, parted = [], lm_scoring.Emission.parted_texts
    monkeypatch.setattr(lm_scoring.Emission, "parted_texts", lambda e, i, first: asked.append(len(i)) or parted(e, i, first))
    monkeypatch.setattr(lm_scoring, "LOOKED_UP", 100)
    beyond = []
    found = lm_scoring._log10_texts(texts, weights, emission, beyond)
    assert asked == [135, 250, 7] and found.tolist() == pytest.approx(alone, rel=1e-12)
    assert any(len(keys) for keys, _ in beyond) == (most < len(rows)) and len(beyond) == len(texts)
    for got, want in zip(beyond, apart, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_model_trains_on_all_texts(spark, monkeypatch):
    draw = random.Random(8)
    docs = doc_frame(spark, [prose(draw, 30) for _ in range(300)])
    seen, average = [], lm_scoring.average
    monkeypatch.setattr(lm_scoring, "average", lambda parts: seen.append(sum(n for n, _ in parts)) or average(parts))
    held = F.col("doc_id") % 3 == 2
    score_texts(docs, held, WORDS)
    texts = [r.text for r in docs.where(~held).collect()]
    ids = lm_scoring._ids(WORDS, 49_407, texts)
    # Every window once, in one of the rounds.
    assert sum(seen) == sum(-(-len(i) // attention_model.STRIDE) for i in ids) and len(seen) == len(lm_scoring.RATES)


def test_classes_come_from_all_training_ids(spark, monkeypatch):
    draw = random.Random(9)
    texts = ["long " * 3000, None, *(prose(draw, draw.randint(1, 6)) for _ in range(4300))]
    docs = doc_frame(spark, texts).repartition(3)
    given, assign = [], lm_scoring.assign_classes
    monkeypatch.setattr(lm_scoring, "assign_classes", lambda *a: given.append(a) or assign(*a))
    score_texts(docs, F.lit(False), WORDS)
    counts, table = given[0]
    ids = list(lm_scoring._ids(WORDS, 49_407, [t or "" for t in texts]))
    assert np.array_equal(counts, np.bincount(np.concatenate(ids), minlength=49_408))
    anchor = attention_model.frequent_ids(counts)
    hand = Counter()
    for own in ids:
        for i, x in enumerate(own):
            for j in range(max(0, i - 8), min(len(own), i + 9)):
                if i != j:
                    hand[x, {-1: 0, 1: 1}.get(j - i, 2), anchor[own[j]]] += 1
    assert {k: table[k] for k in hand} == hand and table.sum() == hand.total()
    monkeypatch.setattr(attention_model, "LOT", 1000)
    lots = np.zeros(table.size, np.int64)
    attention_model.count_neighbours(ids, anchor, lots)
    assert np.array_equal(lots, table.ravel())


def test_scores_hard_tables(spark):
    assert score_texts(doc_frame(spark, []), F.lit(False), WORDS).collect() == []
    rows = spark.createDataFrame([(None, "a b"), (1, "c c"), (1, "c c"), (1, None)], "doc_id long, text string")
    found = score_texts(rows, F.col("doc_id") == 5, WORDS, most_frequent=0).collect()
    assert sorted((r.n_tokens, r.n_known) for r in found) == [(1, 1), (3, 3), (3, 3), (3, 3)]
    none = score_texts(rows, F.lit(True), WORDS).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)}
