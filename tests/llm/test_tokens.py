"""Packing and token files against the library itself."""

from __future__ import annotations

import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegate.llm import tokens
from tidegate.llm.packing import closest_fill, pack, plan_windows
from tidegate.llm.token_files import open_part, read_token_files, write_token_files
from tidegate.session import fresh_dir

from .conftest import doc_frame

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("path", "kind"), [(BYTES, "byte_level"), (WORDS, "spaced")])
@pytest.mark.parametrize("block", [1 << 20, 64])
def test_ids_equal_the_library(path, kind, block, hard_texts, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", block)
    draw = random.Random(7)
    parts = ["a", "b", " ", "\n", "é", "'s", "1", " ", "\t", "。", " ", "　", "😀", "<|endoftext|>"]
    parts += ["<|EndOfText|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "|>", "A", "Z<", "|endoftext|>"]
    texts = hard_texts + ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(800)]
    found = [ids.tolist() for ids in tokens.Encoder(path, kind).encode(texts)]
    library = Tokenizer.from_file(path)
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_folding_leaves_special_tokens_alone():
    cases = [b"", b"Ab C", b"A<|B|>C D", b"X\nY<|Z", b"<|A <|B\n<|C D", b"A B<| C", b"A<|B<|C D<|", "É<|É B".encode()]
    for case in cases:
        words = case.replace(b"\n", b" ").split(b" ")
        expected = b" ".join(w if b"<|" in w else w.lower() for w in words)
        assert tokens.folded(case).replace(b"\n", b" ") == expected


def test_closest_fill_is_the_best():
    draw = random.Random(3)
    for _ in range(60):
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(4)}
        capacity = draw.randint(1, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= capacity}
        chosen = closest_fill(counts, capacity)
        assert sum(n * c for n, c in chosen.items()) == max(sums)
        assert all(c <= counts[n] for n, c in chosen.items())


def test_plan_uses_every_remainder_once():
    histogram = {n: (n * 7) % 5 for n in range(1, 64)} | {40: 3000}
    plan = plan_windows(histogram, 64)
    for n, count in histogram.items():
        assert 0 <= plan.whole.get(n, 0) <= count
    whole = sum(n * c for n, c in plan.whole.items())
    assert plan.windows * 64 >= whole
    assert whole + plan.run_tokens == sum(n * c for n, c in histogram.items())


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pieces_hold_every_id_once(spark, hard_texts, capacity):
    texts = hard_texts + ["hot hot hot hot hot"] * 70
    docs = doc_frame(spark, texts)
    pieces = sorted(pack(docs.repartition(5), BYTES, capacity=capacity).collect(), key=lambda r: (r.doc_id, r.start))
    library = Tokenizer.from_file(BYTES)
    ids = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    at = dict.fromkeys(range(len(texts)), 0)
    sequences = {}
    for r in pieces:
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id] += r.length
        assert crc(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {i: len(x) for i, x in enumerate(ids)}
    assert sorted(sequences) == list(range(len(sequences)))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity and (end == capacity or not end & (end - 1))


def test_empty_and_null_tables(spark):
    empty = doc_frame(spark, [])
    assert pack(empty, BYTES).collect() == []
    folder = fresh_dir(spark, "files")
    write_token_files(empty, folder, WORDS)
    assert read_token_files(spark, folder).collect() == []
    nulls = spark.createDataFrame([(None, "a b"), (None, None), (3, "a b"), (3, "a b")], "doc_id long, text string")
    first = [(r.doc_id is None, r.doc_tokens) for r in pack(nulls, BYTES).collect() if r.start == 0]
    assert sorted(first) == [(False, 3), (False, 3), (True, 1), (True, 3)]
    folder = fresh_dir(spark, "files")
    write_token_files(nulls, folder, WORDS)
    rows = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 1), (None, 1, 3), (3, 4, 3), (3, 7, 3)]


@pytest.mark.parametrize("width", [2, 4])
def test_files_round_trip(spark, hard_texts, width):
    folder = fresh_dir(spark, "files")
    docs = doc_frame(spark, hard_texts).repartition(4)
    manifest = write_token_files(docs, folder, WORDS, end_id=2, width=width)
    library = Tokenizer.from_file(WORDS)
    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in hard_texts]
    rows = sorted(read_token_files(spark, folder, width).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, own in zip(rows, ids, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), crc(own))
        start += len(own)
    flat = [i for m in sorted(manifest.collect()) for i in open_part(folder, m.part, width)[0].tolist()]
    assert flat == [i for own in ids for i in own]
