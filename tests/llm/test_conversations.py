"""Repair of conversations against a plain search, chunks and fix-up passes of any size, hard cases."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidegate.llm import conversations
from tidegate.llm.common import Scratch
from tidegate.llm.conversations import (
    END,
    Steps,
    converged,
    damaged,
    conversation_report,
    digests,
    normal,
    repair_conversations,
)

BLANKS = " \t\n\x0b\x0c\r"
SOUND = re.compile(r"(s?(ua)+)?")


def search(rows):
    """Cheapest, then least edits of rows (initial, must_go, truncated) by a search over whole edit strings."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and SOUND.fullmatch(roles):
            return cost, audit
        # What may follow depends on the last role and on whether any role was given.
        if (i, roles[-1:]) in seen:
            continue
        seen.add((i, roles[-1:]))
        steps = [(5, "I", 0, r) for r in "ua"]
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            steps.append((2, "D", 1, ""))
            if not must_go:
                steps += [(1 + 5 * truncated, "R", 1, r) for r in "ua"]
                if initial:
                    steps.append((5 * truncated, "K", 1, initial))
        for paid, letter, used, role in steps:
            if role and not re.fullmatch(r"s?(ua)*u?", roles + role):
                continue
            heapq.heappush(heap, (cost + paid, audit + letter, i + used, roles + role))
    raise AssertionError


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        role = "user" if way == 4 else role
        out += [(conv, turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def report_by_hand(rows, damage=damage_by_hand):
    """conv_id to the row of the result."""
    left, out = damage(rows), {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in left if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in mine:
            bare = text.rstrip(BLANKS)
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = search([(i, f in ("b", "d"), f == "t") for i, f in zip(initials, faults, strict=True)])
        lines, state, i = [], "", 0
        for letter in audit:
            forced = "assistant" if state == "u" else "user"
            if letter == "K":
                lines.append(f"{mine[i][1]}:{mine[i][2]}")
                state = mine[i][1][0]
            elif letter == "R":
                lines.append(f"{forced}:{mine[i][2]}")
                state = forced[0]
            elif letter == "I":
                lines.append(f"{forced}:")
                state = forced[0]
            i += letter != "I"
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def report(rows, left=None):
    pieces = repair_conversations(damaged(rows) if left is None else left).cache()
    found = conversation_report(rows, pieces).join(digests(pieces), "conv", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return {
        r["conv_id"]: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha256 or nothing)
        for r in found.collect()
    }


ROLES = ["user", "user", "assistant", "assistant", "system", "tool", "", "admin", None]
TEXTS = ["Yes.", "no", "So? \t", "", " \n", "x!", None, "Well.\nthen", "é日.", "hm"]


def sample(convs=40, longest=14, seed=1):
    draw = random.Random(seed)
    out = []
    for conv in range(convs):
        for turn in range(draw.randint(1, longest)):
            turn = draw.choice([turn, turn, turn, turn * 2, 3, None])
            out.append((conv if conv else None, turn, draw.choice(ROLES), draw.choice(TEXTS) or draw.choice(TEXTS)))
    return out


def test_steps_against_a_search():
    draw, steps = random.Random(2), Steps()
    for _ in range(300):
        rows = [
            (draw.choice(["s", "u", "a", "t", ""]), draw.random() < 0.2, draw.random() < 0.2) for _ in range(draw.randint(0, 9))
        ]
        codes = bytes(
            (1 if gone else 3 if cut else 0) | (conversations.INITIALS.find(i) if i and i in "sua" else 3) << 2 for i, gone, cut in rows
        )
        edits, cost, state = steps.trace(codes, steps.back(codes, normal(END)), 0)
        tail, paid = conversations.ending(state)
        assert (cost + paid, "".join(edits) + tail) == search(rows)


@pytest.mark.parametrize("chunk", [1, 2, 5, 256])
def test_against_by_hand(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", chunk)
    rows = sample()
    assert report(frame(spark, rows).repartition(3)) == report_by_hand(rows)


def test_long_conversation_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_CHARS", 40)
    draw = random.Random(9)
    # A third of the rows in one conversation, and one that only repeats a row.
    rows = [(7, i // 2, draw.choice(ROLES[:6]), draw.choice(TEXTS[:3]) + draw.choice(["", str(i)])) for i in range(150)]
    rows += [(8, None, "user", "again.")] * 120 + [(9, 1, "assistant", "Fine.")]
    assert report(frame(spark, rows)) == report_by_hand(rows)


def test_vectors_pass_through_rows_that_must_go(spark, tmp_path):
    # Kept user row, many chunks of rows that must go, an assistant row: the first vector needs the last chunk's.
    user, gone, assistant = 1 << 2, 1 | 1 << 2, 2 << 2
    codes = [bytes([user]), *[bytes([gone] * 3)] * 9, bytes([assistant, user, assistant])]
    rows = [("=1", i // 4, i, bytearray(c)) for i, c in enumerate(codes)]
    marked = spark.createDataFrame(rows, "conv string, part int, place long, codes binary")
    found = {r.place: tuple(r.behind) for r in converged(marked, Scratch(spark, "test")).collect()}
    steps, vector = Steps(), normal(END)
    for _, _, place, c in reversed(rows):
        assert found[place] == vector
        vector = steps.back(bytes(c), vector)[0]


def test_fix_up_passes_carry_a_vector_through_chunks_without_convergence(spark, monkeypatch):
    steps = Steps()
    codes = [bytes([2 << 2]), *[bytes([1 | 2 << 2])] * 6, bytes([1 << 2, 2 << 2])]
    # With no chunk passed through, each pass moves a vector by one chunk, and the result is the same.
    monkeypatch.setattr(conversations, "all", lambda _: False, raising=False)
    marked = spark.createDataFrame(
        [("=1", 0, i, bytearray(c)) for i, c in enumerate(codes)], "conv string, part int, place long, codes binary"
    )
    found = {r.place: tuple(r.behind) for r in converged(marked, Scratch(spark, "test")).collect()}
    vector = normal(END)
    for i in range(len(codes) - 1, -1, -1):
        assert found[i] == vector
        vector = steps.back(codes[i], vector)[0]


def test_hard_cases(spark):
    long = "word. " * 60_000
    rows = [
        (None, None, None, None),
        (None, None, None, None),
        (1, 0, "user", long),
        (1, 1, "assistant", long + "end"),
        (2, 5, "system", "Only."),
        (3, 0, "user", " "),
        (4, 2**40, "user", "far."),
        (4, -(2**40), "assistant", "near."),
        (5, 0, "a:b", "c."),
        (5, 1, "a", "b:c."),
    ]
    docs = frame(spark, rows)
    for name in ("conv", "part", "place", "codes", "kind", "copy", "text_", "closed"):
        docs = docs.withColumn(name, F.lit("x"))
    assert report(docs) == report_by_hand(rows)
    assert report(docs, docs) == report_by_hand(rows, lambda r: [(a, b, c or " ", d or " ") for a, b, c, d in r])
    assert report(docs.limit(0)) == {}


def test_rows_of_one_turn_have_one_order_however_they_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 3)
    monkeypatch.setattr(conversations, "HEAD_CHARS", 4)
    rows = [(1, 5, "user", f"same start {i % 23}.") for i in range(120)]
    results = set()
    for partitions in (1, 3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        results.add(tuple(report(frame(spark, rows).repartition(partitions), frame(spark, rows)).items()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ((_, (gaps, blank, duplicate, truncated, illegal, cost, audit, _)),) = next(iter(results))
    assert len(results) == 1 and (gaps, blank, duplicate, truncated, illegal) == (0, 0, 97, 0, 119)
    assert len(audit.replace("I", "")) == 120 and cost > 0


def test_nothing_left_after_damage(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    assert report(frame(spark, [(3, turn, "user", "Gone.")])) == {
        3: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    }


def test_the_table(spark):
    from tidegate.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = QUERIES["op13_conversation_repair"](spark, sf)
    assert found.columns == ["conv_id", *names]
    assert {r.conv_id: tuple(r[n] for n in names) for r in found.collect()} == report_by_hand(rows)
