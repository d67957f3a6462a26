"""Divergence of sources against the whole matrix by hand, runs and merges in small parts, hard cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.llm import divergence
from tidegate.llm.divergence import Block, audit_sources, merged, segments, share

from .conftest import doc_frame

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def terms_by_hand(text):
    return [w.translate(FOLD) for w in TERM.findall(text or "")]


def by_hand(rows, min_docs, top=10):
    """Rows (lang, source, text) to the set of result rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        mine = [(s, terms_by_hand(t)) for k, s, t in rows if k == lang]
        docs = Counter(w for _, words in mine for w in set(words))
        kept = [w for w, n in docs.items() if n >= min_docs]
        counts = {s: Counter() for s, _ in mine}
        for s, words in mine:
            counts[s].update(w for w in words if docs[w] >= min_docs)
        whole = sum(counts.values(), Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        key = lambda x: (-x[1], x[0].encode())
        for s in counts:
            pairs = [(o, sum(f(p(counts[s], w), p(counts[o], w)) for w in kept)) for o in counts if o != s]
            out |= {(lang, s, "pair", i, v, r) for r, (i, v) in enumerate(sorted(pairs, key=key), 1)}
            own = [(w, p(counts[s], w), p(whole, w)) for w in kept if counts[s][w]]
            best = sorted([(w, f(a, b)) for w, a, b in own if a > b], key=key)[:top]
            out |= {(lang, s, "term", i, v, r) for r, (i, v) in enumerate(best, 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def result(df):
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(n=150, sources=6, seed=4):
    draw = random.Random(seed)
    stock = [f"{a}{b}" for a in ("Wort", "ñu", "zé", "a", "B") for b in ("x", "yy", "É", "日本", "q")]
    out = []
    for _ in range(n):
        lang = draw.choice(["en", "en", "de", None])
        source = draw.choice([f"s{draw.randrange(sources)}", "s0", "s0", None])
        words = [stock[min(draw.randrange(25), draw.randrange(25))] for _ in range(draw.randint(0, 30))]
        out.append((lang, source, draw.choice([" ", "1", "-\n", "_@"]).join(words)))
    return out


@pytest.mark.parametrize("min_docs", [1, 4, 10, 40, 10_000])
def test_against_the_whole_matrix(spark, min_docs):
    rows = sample()
    assert result(audit_sources(frame(spark, rows), min_docs)) == by_hand(rows, min_docs)


def test_blocks_runs_and_rows_of_any_size(spark, monkeypatch):
    rows = sample()
    for name, size in {"BLOCK_POSTINGS": 7, "BLOCK_DOCS": 3, "ROW_POSTINGS": 2, "TEXT_BYTES": 5, "HELD_PAIRS": 3, "SALTS": 2}.items():
        monkeypatch.setattr(divergence, name, size)
    got = audit_sources(frame(spark, rows).repartition(5), 3, top=4, shards=3)
    assert result(got) == by_hand(rows, 3, top=4)


def test_one_source_holds_most_and_terms_of_many_sources(spark):
    # Every source holds the common term; rows of one term cross the batches of a task.
    rows = [("en", f"s{i}", f"common own{i % 7} " * (1 + i % 3)) for i in range(60)]
    rows += [("en", "hot", "common rare")] * 200
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = result(audit_sources(frame(spark, rows), 3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == by_hand(rows, 3)


def test_runs_are_sorted_and_merge_into_sums(monkeypatch):
    monkeypatch.setattr(divergence, "ROW_POSTINGS", 3)
    rows, sums, docs = sample(), {}, Counter()
    runs = []
    for begin in range(0, len(rows), 20):
        block = Block()
        for lang, source, text in rows[begin : begin + 20]:
            block.add(lang or "", source or "", text)
            for w in terms_by_hand(text):
                sums.setdefault((lang or "", w), Counter())[source or ""] += 1
            docs.update((lang or "", w) for w in set(terms_by_hand(text)))
        run = [tuple(r.values()) for r in block.run(4).to_pylist()]
        for _, first, terms, ends, sources, counts in run:
            assert terms == sorted(terms) and terms[0] == first
            assert len(ends) == len(terms) and ends[-1] == len(sources) == len(counts) <= 3
        runs += run
    assert Block().run(4) is None
    runs.sort(key=lambda r: r[:2])
    low = (1 << divergence.COUNT_BITS) - 1
    found = {}
    for name, postings in merged(iter(runs)):
        lang, term = name.decode().split("\0")
        n_docs = sum(postings.values()) >> divergence.COUNT_BITS
        found[lang, term] = (n_docs, Counter({s: n & low for s, n in postings.items()}))
    assert found == {k: (docs[k], c) for k, c in sums.items()}


@pytest.mark.parametrize("size", [1, 4, 1 << 20])
def test_terms_of_a_text(monkeypatch, size):
    monkeypatch.setattr(divergence, "TEXT_BYTES", size)
    text = "Ab@c[É ñ`日{本}z\x7f\x00Q\n\tİ ½a"
    assert [t.decode() for part in segments(text) for t in part.split()] == terms_by_hand(text)


def test_shares_are_exact_beyond_64_bits(spark):
    n, size, terms = 10**13 + 7, 3 * 10**13 + 1, 12345
    frame_ = spark.createDataFrame([(n, size, terms)], "n long, size long, terms long")
    assert frame_.select(share("n", "size", "terms").alias("p")).first()["p"] == 1 + 10**9 * (n + 2) // (size + 2 * terms)


def test_hard_cases(spark, hard_texts):
    docs = doc_frame(spark, hard_texts * 2).withColumn("shard", F.lit("x")).withColumn("first", F.lit(1))
    rows = [("en", "", t) for t in hard_texts * 2] + [("", "b", "lone"), ("", "c", None)]
    docs = docs.unionByName(
        docs.where("doc_id < 2").select(
            F.lit(None).cast("long").alias("doc_id"),
            F.when(F.col("doc_id") == 0, "lone").alias("text"),
            F.lit(None).cast("string").alias("lang"),
            F.when(F.col("doc_id") == 0, "b").otherwise("c").alias("source"),
            *[c for c in docs.columns if c not in ("doc_id", "text", "lang", "source")],
        )
    )
    assert result(audit_sources(docs, 2)) == by_hand(rows, 2)
    assert audit_sources(docs.limit(0), 2).collect() == []
