"""Rank-order profiles against a plain re-computation, and the hard cases."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.llm import language_id
from tidegate.llm.language_id import detect, gram_counts, gram_text, identify, learn_profiles, profile_table

from .conftest import doc_frame

STOCK = {
    "aa": ["the", "there", "then", "with", "Other", "thing"],
    "bb": ["und", "dunkel", "Straße", "über", "nicht", "schön"],
    "cc": ["για", "ένα", "και", "ΟΛΑ", "το"],
}


def sample(n=90, seed=3):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        lang = draw.choice(list(STOCK))
        words = [draw.choice(STOCK[lang] if draw.random() < 0.9 else STOCK["aa"]) for _ in range(draw.randint(1, 40))]
        out.append((i, draw.choice([" ", ", ", " 12-3 "]).join(words), lang))
    return out


def grams_by_hand(text):
    kept = []
    for c in text or "":
        kind = unicodedata.category(c)[0]
        small = c.lower()
        kept.append((small if kind == "L" and len(small) == 1 else c) if kind in "LM" else " ")
    words = "".join(kept).split(" ")
    out = Counter()
    if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
        return out
    for word in filter(None, words):
        padded = f" {word} "
        out.update(word)
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2) if len(word) > 1 or padded[i + 1] != " ")
    return out


def top(counts, ranks):
    # A shorter n-gram sorts ahead of its extensions, as text does.
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], [ord(c) for c in x[0]]))[:ranks]]


def by_hand(rows, learned, ranks):
    sums = {}
    for _, text, lang in learned:
        sums.setdefault(lang, Counter()).update(grams_by_hand(text))
    profiles = {lang: {g: i for i, g in enumerate(top(c, ranks))} for lang, c in sums.items() if c}
    out = {}
    for key, text, _ in rows:
        own = top(grams_by_hand(text), ranks)
        distances = sorted(
            (sum(abs(p[g] - i) if g in p else ranks for i, g in enumerate(own)), lang) for lang, p in profiles.items()
        )
        if not own or not distances:
            out[key] = ("und", 0.0)
            continue
        second = distances[1][0] if len(distances) > 1 else len(own) * ranks
        out[key] = (distances[0][1], (second - distances[0][0]) / second if second else 0.0)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def judged(df):
    return {r["doc_id"]: (r["lang_pred"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("text", ["", "a", "Ab c", "x" * 7, "é́a1b ²½", "  straße\n\tÀb'c ", "İi", "́a", "́ 1"])
def test_grams(text):
    grams, counts = gram_counts(text)
    assert list(grams) == sorted(grams)
    assert {gram_text(int(g)): int(n) for g, n in zip(grams, counts, strict=True)} == grams_by_hand(text)


def test_long_text_in_blocks(monkeypatch):
    text = "word1 straße über dunkel, " * 400
    whole = gram_counts(text)
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 97)
    parts = gram_counts(text)
    assert [list(x) for x in whole] == [list(x) for x in parts]
    assert {gram_text(int(g)): int(n) for g, n in zip(*whole, strict=True)} == grams_by_hand(text)


@pytest.mark.parametrize("ranks", [5, 30, 400])
def test_against_by_hand(spark, ranks):
    rows = sample()
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = frame(spark, rows)
    found = identify(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, ranks)
    assert judged(found) == by_hand(rows, learned, ranks)


def test_profiles_are_ranked_whole(spark, monkeypatch):
    # Sent on in small parts, over several partitions: the sums stay the same.
    rows = sample()
    docs = frame(spark, rows).repartition(3)
    whole = {(r.lang, r.gram): (r["rank"], r.n) for r in learn_profiles(docs, 50).collect()}
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 64)
    monkeypatch.setattr(language_id, "HELD", 10)
    assert {(r.lang, r.gram): (r["rank"], r.n) for r in learn_profiles(docs, 50).collect()} == whole
    texts = {(r.lang, r["rank"]): r.gram for r in profile_table(learn_profiles(docs, 50)).collect()}
    sums = Counter()
    for _, text, lang in rows:
        if lang == "bb":
            sums.update(grams_by_hand(text))
    assert [texts["bb", i] for i in range(20)] == top(sums, 20)


def test_more_languages_than_one_pass(spark, monkeypatch):
    rows = sample()
    rows += [(1000 + i, f"{'qwxyz'[i]}a {'qwxyz'[i]}b", f"l{i}") for i in range(5)]
    docs = frame(spark, rows)
    profiles = learn_profiles(docs, 40).cache()
    once = judged(detect(docs, profiles, 40))
    monkeypatch.setattr(language_id, "LANGUAGES_A_PASS", 3)
    assert judged(detect(docs, profiles, 40)) == once == by_hand(rows, rows, 40)


def test_ties_go_to_the_smaller_name(spark):
    docs = frame(spark, [(1, "same text", "b"), (2, "same text", "a"), (3, "same text", None)])
    assert judged(identify(docs, F.lit(True))) == {i: ("a", 0.0) for i in (1, 2, 3)}


def test_hard_cases(spark, hard_texts):
    docs = doc_frame(spark, hard_texts).withColumn("best", F.lit("x")).withColumn("score", F.lit("old"))
    docs = docs.unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    found = identify(docs, F.lit(True))
    assert set(found.columns) == {*docs.columns, "lang_pred"}
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(hard_texts) + 1
    assert [rows[i]["lang_pred"] for i in range(4)] == ["und"] * 4
    assert {rows[i]["lang_pred"] for i in range(4, 10)} == {"en"} == {rows[None]["lang_pred"]}
    assert all(0 <= r["score"] <= 1 and r["best"] == "x" for r in rows.values())
    assert rows[7]["text"] == hard_texts[7]


def test_nothing_learned_and_nothing_given(spark):
    docs = frame(spark, [(1, "text", None), (2, "more", None)])
    assert judged(identify(docs, F.lit(True))) == {1: ("und", 0.0), 2: ("und", 0.0)}
    assert identify(docs.limit(0), F.lit(True)).collect() == []
    # Letterless text in a language teaches nothing.
    only = frame(spark, [(1, "12 34", "aa"), (2, "text", None)])
    assert judged(identify(only, F.lit(True)))[2] == ("und", 0.0)


def test_held_out_documents_of_the_table(spark):
    from tidegate.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    found = QUERIES["op11_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = found.where("held_out and lang is not null").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
