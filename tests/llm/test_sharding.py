"""Shards: the law, movement, slots."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidegate.llm.sharding import HashTree, Leaf, assign_shards, with_shard

from .conftest import doc_frame


def test_slots_sizes_and_checksums(spark, hard_texts):
    tree = HashTree.regular(6, 2, 2)
    texts = hard_texts * 30
    rows = assign_shards(doc_frame(spark, texts).repartition(3), tree, tree.grow(1, 0)).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 6)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(6))


def test_growth_moves_a_fair_share_and_only_inwards(spark):
    tree = HashTree.regular(40)
    two = tree.grow(0, 0).grow(3, 1)
    rows = with_shard(spark.range(40_000).withColumnRenamed("id", "doc_id"), "doc_id", tree.grow(0, 0), "a")
    rows = with_shard(rows, "doc_id", two, "b").groupBy("a", "b").count().collect()
    assert all(r.a == r.b or r.b == 41 for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.b] += r["count"]
    assert all(800 < n < 1150 for n in sizes.values()) and len(sizes) == 42


def test_weight_change_stays_in_its_subtree(spark):
    before = HashTree(tuple(Leaf(s, s // 4, s % 4 // 2) for s in range(8)))
    after = HashTree(tuple(Leaf(s, s // 4, s % 4 // 2, 3.0 if s == 5 else 1.0) for s in range(8)))
    rows = with_shard(with_shard(spark.range(8000), "id", before, "a"), "id", after, "b").collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    assert moved and all(b // 4 == 1 for _, b in moved)
    assert all(b // 2 == 2 for a, b in moved if a // 4 == 1)


def test_hard_tables(spark):
    tree = HashTree.regular(3)
    assert assign_shards(doc_frame(spark, []), tree).collect() == []
    rows = spark.createDataFrame([(None, None), (1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    found = assign_shards(rows, tree, None).collect()
    assert len(found) == 4 and all(r.grown_shard is None for r in found)
    assert len({r.shard for r in found if r.doc_id == 1}) == 1
    assert len({(r.shard, r.slot) for r in found}) == 4


def test_plan_has_no_python(spark):
    frame = with_shard(spark.range(10), "id", HashTree.regular(40), "s").select(F.sum("s"))
    assert "Python" not in frame._jdf.queryExecution().toString()
