"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region, rack and shard. At each node every child draws a time
``-ln(u) / weight`` from a hash of the row's key and the child's name; the smallest wins.
Raising one child's weight only shortens that child's times, so rows move into its subtree
alone; lowering it moves rows only out of it. A shard that is added later is a leaf of
a later generation: the branch of its generation is a child of its own at the root, so
the rows it wins go to the new shard and no row moves between older ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, numbered


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: int
    rack: int
    weight: float = 1.0
    generation: int = 0


@dataclass(frozen=True)
class HashTree:
    leaves: tuple[Leaf, ...]

    def __post_init__(self) -> None:
        if not self.leaves or any(leaf.weight <= 0 for leaf in self.leaves):
            raise ValueError("a tree needs leaves of positive weight")

    @classmethod
    def regular(cls, shards: int, shards_a_rack: int = 4, racks_a_region: int = 2) -> HashTree:
        span = shards_a_rack * racks_a_region
        return cls(tuple(Leaf(s, s // span, s % span // shards_a_rack) for s in range(shards)))

    def grow(self, region: int, rack: int, weight: float = 1.0) -> HashTree:
        """The tree with one more shard, which takes rows only into itself."""
        leaf = Leaf(
            max(x.shard for x in self.leaves) + 1, region, rack, weight, max(x.generation for x in self.leaves) + 1
        )
        return HashTree((*self.leaves, leaf))


def _draw(key: Column, name: str, weight: float) -> Column:
    """Time a child draws for a key; the 53-bit fraction lies strictly between 0 and 1."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
    return -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(weight)


def _choose(key: Column, children: Sequence[tuple[str, float, Column]]) -> Column:
    """Value of the child with the smallest draw; equal draws go to the earlier child."""
    if len(children) == 1:
        return children[0][2]
    return F.least(
        *(
            F.struct(_draw(key, name, weight).alias("time"), F.lit(i).alias("nth"), value.alias("value"))
            for i, (name, weight, value) in enumerate(children)
        )
    )["value"]


def _groups(leaves: Sequence[Leaf], of) -> dict:
    out: dict = {}
    for leaf in leaves:
        out.setdefault(of(leaf), []).append(leaf)
    return out


def with_shard(rows: DataFrame, key: str, tree: HashTree, name: str = "shard") -> DataFrame:
    """Adds the shard of each row. One column per level, so a row draws only among the children of its node."""
    k = F.col(key)
    branch, node = f"__{name}_branch", f"__{name}_rack"
    branches = _groups(tree.leaves, lambda x: (x.generation, x.region))
    names = list(branches)
    top = [(f"r{g}.{r}", sum(x.weight for x in branches[g, r]), F.lit(i)) for i, (g, r) in enumerate(names)]
    rows = rows.withColumn(branch, _choose(k, top))

    racks = [(b, rack) for b in names for rack in _groups(branches[b], lambda x: x.rack)]
    by_branch = None
    for i, b in enumerate(names):
        inside = _groups(branches[b], lambda x: x.rack)
        children = [
            (f"r{b[0]}.{b[1]}/{rack}", sum(x.weight for x in leaves), F.lit(racks.index((b, rack))))
            for rack, leaves in inside.items()
        ]
        chosen = _choose(k, children)
        by_branch = F.when(F.col(branch) == i, chosen) if by_branch is None else by_branch.when(F.col(branch) == i, chosen)
    rows = rows.withColumn(node, by_branch)

    by_rack = None
    for i, (b, rack) in enumerate(racks):
        leaves = [x for x in branches[b] if x.rack == rack]
        chosen = _choose(k, [(f"r{b[0]}.{b[1]}/{rack}/{x.shard}", x.weight, F.lit(x.shard)) for x in leaves])
        by_rack = F.when(F.col(node) == i, chosen) if by_rack is None else by_rack.when(F.col(node) == i, chosen)
    return rows.withColumn(name, by_rack).drop(branch, node)


def assign_shards(
    docs: DataFrame, tree: HashTree, grown: HashTree | None = None, row_bytes: int = 16
) -> DataFrame:
    """Shard and slot of every document.

    Returns doc_id, size (UTF-8 bytes of the text plus ``row_bytes``), text_crc32, law
    (``key``: key and tree decide), shard, slot (0, 1, ... in the shard, by doc_id) and
    grown_shard (under ``grown``, else null). Equal texts are placed by their own keys.
    A null text has no bytes and checksum 0; rows that share a doc_id share a shard and
    get slots of their own; a null doc_id is a key like any other; an empty table gives no
    rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # Texts are read once, here; what follows moves narrow rows.
    rows = with_shard(rows, "doc_id", tree)
    rows = with_shard(rows, "doc_id", grown, "grown_shard") if grown else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    drawn = scratch.save(rows, "drawn")
    placed = scratch.save(numbered(drawn, "shard", "doc_id", "text_crc32", "size"), "placed")
    scratch.drop("drawn")
    # A row per shard and part: at most shards plus parts, as parts are ranges of shards.
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        "shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base")
    )
    return placed.join(base, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("base") + F.col("place")).alias("slot"),
        "grown_shard",
    )
