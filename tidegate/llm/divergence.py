"""How far the sources of a language diverge in their vocabulary, to the last unit.

One pass over the texts indexes them: every task collects postings in memory and, when its
block is full, sends them on as a run sorted by term, cut by hash shard. A shard's runs are
merged with a heap into the frequencies of its terms. From these, the divergence of two
sources is the value they would have without any term, plus corrections for terms that
one of them has, plus corrections for terms that both have; only the last need the
postings of a term side by side, and those are streamed.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, doc_batches, longs

#: Postings (of single documents) and documents of one block in memory.
BLOCK_POSTINGS = 5 << 20
BLOCK_DOCS = 1 << 20
#: A posting holds its occurrences and, above this many bits, its documents.
COUNT_BITS = 40
#: Postings of one row of a run, which bounds what a batch of such rows holds.
ROW_POSTINGS = 256
#: Bytes of texts indexed at once.
TEXT_BYTES = 1 << 22
#: Sums of pairs of sources one task holds before it sends them.
HELD_PAIRS = 1 << 20
#: Parts into which the sources of a language are dealt when each meets all others.
SALTS = 32
PARTS = 1_000_000_000

# Lower case of ASCII letters; every other ASCII character ends a term.
_FOLD = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
RUN = pa.schema(
    [
        ("shard", pa.int32()),
        ("first", pa.binary()),
        ("terms", pa.list_(pa.binary())),
        ("ends", pa.list_(pa.int32())),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)
RUN_SQL = "shard int, first binary, terms array<binary>, ends array<int>, sources array<string>, counts array<long>"
#: Between a language and a term; no term holds it.
BETWEEN = b"\x00"


def segments(text: str) -> Iterator[bytes]:
    """A whole text with its terms folded and blanks between them, in parts that cut no term."""
    data = text.encode().translate(_FOLD)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + TEXT_BYTES)
        end = len(data) if end < 0 else end
        yield data[begin:end]
        begin = end


def part_postings(found: list[tuple[int, bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of segments (document, bytes); document, place among the terms and count of each posting."""
    codes = np.frombuffer(b" ".join(data for _, data in found), np.uint8)
    solid = codes != 0x20
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    start = np.flatnonzero(begins)
    edges = np.append(np.cumsum(solid)[start] - 1, solid.sum()).astype(np.int32)
    buffers = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(codes[solid]))]
    coded = pa.Array.from_buffers(pa.binary(), len(start), buffers).dictionary_encode()
    segment_at = np.cumsum([0, *(len(data) + 1 for _, data in found[:-1])])
    doc = np.array([doc for doc, _ in found], np.int64)[np.searchsorted(segment_at, start, side="right") - 1]
    key, n = np.unique(doc << 32 | coded.indices.to_numpy().astype(np.int64), return_counts=True)
    return coded.dictionary, key >> 32, key & 0xFFFFFFFF, n


class Block:
    """Postings of some documents in memory."""

    def __init__(self) -> None:
        self.owners: dict[tuple[str, str], int] = {}
        #: The group of each document; documents that lie in more than one part.
        self.group_of: list[int] = []
        self.spanning: set[int] = set()
        self.parts: list[tuple] = []
        self.waiting: list[tuple[int, bytes]] = []
        self.size = self.held = 0

    def add(self, lang: str, source: str, text: str) -> None:
        doc = len(self.group_of)
        self.group_of.append(self.owners.setdefault((lang, source), len(self.owners)))
        for i, data in enumerate(segments(text)):
            if self.held + len(data) > TEXT_BYTES:
                self._index()
                if i:
                    self.spanning.add(doc)
            self.waiting.append((doc, data))
            self.held += len(data)

    def _index(self) -> None:
        if self.waiting:
            self.parts.append(part_postings(self.waiting))
            self.size += len(self.parts[-1][1])
        self.waiting, self.held = [], 0

    def full(self) -> bool:
        return len(self.group_of) >= BLOCK_DOCS or self.size > BLOCK_POSTINGS

    def _postings(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct terms; group, place among the terms and value (count and documents) of each posting of a group."""
        coded = pa.concat_arrays([terms for terms, *_ in self.parts]).dictionary_encode()
        every = coded.indices.to_numpy().astype(np.int64)
        begin = np.cumsum([0, *(len(terms) for terms, *_ in self.parts)])
        doc = np.concatenate([doc for _, doc, _, _ in self.parts])
        term = np.concatenate([every[a + place] for a, (_, _, place, _) in zip(begin, self.parts, strict=False)])
        value = np.concatenate([n for *_, n in self.parts]).astype(np.int64)
        one = np.ones(len(doc), np.int64)
        if self.spanning:
            # A document counts once for a term, in however many of its parts it has it.
            again = np.flatnonzero(np.isin(doc, list(self.spanning)))
            _, first = np.unique(doc[again] << 32 | term[again], return_index=True)
            one[again] = 0
            one[again[first]] = 1
        value += one << COUNT_BITS
        key = np.array(self.group_of, np.int64)[doc] << 32 | term
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return coded.dictionary, key[start] >> 32, key[start] & 0xFFFFFFFF, np.add.reduceat(value[order], start)

    def run(self, shards: int) -> pa.RecordBatch | None:
        """The block as rows of RUN: in a shard, ascending by language and term, at most ROW_POSTINGS postings a row."""
        self._index()
        if not sum(len(doc) for _, doc, _, _ in self.parts):
            return None
        terms, group, term, value = self._postings()
        owners = list(self.owners)
        langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in owners))}
        prefixes = [lang.encode() + BETWEEN for lang in langs]
        lang_of = np.array([langs[lang] for lang, _ in owners], np.int64)
        named, which = np.unique(lang_of[group] << 32 | term, return_inverse=True)
        texts = terms.take(pa.array(named & 0xFFFFFFFF)).to_numpy(zero_copy_only=False)
        values = [prefixes[i] + text for i, text in zip((named >> 32).tolist(), texts.tolist(), strict=True)]
        names = pa.array(values, pa.binary())
        # Places of the distinct names in ascending order, and their shards.
        ascending = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(ascending), np.int64)
        rank[ascending] = np.arange(len(ascending))
        shard_of = np.fromiter((zlib.crc32(v) % shards for v in values), np.int64, len(values))
        order = np.lexsort((rank[which], shard_of[which]))
        which, size = which[order], len(order)
        shard = shard_of[which]
        new_shard = np.append(True, shard[1:] != shard[:-1])
        begin = np.flatnonzero(new_shard)
        place = np.arange(size) - np.repeat(begin, np.diff(np.append(begin, size)))
        row_start = np.flatnonzero(place % ROW_POSTINGS == 0)
        term_start = np.append(True, which[1:] != which[:-1])
        term_start[row_start] = True
        term_at = np.flatnonzero(term_start)
        row_ends = np.append(row_start, size)
        # Terms of each row, and where each one's postings end in its row.
        term_rows = np.searchsorted(term_at, row_ends)
        row_of_term = np.searchsorted(row_start, term_at, side="right") - 1
        ends = np.append(term_at[1:], size) - row_start[row_of_term]
        sources = pa.array([source for _, source in owners], pa.string()).take(pa.array(group[order]))
        edges = pa.array(row_ends, pa.int32())
        columns = [
            pa.array(shard[row_start], pa.int32()),
            names.take(pa.array(which[row_start])),
            pa.ListArray.from_arrays(pa.array(term_rows, pa.int32()), names.take(pa.array(which[term_at]))),
            pa.ListArray.from_arrays(pa.array(term_rows, pa.int32()), pa.array(ends, pa.int32())),
            pa.ListArray.from_arrays(edges, sources),
            pa.ListArray.from_arrays(edges, longs(value[order])),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=RUN)


def sorted_runs(docs: DataFrame, shards: int) -> DataFrame:
    """The index of ``docs`` (lang, source, text) as term-sorted runs."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()

        def spill() -> Iterator[pa.RecordBatch]:
            rows = block.run(shards)
            if rows is not None:
                yield from doc_batches(iter([rows]), 512)

        for batch in doc_batches(batches, 256):
            columns = (batch.column(n).to_pylist() for n in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                block.add(lang, source, text)
            if block.full():
                yield from spill()
                block = Block()
        yield from spill()

    return docs.select("lang", "source", "text").mapInArrow(index, RUN_SQL)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of RUN as Python values; list columns are converted whole, then cut."""
    columns = []
    for name in RUN.names:
        column = batch.column(name)
        if pa.types.is_list(column.type):
            values = column.flatten().to_numpy(zero_copy_only=False).tolist()
            edges = (column.offsets.to_numpy() - column.offsets[0].as_py()).tolist()
            columns.append([values[a:b] for a, b in zip(edges, edges[1:], strict=False)])
        else:
            columns.append(column.to_pylist())
    yield from zip(*columns, strict=True)


def merged(rows: Iterator[tuple]) -> Iterator[tuple[bytes, dict[str, int]]]:
    """(language and term, posting by source) of runs whose rows come in order of shard and first term.

    A heap holds the rows that may still have a term below the next row's first; a term is
    complete once every row that could hold it has been opened.
    """
    heap: list[tuple] = []
    home, opened = None, 0

    def complete(below: bytes | None) -> Iterator[tuple]:
        while heap and (below is None or heap[0][0] < below):
            term, sums = heap[0][0], {}
            while heap and heap[0][0] == term:
                _, order, i, (terms, ends, sources, counts) = heap[0]
                begin, end = ends[i - 1] if i else 0, ends[i]
                for source, n in zip(sources[begin:end], counts[begin:end], strict=True):
                    sums[source] = sums.get(source, 0) + n
                if i + 1 < len(terms):
                    heapq.heapreplace(heap, (terms[i + 1], order, i + 1, (terms, ends, sources, counts)))
                else:
                    heapq.heappop(heap)
            yield term, sums

    for shard, first, *lists in rows:
        yield from complete(first if home == shard else None)
        home, opened = shard, opened + 1
        heapq.heappush(heap, (first, opened, 0, lists))
    yield from complete(None)


def kept_postings(docs: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """(lang, term, source, n, total, lead) of terms that at least ``min_docs`` documents of a language hold.

    ``total`` is the term's count in the language; ``lead`` marks one row of each term.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"lang": pa.string(), "term": pa.binary(), "source": pa.string(), "n": pa.int64(), "total": pa.int64(), "lead": pa.bool_()}
        low = (1 << COUNT_BITS) - 1
        out: dict[str, list] = {name: [] for name in kinds}

        def send() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(out[n], kind) for n, kind in kinds.items()], names=list(kinds))
            for values in out.values():
                values.clear()
            return batch

        for name, sums in merged(row for batch in doc_batches(batches, 256) for row in _rows(batch)):
            if sum(sums.values()) >> COUNT_BITS < min_docs:
                continue
            lang, _, term = name.rpartition(BETWEEN)
            counts, k = [n & low for n in sums.values()], len(sums)
            out["lang"] += [lang.decode()] * k
            out["term"] += [term] * k
            out["source"] += sums
            out["n"] += counts
            out["total"] += [sum(counts)] * k
            out["lead"] += [True] + [False] * (k - 1)
            if len(out["n"]) > 8192:
                yield send()
        if out["n"]:
            yield send()

    dealt = sorted_runs(docs, shards).repartition("shard").sortWithinPartitions("shard", "first")
    found = dealt.mapInArrow(merge, "lang string, term binary, source string, n long, total long, lead boolean")
    return found.withColumn("term", F.col("term").cast("string"))


def share(n: str, size: str, terms: str) -> Column:
    """Smoothed share of a count in parts of a milliard, 1 at least; exact for any count."""
    top = f"CAST({PARTS} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))"
    return F.expr(f"1 + CAST(({top}) div nullif(CAST({size} + 2 * {terms} AS DECIMAL(20,0)), 0) AS BIGINT)")


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)): both are at most a milliard and one, so the square fits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _group_totals(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, size, terms, lang_size, p0) of every group that occurs; p0 is the share of a term it lacks."""
    zero = F.lit(0).cast("long")
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    lead = F.col("lead").cast("long")
    langs = postings.groupBy("lang").agg(F.sum(lead).alias("terms"), F.sum("n").alias("lang_size"))
    groups = docs.select("lang", "source").distinct()
    found = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = found.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "terms", "lang_size")])
    return filled.withColumn("p0", share("0", "size", "terms"))


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over terms that two sources share of what differs from the two one-sided corrections.

    Rows (lang, term, source, p, p0) come sorted by lang, term and source. Terms held by equally many sources are
    handled together, one distance between places at a time, so memory follows the rows and not the pairs.
    """
    names: dict[tuple[str, str], int] = {}
    sums: dict[int, int] = {}

    def send() -> pa.RecordBatch:
        groups = list(names)
        left, right = ([groups[k >> 32] for k in sums], [groups[k & 0xFFFFFFFF] for k in sums])
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in left], pa.string()),
                pa.array([source for _, source in left], pa.string()),
                pa.array([source for _, source in right], pa.string()),
                longs(list(sums.values())),
            ],
            names=["lang", "source", "item", "x"],
        )
        sums.clear()
        return out

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def pairs(group: np.ndarray, p: np.ndarray, p0: np.ndarray, size: np.ndarray) -> None:
        """Arrays of all rows of whole terms, and the number of rows of each term."""
        start = np.cumsum(size) - size
        keys, values = [], []
        for k in np.unique(size[size > 1]).tolist():
            rows = start[size == k][:, None] + np.arange(k)
            for d in range(1, k):
                a, b = rows[:, :-d].ravel(), rows[:, d:].ravel()
                x = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
                keys.append(group[a] << 32 | group[b])
                values.append(x)
        if keys:
            found, where = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.zeros(len(found), np.int64)
            np.add.at(totals, where, np.concatenate(values))
            for key, x in zip(found.tolist(), totals.tolist(), strict=True):
                sums[key] = sums.get(key, 0) + x

    # Rows of the last term met, which the next batch may continue: one per source at most.
    last: list[pa.RecordBatch] = []
    for batch in _with_end(batches):
        if batch is not None:
            last.append(batch)
            lang, term = batch.column("lang"), batch.column("term")
            end = batch.num_rows - 1
            if len(last) < 2 and lang[0] == lang[end] and term[0] == term[end]:
                continue
        if not last:
            continue
        rows = pa.Table.from_batches(last).combine_chunks()
        langs, terms = rows.column("lang").to_pylist(), rows.column("term").to_pylist()
        changes = [i for i in range(1, len(terms)) if terms[i] != terms[i - 1] or langs[i] != langs[i - 1]]
        whole = rows.num_rows if batch is None else changes[-1] if changes else 0
        last = rows.slice(whole).to_batches() if whole < rows.num_rows else []
        if whole:
            edges = np.array([0, *[c for c in changes if c < whole], whole], np.int64)
            owners = zip(langs[:whole], rows.column("source").to_pylist()[:whole], strict=True)
            group = np.array([names.setdefault(o, len(names)) for o in owners], np.int64)
            p, p0 = (rows.column(c).to_numpy()[:whole] for c in ("p", "p0"))
            pairs(group, p, p0, np.diff(edges))
        if len(sums) > HELD_PAIRS:
            yield send()
    if sums:
        yield send()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _pair_values(postings: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    # Every source meets every other one of its language: their pairs are the result. Sources are dealt over salts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    others = totals.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), salts)
    counted = postings.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
    # A row without weight for every group, so that groups without terms have their pairs.
    own = counted.unionByName(totals.select("lang", "source", F.col("p0").alias("p"), "p0", F.lit(0).cast("long").alias("m")))
    own = own.withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS)).cast("int"))
    met = own.join(others, ["lang", "salt"]).where("source <> item")
    x = F.coalesce(F.col("m") * (gap("p", "q0") - gap("p0", "q0")), F.lit(0).cast("long"))
    single = met.groupBy("lang", "source", "item").agg(F.sum(x).alias("x"))

    both = postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term")
    both = both.sortWithinPartitions("lang", "term", "source")
    shared = both.mapInArrow(_shared_terms, "lang string, source string, item string, x long")
    parts = single.unionByName(shared)
    turned = parts.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "x")
    sums = parts.unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("x").alias("x"))

    left = totals.select("lang", "source", "terms", "p0")
    right = totals.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = sums.join(left, ["lang", "source"]).join(right, ["lang", "item"])
    value = F.col("x") + F.coalesce(F.col("terms") * gap("p0", "q0"), F.lit(0).cast("long"))
    return base.select("lang", "source", "item", value.alias("value"))


def audit_sources(docs: DataFrame, min_docs: int = 10, top: int = 10, shards: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets the sources of a language apart.

    A term is a run of ASCII letters and non-ASCII characters, ASCII letters folded; a
    language keeps the terms of at least ``min_docs`` of its documents (rows; repeated rows
    count each). Null text, lang and source read as ''. A group gives each kept term the share
    p = 1 + floor(10^9 (n + 2) / (N + 2 V)). Part ``pair`` has every other source of the
    language by floor((p - q)^2 / (p + q)) summed over all kept terms; part ``term`` has the
    ``top`` kept terms a source holds with a greater share than its language. Ranks start at
    1, larger values first, then by item. A source alone in its language has no pairs; a
    language without kept terms has pairs of value 0; an empty table gives no rows.

    ``shards`` (two for each shuffle partition by default) are merged one by one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    postings = scratch.save(kept_postings(docs, min_docs, shards), "postings")
    totals = scratch.save(_group_totals(docs, postings), "totals")

    found = postings.join(totals, ["lang", "source"])
    found = found.withColumn("p", share("n", "size", "terms")).withColumn("q", share("total", "lang_size", "terms"))
    own_terms = found.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    pairs = _pair_values(found, totals).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = own_terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
