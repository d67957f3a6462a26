"""Cheapest repair of the structure of conversations: Viterbi over chunks, run in parallel.

A sound conversation has role initials ``(s?(ua)+)?``. Each row may be kept, given the role
user or assistant, or deleted, and rows may be inserted; a row's faults force or punish some of
these. The automaton of the pattern has four states, so what the rows after some place cost is
a vector of four numbers.

Conversations of any length are cut into chunks. Every chunk first runs backwards from a
speculative vector, the one of a conversation's end. Fix-up passes then run a chunk
again from the vector of the chunk behind it, as long as that vector, taken up to a
constant, is not the one it ran from: the steps of a chunk depend on differences only. Chunks in
which every row must go pass on any vector unchanged and are skipped. With the
vectors in place, each chunk traces its edits forwards from every state it may be entered in,
the least letter first among equally cheap edits, and a scan over the chunks picks the traces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, doc_batches

#: Rows and characters of text of one chunk at most; a longer text makes a chunk of its own.
CHUNK_ROWS = 256
CHUNK_CHARS = 1 << 14
#: Characters of a text by which rows of one turn and role are ordered first.
HEAD_CHARS = 32
# The costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# The state after a row kept with an initial, by state.
# 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after a row whose role may be chosen, and that role.
FORCED = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
INITIALS = "sua"
FAR = 1 << 30
#: Kinds of a row. A row's code is its kind and, two bits further, the place of its initial in INITIALS.
SOUND, BLANK, DUPLICATE, CUT = range(4)

ORDER = ["conv", "part", "place"]
CHUNK = pa.schema(
    [
        ("conv", pa.string()),
        ("part", pa.int32()),
        ("place", pa.int64()),
        ("closed", pa.bool_()),
        ("codes", pa.binary()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("keys", pa.list_(pa.binary())),
        ("turns", pa.int64()),
        ("first_turn", pa.int64()),
        ("last_turn", pa.int64()),
        ("first_initial", pa.string()),
        ("last_initial", pa.string()),
        ("illegal", pa.int64()),
    ]
)
MEASURES = CHUNK.names[8:]
CHUNK_SQL = (
    "conv string, part int, place long, closed boolean, codes binary, roles array<string>, texts array<string>, "
    "keys array<binary>, turns long, first_turn long, last_turn long, first_initial string, last_initial string, "
    "illegal long"
)


def _closed_by_inserts(vector: list[int]) -> tuple[int, ...]:
    """The vector once rows may be inserted before the place."""
    for _ in range(3):
        vector = [min(cost, INSERT + vector[FORCED[s]]) for s, cost in enumerate(vector)]
    return tuple(vector)


#: Cost of ending in each state.
END = _closed_by_inserts([0, FAR, FAR, 0])


def must_go(code: int) -> bool:
    return code & 3 in (BLANK, DUPLICATE)


def _row_costs(state: int, code: int, behind: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(letter, cost with all that follows, state) of the ways to spend a row."""
    out = [("D", DELETE + behind[state], state)]
    if not must_go(code):
        extra = TRUNCATED if code & 3 == CUT else 0
        initial = code >> 2
        kept = AFTER[state].get(INITIALS[initial]) if initial < len(INITIALS) else None
        if kept is not None:
            out.append(("K", extra + behind[kept], kept))
        out.append(("R", REROLE + extra + behind[FORCED[state]], FORCED[state]))
    return out


def normal(vector: tuple[int, ...]) -> tuple[int, ...]:
    least = min(vector)
    return tuple(v - least for v in vector)


class Steps:
    """Backward steps and choices by vector, remembered: vectors that differ by a constant are one."""

    def __init__(self) -> None:
        self.before: dict[tuple, tuple] = {}
        self.choices: dict[tuple, tuple] = {}

    def back(self, codes: bytes, vector: tuple[int, ...]) -> list[tuple[int, ...]]:
        """Normalised vectors before each row, and ``vector`` behind the last."""
        out = [vector]
        for code in reversed(codes):
            key = (vector, code)
            if key not in self.before:
                best = [min(cost for _, cost, _ in _row_costs(s, code, vector)) for s in range(4)]
                self.before[key] = normal(_closed_by_inserts(best))
            vector = self.before[key]
            out.append(vector)
        return out[::-1]

    def _choice(self, state: int, code: int, behind: tuple[int, ...]) -> tuple[str, int, int]:
        """Edits before and on a row with the least cost and, among these, the least letters; their cost; the next state."""
        vector = _closed_by_inserts([min(c for _, c, _ in _row_costs(s, code, behind)) for s in range(4)])
        letters, paid = "", 0
        while True:
            ways = {letter: (cost, after) for letter, cost, after in _row_costs(state, code, behind) if cost == vector[state]}
            if "D" not in ways and INSERT + vector[FORCED[state]] == vector[state]:
                letters, paid, state = letters + "I", paid + INSERT, FORCED[state]
                continue
            letter = min(ways)
            cost, after = ways[letter]
            return letters + letter, paid + cost - behind[after], after

    def trace(self, codes: bytes, vectors: list[tuple[int, ...]], state: int) -> tuple[list[str], int, int]:
        """Edits of each row from a state on, their cost and the state behind the last row."""
        edits, cost = [], 0
        for code, behind in zip(codes, vectors[1:], strict=True):
            key = (state, code, behind)
            if key not in self.choices:
                self.choices[key] = self._choice(*key)
            letters, paid, state = self.choices[key]
            edits.append(letters)
            cost += paid
        return edits, cost, state


def ending(state: int) -> tuple[str, int]:
    """Edits behind the last row, and their cost."""
    letters, cost = "", 0
    while state in (1, 2):
        letters, cost, state = letters + "I", cost + INSERT, FORCED[state]
    return letters, cost


def applied(edits: list[str], tail: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired rows."""
    out_roles, out_texts = [], []
    for i, letters in enumerate([*edits, tail]):
        for letter in letters:
            if letter == "K":
                state = AFTER[state][roles[i][0]]
                out_roles.append(roles[i])
            elif letter in "IR":
                state = FORCED[state]
                out_roles.append(ROLE_OF[state])
            if letter in "KR":
                out_texts.append(texts[i])
            elif letter == "I":
                out_texts.append("")
    return out_roles, out_texts


# -- rows and chunks ---------------------------------------------------------


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text) with their faults, sorted over all partitions; ``part`` and ``place`` number them.

    Rows of one conversation go by turn (nulls first), then by role, the start of the text and a digest of role and
    text, so that any number of rows of one turn can be dealt to several tasks and have one order. The numbers
    hold for one execution only.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumns(
        {
            "kind": F.when(blank, BLANK).when(ended, SOUND).otherwise(CUT),
            "digest": F.unhex(F.md5(named.cast("binary"))),
            "head": F.substring("text", 1, HEAD_CHARS),
            # Equal rows may stand in any order: the number only lets ranges cut between them.
            "tie": F.monotonically_increasing_id(),
        }
    )
    order = ("conv", "turn", "role", "head", "digest", "tie")
    place = F.monotonically_increasing_id()
    numbers = {"part": F.shiftright(place, 33).cast("int"), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.drop("head", "tie").withColumns(numbers)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _chunk(conv: str, part: int, place: int, closed: bool, rows: list[tuple]) -> tuple:
    """One row of CHUNK from rows (role, turn, text, kind, digest)."""
    seen: set[bytes] = set()
    codes = bytearray()
    for role, _, _, kind, digest in rows:
        if kind != BLANK and digest in seen:
            kind = DUPLICATE
        seen.add(digest)
        initial = INITIALS.find(role[0]) if role else -1
        codes.append(kind | (initial if initial >= 0 else len(INITIALS)) << 2)
    initials = [role[:1] for role, *_ in rows]
    turns = {turn for _, turn, *_ in rows if turn is not None}
    return (
        *(conv, part, place, closed, bytes(codes)),
        *([r[0] for r in rows], [r[2] for r in rows], [] if closed else [r[4] for r in rows]),
        *(len(turns), min(turns, default=None), max(turns, default=None)),
        *(initials[0], initials[-1], sum(map(illegal, initials, initials[1:]))),
    )


def illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


def _chunks_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts rows in order into chunks; ``closed`` ones are known to be whole conversations."""
    done: list[tuple] = []
    rows: list[tuple] = []
    conv, part, first, continued = None, -1, 0, True
    chars = held = 0
    names = ("conv", "part", "place", "role", "turn", "text", "kind", "digest")
    for batch in doc_batches(batches, 256):
        for now, home, place, role, turn, text, kind, digest in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            follows = bool(rows) and home == part and place == first + len(rows)
            same = follows and now == conv
            if not same or len(rows) >= CHUNK_ROWS or chars + len(text) > CHUNK_CHARS:
                if rows:
                    done.append(_chunk(conv, part, first, follows and not same and not continued, rows))
                    held += chars
                # A chunk starts a conversation for sure only right behind a row of another one.
                conv, part, first, continued, rows, chars = now, home, place, same or not follows, [], 0
                if held > 64 * CHUNK_CHARS or len(done) >= 1024:
                    yield _record(done, CHUNK)
                    done, held = [], 0
            rows.append((role, turn, text, kind, digest))
            chars += len(text)
    if rows:
        done.append(_chunk(conv, part, first, False, rows))
    if done:
        yield _record(done, CHUNK)


# -- conversations of several chunks -----------------------------------------


def _with_later_copies(chunks: DataFrame) -> DataFrame:
    """(conv, part, place, codes) of open chunks, with rows that an earlier chunk has marked as duplicates.

    A key has one row per chunk here, however often it occurs in it, and its first chunk is a map-side minimum.
    """
    keyed = chunks.select(*ORDER, F.posexplode("keys").alias("i", "key"))
    own = keyed.groupBy(*ORDER, "key").agg(F.collect_list("i").alias("at"))
    firsts = own.groupBy("conv", "key").agg(F.min(F.struct("part", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    later = own.join(firsts.where("n > 1"), ["conv", "key"]).where("struct(part, place) > first")
    again = later.groupBy(*ORDER).agg(F.flatten(F.collect_list("at")).alias("again"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches):
            out = []
            for codes, places in zip(batch.column("codes").to_pylist(), batch.column("again").to_pylist(), strict=True):
                marked = bytearray(codes)
                for i in places or []:
                    if marked[i] & 3 != BLANK:
                        marked[i] = marked[i] & ~3 | DUPLICATE
                out.append(bytes(marked))
            columns = [pa.array(out, pa.binary()) if n == "codes" else batch.column(n) for n in [*ORDER, "codes"]]
            yield pa.RecordBatch.from_arrays(columns, names=[*ORDER, "codes"])

    found = chunks.select(*ORDER, "codes").join(again, ORDER, "left")
    return found.mapInArrow(mark, "conv string, part int, place long, codes binary")


PASS_SQL = (
    "conv string, part int, place long, codes binary, behind array<int>, before array<int>, "
    "through boolean, changed boolean"
)


def _run_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs chunks (..., codes, behind, before, wanted) from the wanted vector unless they ran from it already."""
    steps = Steps()
    for batch in doc_batches(batches):
        columns = {n: batch.column(n) for n in (*ORDER, "codes")}
        rows = zip(*(batch.column(n).to_pylist() for n in ("codes", "behind", "before", "wanted")), strict=True)
        befores, through, changed = [], [], []
        for codes, behind, before, wanted in rows:
            new = before if behind == wanted else list(steps.back(codes, tuple(wanted))[0])
            befores.append(new)
            # Every row must go, so the vector in front is the one behind and a constant.
            through.append(all(map(must_go, codes)))
            changed.append(new != before)
        vectors = pa.list_(pa.int32())
        columns |= {"behind": batch.column("wanted"), "before": pa.array(befores, vectors)}
        columns |= {"through": pa.array(through, pa.bool_()), "changed": pa.array(changed, pa.bool_())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def converged(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, part, place, codes, behind): every chunk with the vector behind it, up to a constant.

    All chunks run from the speculative vector first. Each pass takes the vector in front of the next chunk
    that is not passed through, first inside the part, then from later parts, so that no
    window holds more than a part or one row per part. It ends when no vector changed by more than a constant.
    """
    end = F.array(*[F.lit(v).cast("int") for v in normal(END)])
    none = F.lit(None).cast("array<int>")
    start = marked.withColumns({"behind": none, "before": none, "wanted": end})
    state = scratch.save(start.mapInArrow(_run_back, PASS_SQL), "pass-0")
    inside = Window.partitionBy("conv", "part").orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, -1)
    beyond = Window.partitionBy("conv").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    passes = 0
    while not state.where("changed").isEmpty():
        solid = F.when(~F.col("through"), F.col("before"))
        heads = state.groupBy("conv", "part").agg(F.min_by(solid, F.when(~F.col("through"), F.col("place"))).alias("head"))
        heads = heads.select("conv", "part", F.last("head", ignorenulls=True).over(beyond).alias("beyond"))
        near = state.withColumn("inside", F.last(solid, ignorenulls=True).over(inside)).join(heads, ["conv", "part"])
        again = near.withColumn("wanted", F.coalesce("inside", "beyond", end))
        passes += 1
        state = scratch.save(again.mapInArrow(_run_back, PASS_SQL), f"pass-{passes}")
        scratch.drop(f"pass-{passes - 1}")
    return state.select(*ORDER, "codes", "behind")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fills in ``exits``: the state behind a chunk for each state in front of it."""
    steps = Steps()
    for batch in doc_batches(batches):
        out = []
        for codes, behind in zip(batch.column("codes").to_pylist(), batch.column("behind").to_pylist(), strict=True):
            vectors = steps.back(codes, tuple(behind))
            out.append([steps.trace(codes, vectors, s)[2] for s in range(4)])
        names = [n for n in batch.schema.names if n != "exits"]
        columns = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.list_(pa.int32()))], names=[*names, "exits"])


ENTRY_SQL = "conv string, part int, place long, state int, is_last boolean, turns long, illegal long"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans the chunks of conversations in order: the state each is entered in, and what counts only across chunks."""
    names = [part.split()[0] for part in ENTRY_SQL.split(", ")]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    fields = (*ORDER, "exits", *MEASURES)
    waiting: list | None = None
    conv = state = turn = initial = None
    for batch in doc_batches(batches):
        out = []
        for row in zip(*(batch.column(n).to_pylist() for n in fields), strict=True):
            here, part, place, exits, turns, first_turn, last_turn, first_initial, last_initial, wrong = row
            same = waiting is not None and here == conv
            if waiting is not None:
                out.append((*waiting[:4], not same, *waiting[4:]))
            if not same:
                conv, state, turn = here, 0, None
            elif illegal(initial, first_initial):
                wrong += 1
            if same and turn is not None and turn == first_turn:
                turns -= 1
            waiting = [here, part, place, state, turns, wrong]
            state, initial = exits[state], last_initial
            turn = turn if last_turn is None else last_turn
        if out:
            yield _record(out, schema)
    if waiting is not None:
        yield _record([(*waiting[:4], True, *waiting[4:])], schema)


# -- the repair --------------------------------------------------------------

PIECE_SQL = (
    "conv string, part int, place long, closed boolean, edits array<string>, tail string, roles array<string>, "
    "texts array<string>, blank long, duplicate long, truncated long, illegal long, cost long, "
    "turns long, first_turn long, last_turn long"
)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Traces the edits of chunks from their state and applies them."""
    steps = Steps()
    for batch in doc_batches(batches, 64):
        made: dict[str, list] = {n: [] for n in ("edits", "tail", "roles", "texts", "blank", "duplicate", "truncated", "cost")}
        fields = ("codes", "behind", "state", "is_last", "roles", "texts")
        for codes, behind, state, is_last, roles, texts in zip(*(batch.column(n).to_pylist() for n in fields), strict=True):
            edits, cost, after = steps.trace(codes, steps.back(codes, tuple(behind)), state)
            tail, paid = ending(after) if is_last else ("", 0)
            roles, texts = applied(edits, tail, roles, texts, state)
            kinds = [code & 3 for code in codes]
            values = (edits, tail, roles, texts, kinds.count(BLANK), kinds.count(DUPLICATE), kinds.count(CUT), cost + paid)
            for column, value in zip(made.values(), values, strict=True):
                column.append(value)
        strings = pa.list_(pa.string())
        kinds_of = {"edits": strings, "tail": pa.string(), "roles": strings, "texts": strings}
        columns = {n: pa.array(v, kinds_of.get(n, pa.int64())) for n, v in made.items()}
        names = [part.split()[0] for part in PIECE_SQL.split(", ")]
        yield pa.RecordBatch.from_arrays([columns[n] if n in columns else batch.column(n) for n in names], names=names)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The repaired pieces of every conversation of ``rows`` (conv_id, turn, role, text).

    Columns: conv (the conversation, see ``conversation_key``); part and place, which order its pieces; closed (the
    piece is the whole conversation); edits, the letters on each of its rows, insertions before a
    row ahead of the row's own letter, and tail, those behind the last row; roles and texts after the
    repair; and the piece's blank, duplicate, truncated and illegal counts, cost, distinct
    turns not counted before, first and last turn.

    Null roles and texts count as one space, null turns come first, a null conv_id is a conversation of its own. Rows of
    one turn go by role, the start of the text and a digest. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(rows.sparkSession, "conversations")
    space = F.lit(" ")
    plain = rows.select(
        conversation_key(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    chunks = scratch.save(in_order(plain).mapInArrow(_chunks_of_task, CHUNK_SQL), "chunks")

    several = chunks.where("not closed")
    marked = scratch.save(_with_later_copies(several), "marked")
    settled = scratch.save(converged(marked, scratch), "settled")
    measured = settled.join(several.select(*ORDER, *MEASURES), ORDER)
    traced = measured.withColumn("exits", F.lit(None).cast("array<int>"))
    traced = traced.mapInArrow(_exits, traced.schema).drop("codes", "behind")
    scanned = traced.repartition("conv").sortWithinPartitions(*ORDER).mapInArrow(_entries, ENTRY_SQL)

    end = F.array(*[F.lit(v).cast("int") for v in normal(END)])
    content = ["closed", "roles", "texts", "first_turn", "last_turn"]
    whole = chunks.where("closed").select(
        *ORDER, *content, "codes", "turns", "illegal", end.alias("behind"), F.lit(0).alias("state"), F.lit(True).alias("is_last")
    )
    parts = several.select(*ORDER, *content).join(settled, ORDER).join(scanned, ORDER).select(*whole.columns)
    return whole.unionByName(parts).mapInArrow(_repaired, PIECE_SQL)


def conversation_key(conv_id: Column) -> Column:
    """A conversation's name as text: null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def conversation_report(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, conv.

    ``pieces`` come from ``repair_conversations`` of what is left of ``rows``; a conversation of which nothing
    is left has zeros and an empty audit.
    """
    letters = F.concat(F.array_join("edits", ""), "tail").alias("letters")
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    found = pieces.select(*ORDER, letters, *sums, "turns", "first_turn", "last_turn").groupBy("conv").agg(
        (F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns")).alias("gaps"),
        *[F.sum(c).alias(c) for c in sums],
        F.sort_array(F.collect_list(F.struct("part", "place", "letters"))).alias("pieces"),
    )
    zero = F.lit(0).cast("long")
    audit = F.array_join(F.col("pieces.letters"), "")
    originals = rows.select("conv_id").distinct().withColumn("conv", conversation_key(F.col("conv_id")))
    return originals.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", *sums)], F.coalesce(audit, F.lit("")).alias("audit"), "conv"
    )


def digests(pieces: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired rows ``role:text`` joined by newlines.

    A piece that is a whole conversation is hashed in place. The pieces of longer ones stream through one task
    each in their order: SHA-256 has no parallel form; only its state is held.
    """
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    joined = pieces.select(*ORDER, "closed", F.size("roles").alias("n"), F.array_join(lines, "\n").alias("lines"))
    whole = joined.where("closed").select("conv", F.sha2("lines", 256).alias("sha256"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, any_rows = None, None, False

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], names=["conv", "sha256"])

        for batch in doc_batches(batches, 64):
            for here, n, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "n", "lines")), strict=True):
                if here != conv or state is None:
                    if state is not None:
                        yield out()
                    conv, state, any_rows = here, hashlib.sha256(), False
                if n:
                    state.update((b"\n" if any_rows else b"") + text.encode())
                    any_rows = True
        if state is not None:
            yield out()

    ordered = joined.where("not closed").repartition("conv").sortWithinPartitions(*ORDER)
    return whole.unionByName(ordered.mapInArrow(stream, "conv string, sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a twentieth of their rows dropped, emptied, unpunctuated, repeated or given to the user, each.

    What happens to a row follows from crc32 of ``conv_id:turn``; nulls read as one space.
    """
    space = F.lit(" ")

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    # The remainders and what they do.
    drop, empty, unpunctuate, repeat, to_user = (F.lit(i) for i in range(5))
    way = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    bare = F.regexp_replace(filled("text"), "[.!?]", "")
    text = F.when(way == empty, "").when(way == unpunctuate, bare).otherwise(filled("text"))
    role = F.when(way == to_user, "user").otherwise(filled("role"))
    copies = F.explode(F.when(way == repeat, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    left = rows.where(way != drop).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
    return left.drop("copy")
