"""Operator 12, conversation structure repair: persistent audit DP over the rows of a conversation.

The state of the DP is the role the repaired text has reached (start, after s, after u, after a). Per
state it keeps the cheapest cost and a node of a tree of edits: prefixes are shared, a node knows its
parent, its depth, a rolling hash of its prefix and its ancestors at powers of two. When costs tie, the
longest common prefix of two audits is found by lifting both nodes while their hashes differ, and the
next edit decides; equal hashes are verified by walking both prefixes until they meet.

Why a prefix may be dropped: at equal cost, after the same rows and in the same state, no audit is the
start of another (the longer one would have more inserts and cost more), so the ASCII-least
prefix stays least whatever follows.

Rows are range-sorted by (conversation, turn, role, text), so a conversation of any size spreads over
slices. One that lies inside a slice is repaired there. Otherwise it leaves chunks of bounded size,
each with the best audit for every pair of entry and exit states and their order; inserts stand before
a row, so two audits of a chunk differ within both and their order holds for whatever follows. The
chunks' costs and orders (no texts) are combined per conversation by the same DP, and the
chosen audits are streamed in order into one audit and one hash.

Defined cases: nulls count as one space in the damage key, the role and the text; a null turn sorts first
and has no part in gaps; a null conv_id is a conversation of its own. Rows of one turn go by role, then
text; equal rows are copies, of which all but the first are duplicates. A role whose initial is none
of s, u, a can't be kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cmp_to_key

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.session import stage_table

DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
CHUNK_ROWS, CHUNK_CHARS = 4096, 4_000_000
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACES = " \t\n\x0b\x0c\r"

# State -> (initial of the next role, state after it).
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_MOVES = {
    _START: (("s", _SYSTEM), ("u", _USER)),
    _SYSTEM: (("u", _USER),),
    _USER: (("a", _ASSISTANT),),
    _ASSISTANT: (("u", _USER),),
}
_NAMES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
# Inserts that end a conversation, by the state they start from.
_CLOSING = {_START: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class Edits:
    """Tree of edit prefixes; a prefix is a node, node 0 is the empty one."""

    _MODULUS, _BASE = (1 << 61) - 1, 1_000_003

    def __init__(self) -> None:
        self.edit: list = [None]
        self.depth = [0]
        self.hash = [0]
        self.ancestors: list[list[int]] = [[]]
        self._verified: set[tuple[int, int]] = set()

    def add(self, node: int, edit) -> int:
        """The prefix `node` followed by `edit`."""
        up, k = [node], 0
        while k < len(self.ancestors[up[k]]):
            up.append(self.ancestors[up[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(self._mixed(self.hash[node], edit))
        self.ancestors.append(up)
        return len(self.edit) - 1

    def _mixed(self, before: int, edit) -> int:
        return (before * self._BASE + (ord(edit) if isinstance(edit, str) else edit) + 1) % self._MODULUS

    def spelled(self, node: int) -> list:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.ancestors[node][0]
        return out[::-1]

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.ancestors[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Are two prefixes of one depth and hash equal? Walks until they share a node."""
        walked = []
        while a != b and (a, b) not in self._verified:
            if self.edit[a] != self.edit[b]:
                return False
            walked.append((a, b))
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        self._verified.update(walked)
        return True

    def less(self, a: int, b: int) -> bool:
        """Does the prefix `a` come before `b`, edit by edit?"""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.hash[x] != self.hash[y]:
            for k in range(len(self.ancestors[x]) - 1, -1, -1):
                if k < len(self.ancestors[x]):
                    up, other = self.ancestors[x][k], self.ancestors[y][k]
                    if self.hash[up] != self.hash[other]:
                        x, y = up, other
            if self._same(self.ancestors[x][0], self.ancestors[y][0]):
                return self.edit[x] < self.edit[y]
        elif self._same(x, y):
            return self.depth[a] < self.depth[b]
        return self.spelled(a) < self.spelled(b)  # two different prefixes had one hash

    def better(self, a: tuple[int, int] | None, b: tuple[int, int] | None) -> bool:
        """Is (cost, node) `a` cheaper than `b`, or as cheap and less?"""
        if a is None or b is None:
            return a is not None
        return a[0] < b[0] or (a[0] == b[0] and a[1] != b[1] and self.less(a[1], b[1]))


Front = list  # per state: (cost, node) or None


def _offer(edits: Edits, front: Front, state: int, cost: int, node: int, edit) -> None:
    held = front[state]
    if held is not None and held[0] < cost:
        return
    offered = (cost, edits.add(node, edit))
    if edits.better(offered, held):
        front[state] = offered


def _inserted(edits: Edits, front: Front) -> Front:
    """The front after any inserts; a user first, then an assistant, since a full turn changes no state."""
    out = list(front)
    for state in (_START, _SYSTEM, _ASSISTANT):
        if front[state] is not None:
            _offer(edits, out, _USER, front[state][0] + INSERT, front[state][1], "I")
    if out[_USER] is not None:
        _offer(edits, out, _ASSISTANT, out[_USER][0] + INSERT, out[_USER][1], "I")
    return out


def _stepped(edits: Edits, front: Front, role: str, fault: int) -> Front:
    """The front after one row, inserts before it included."""
    out: Front = [None] * 4
    for state, held in enumerate(_inserted(edits, front)):
        if held is None:
            continue
        cost, node = held
        _offer(edits, out, state, cost + DELETE, node, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        extra = CUT_OFF if fault == TRUNCATED else 0
        for initial, after in _MOVES[state]:
            if role[:1] == initial:
                _offer(edits, out, after, cost + extra, node, "K")
            elif initial in _NAMES:
                _offer(edits, out, after, cost + extra + REROLE, node, "R")
    return out


def _closed(edits: Edits, front: Front) -> tuple[int, int, int] | None:
    """(cost, node, closing inserts) of the best way to end here."""
    best = None
    for state, held in enumerate(front):
        if held is None:
            continue
        count = _CLOSING[state]
        node = held[1]
        for _ in range(count):
            node = edits.add(node, "I" if edits.depth[node] == 0 or isinstance(edits.edit[node], str) else -1)
        ended = (held[0] + INSERT * count, node)
        if best is None or edits.better(ended, best[:2]):
            best = (*ended, count)
    return best


def _applied(audit: str, rows: list[tuple[str, str]], state: int) -> Iterator[str]:
    """The repaired lines that an audit makes of rows, from a state on."""
    at = 0
    for edit in audit:
        if edit != "I":
            role, words = rows[at]
            at += 1
        if edit == "D":
            continue
        if edit != "K":
            role, words = _NAMES[_MOVES[state][-1][0]], "" if edit == "I" else words
        state = dict(_MOVES[state])[role[:1]]
        yield f"{role}:{words}"


@dataclass
class Chunk:
    """Rows of one conversation that follow each other, and what their neighbours need of them."""

    conv_id: object
    rows: list[tuple[str, str]] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    illegal: int = 0
    chars: int = 0

    def add(self, turn: int | None, role: str, words: str, fault: int) -> None:
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + role[:1] not in _LEGAL
        self.rows.append((role, words))
        self.faults.append(fault)
        self.chars += len(words) + len(role)

    def full(self) -> bool:
        return len(self.rows) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def fronts(self, edits: Edits, starts: list[int]) -> list[Front]:
        out = []
        for start in starts:
            front: Front = [None] * 4
            front[start] = (0, 0)
            for (role, _), fault in zip(self.rows, self.faults):
                front = _stepped(edits, front, role, fault)
            out.append(front)
        return out

    def counted(self) -> dict:
        return {"blank": self.faults.count(BLANK), "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(TRUNCATED), "illegal": self.illegal}

    def repaired(self) -> dict:
        """The result of a conversation that is this chunk alone."""
        edits = Edits()
        cost, node, _ = _closed(edits, self.fronts(edits, [_START])[0])
        audit = "".join(edits.spelled(node))
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        sha = hashlib.sha256("\n".join(_applied(audit, self.rows, _START)).encode()).hexdigest()
        return self.counted() | {"gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": sha, "open": False}

    def summary(self) -> dict:
        """Costs, orders and audits for each entry and exit state, and the rows themselves."""
        edits = Edits()
        costs, orders, audits = [], [], []
        for front in self.fronts(edits, list(range(4))):
            nodes = sorted((f[1] for f in front if f), key=cmp_to_key(lambda a, b: -1 if edits.less(a, b) else 1))
            costs += [f[0] if f else None for f in front]
            orders += [nodes.index(f[1]) if f else None for f in front]
            audits += ["".join(edits.spelled(f[1])) if f else None for f in front]
        return self.counted() | {
            "open": True, "costs": costs, "orders": orders, "audits": audits, "roles": [r for r, _ in self.rows], "texts": [t for _, t in self.rows],
            "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns,
            "first_role": self.rows[0][0][:1], "last_role": self.rows[-1][0][:1],
        }


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after damage: a dropped row is gone, a repeated one has two copies."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.pmod(F.crc32(key), F.lit(20))
    words, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return conversations.withColumn("_kind", kind).filter("_kind <> 0").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(words, ".!?", "")).otherwise(words).alias("text"),
        F.when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def marked(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number of copies, and the fault of the first of them.

    Where a role and a text first stand is an aggregate joined back, so a text that a
    conversation repeats without end is combined before the shuffle.
    """
    one = stage_table(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.sha2("text", 256)), "rows")
    first = one.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("untimed")
    )
    held = one.join(first.hint("merge"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    bare = F.rtrim("text", F.lit(SPACES))
    again = F.when(F.col("untimed"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    fault = F.when(bare == "", BLANK).when(again, DUPLICATE).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    return held.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


_CHUNKED = [
    T.StructField("place", T.LongType()), T.StructField("open", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("orders", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())),
    T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("first_turn", T.LongType()), T.StructField("last_turn", T.LongType()), T.StructField("turns", T.LongType()),
    T.StructField("first_role", T.StringType()), T.StructField("last_role", T.StringType()),
]


def _arrow(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turn, role, text, fault) of every row and copy, in order."""
    for batch in batches:
        for conv, turn, role, words, copies, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault"))):
            yield conv, turn, role, words, fault
            for _ in range(copies - 1):
                yield conv, turn, role, words, BLANK if fault == BLANK else DUPLICATE


def _slices(schema: T.StructType) -> Callable:
    """Turns a sorted slice into repaired conversations and open chunks.

    The first and the last conversation of a slice may go on in its neighbours, so they
    stay open, as does one of several chunks.
    """

    def chunks(rows: Iterator[tuple]) -> Iterator[tuple[Chunk, bool]]:
        """Chunks in order, each with whether it starts its conversation here."""
        held, starts = None, True
        for conv, turn, role, words, fault in rows:
            if held is None or conv != held.conv_id or held.full():
                if held is not None:
                    yield held, starts
                starts = held is None or conv != held.conv_id
                held = Chunk(conv)
            held.add(turn, role, words, fault)
        if held is not None:
            yield held, starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, size = TaskContext.get().partitionId() << 33, [], 0
        edge = True
        for (chunk, starts), after in _with_next(chunks(_copies(batches))):
            whole = not edge and starts and after is not None and after[1]
            edge = edge and after is not None and not after[1]
            out.append({"conv_id": chunk.conv_id, "place": place} | (chunk.repaired() if whole else chunk.summary()))
            place, size = place + 1, size + chunk.chars
            if size > CHUNK_CHARS or len(out) >= 1000:
                yield _arrow(out, schema)
                out, size = [], 0
        if out:
            yield _arrow(out, schema)

    return run


def _with_next(items: Iterator) -> Iterator[tuple]:
    """(item, the one after it or None)."""
    held = next(items, None)
    while held is not None:
        after = next(items, None)
        yield held, after
        held = after


def _combine(chunks: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of every chunk of one conversation, with the conversation's counts on its last."""
    chunks = chunks.sort_values("place", ignore_index=True)
    edits = Edits()
    front: Front = [None] * 4
    front[_START] = (0, 0)
    for costs, orders in zip(chunks["costs"], chunks["orders"]):
        out: Front = [None] * 4
        for start, held in enumerate(front):
            for end in range(4):
                cost = costs[4 * start + end]
                if held is not None and not pd.isna(cost):
                    _offer(edits, out, end, held[0] + int(cost), held[1], 4 * int(orders[4 * start + end]) + end)
        front = out
    cost, node, closing = _closed(edits, front)
    ends = [e % 4 for e in edits.spelled(node)[: len(chunks)]]
    timed = chunks[chunks["turns"] > 0]
    last = timed["last_turn"].shift()
    turns = int(timed["turns"].sum()) - int((timed["first_turn"] == last).sum())
    gaps = int(timed["last_turn"].iloc[-1]) - int(timed["first_turn"].iloc[0]) + 1 - turns if len(timed) else 0
    borders = chunks["last_role"].shift().iloc[1:] + chunks["first_role"].iloc[1:]
    out = pd.DataFrame({"place": chunks["place"], "entry": [_START, *ends[:-1]], "exit": ends, "closing": 0})
    out.loc[len(out) - 1, "closing"] = closing
    found = {"gaps": gaps, "illegal": int(chunks["illegal"].sum() + (~borders.isin(_LEGAL)).sum()), "cost": cost}
    found |= {c: int(chunks[c].sum()) for c in ("blank", "duplicate", "truncated")}
    return out.assign(**found)


def _streamed(schema: T.StructType) -> Callable:
    """One row per conversation from its chunks in order; lines go into the hash as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, audit, sha, begun = None, [], None, False

        def out() -> pa.RecordBatch:
            return _arrow([{c: held[c] for c in ("conv_id", *COUNTS)} | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema)

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if held is None or row["conv_id"] != held["conv_id"]:
                    if held is not None:
                        yield out()
                    audit, sha, begun = [], hashlib.sha256(), False
                held = row
                part = row["chosen"] + "I" * row["closing"]
                audit.append(part)
                for line in _applied(part, list(zip(row["roles"], row["texts"])), row["entry"]):
                    sha.update(b"\n" * begun + line.encode())
                    begun = True
        if held is not None:
            yield out()

    return run


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation after damage."""
    conv = T.StructField("conv_id", conversations.schema["conv_id"].dataType)
    result = T.StructType([conv, *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    chunked = T.StructType([conv, *_CHUNKED])
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    rows = stage_table(marked(damaged(conversations)), "marked")
    done = stage_table(rows.orderBy(*order).mapInArrow(_slices(chunked), chunked), "slices")
    summaries = done.filter("open").drop("audits", "roles", "texts", "audit", "repaired_sha256", "open", "gaps", "cost")
    paths = summaries.groupBy("conv_id").applyInPandas(
        _combine, "place long, entry long, exit long, closing long, " + ", ".join(f"{c} long" for c in ("gaps", "illegal", "cost", "blank", "duplicate", "truncated"))
    )
    chosen = done.filter("open").select("conv_id", "place", "audits", "roles", "texts").join(paths, "place").withColumn(
        "chosen", F.get("audits", (F.col("entry") * 4 + F.col("exit")).cast("int"))
    )
    streamed = chosen.drop("audits").repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_streamed(result), result)
    found = done.filter(~F.col("open")).select(*result.names).unionByName(streamed).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    fill = {**{c: F.coalesce(c, F.lit(0)) for c in COUNTS}, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(EMPTY_HASH))}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumns(fill).select(*result.names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: damage, faults and repair of every conversation."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


_CRC = "list_reduce(list_prepend(4294967295, list_transform(string_split({s}, ''), lambda c: ascii(c)::BIGINT)), lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"


def _sql_step() -> str:
    """Best of staying by deletion and the moves into each state, as {cost, audit, lines} structs, which compare in that order."""
    grown = lambda s, c, e, lines="''": f"{{'c': {s}.c + {c}, 'a': {s}.a || '{e}', 't': {s}.t || {lines}}}"
    kept = lambda s, i: f"left(role, 1) = '{i}' AND fault NOT IN (1, 2) THEN " + grown(s, "cut", "K", "chr(10) || role || ':' || text")
    cast = lambda s, i: f"left(role, 1) <> '{i}' AND fault NOT IN (1, 2) THEN " + grown(s, "cut + 1", "R", f"chr(10) || '{_NAMES[i]}:' || text")
    moves = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}
    out = []
    for state, sources in moves.items():
        parts = [f"CASE WHEN b{state} IS NOT NULL THEN {grown(f'b{state}', 2, 'D')} END"]
        for source, initial in sources:
            for rule in (kept, cast) if initial in _NAMES else (kept,):
                parts.append(f"CASE WHEN b{source} IS NOT NULL AND {rule(f'b{source}', initial)} END")
        out.append(f"least({', '.join(parts)}, NULL) AS s{state}")
    return ", ".join(out)


_INS = lambda s, n: f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + 5, 'a': {s}.a || 'I', 't': {s}.t || chr(10) || '{n}:'}} END"
_B2 = f"least(s2, {_INS('s0', 'user')}, {_INS('s1', 'user')}, {_INS('s3', 'user')})"

SQL = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor({_CRC.format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(1, 3) r(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS same
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN same > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
  FROM faulty GROUP BY conv_id
), states AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i, {_sql_step()} FROM (
    SELECT *, least(s3, {_INS('b2', 'assistant')}) AS b3 FROM (
      SELECT f.conv_id, f.i, f.role, f.text, f.fault, CASE WHEN f.fault = 3 THEN 5 ELSE 0 END AS cut, s0 AS b0, s1 AS b1, {_B2} AS b2, s3
      FROM states s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1))
), ended AS (
  SELECT conv_id, least(s0, least(s3, {_INS('b2', 'assistant')})) AS best
  FROM (SELECT s.conv_id, s0, s3, {_B2} AS b2 FROM states s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.rows = s.i)
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""
