"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's rows are audited (gaps in the turn numbers, blank, repeated and
truncated texts, illegal neighbours) and edited at least cost until the initials
of its roles read ``(s?(ua)+)?``: a row is kept, given another role, or deleted,
and empty turns may be inserted.  What is legal next depends on four states:
nothing yet, or the initial of the last turn left.  An edit and the state before
it determine the state after it, so an audit (the edits' initials in order)
determines the repaired conversation.

A row, or any run of rows, is a 4 by 4 table: from each state to each state the
least cost, and the order of the ASCII-least audits among those from one state.
Such tables compose.  A repair is found in linear space (Hirschberg, 1975): the
forward vector from the state before, and the backward vector from the state
after, meet in the middle of the run; of the states where they make the least
cost, the one with the least audit before it is the crossing; both halves are
repaired likewise.  Audits of the same rows up to different states are never
prefixes of each other (a row adds some I and then one of D, K and R), so that
the audit before a crossing decides alone.

Across the cluster: rows are range-partitioned by conversation and turn.  A
conversation that lies inside a partition is repaired there.  One that a
partition's edge cuts, or of more than ``PIECE_ROWS`` rows, is a sequence of
pieces.  Their tables are composed up a tree (pieces of a partition, then
partitions in groups of ``FAN``), which gives the cost; crossings are then chosen
down the same tree by the same divide and conquer, and each piece is repaired by
itself.  So a conversation may hold any share of all rows.

Defined results.  A null role or text is one space.  Rows are ordered by ``turn``
(null first), then role, then text; rows that repeat are repetitions.  Rows with
a null ``conv_id`` are one conversation.  A role counts by its first character.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, small_side, write_table

#: States: nothing yet, or the initial of the last turn that is left.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state that the next user or assistant turn leads to, and the initials that lead to a state.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: White space: U+0020 and U+0009 to U+000D (fixed value).
SPACES = " \t\n\x0b\x0c\r"
#: Rows and text bytes of a piece at most (a longer row is a piece), bytes of a partition, children of a node of the tree.
PIECE_ROWS, PIECE_BYTES, PART_BYTES, FAN = 4096, 8 << 20, 32 << 20, 256

# --- tables of edits --------------------------------------------------------


@lru_cache(maxsize=None)
def tokens(initial: str, forced: bool, truncated: bool) -> tuple:
    """From each state to each state the cheapest edits of a row, (cost, letters), or None.

    ``forced``: the row has to be deleted.  Insertions stand before the row.
    """
    best: list[list] = [[None] * 4 for _ in STATES]
    for before in STATES:
        state = before
        for k in range(3):  # two insertions lead back to the role there was
            ways = [(state, DELETE, "D")]
            if not forced:
                extra = TRUNCATED * truncated
                if INITIAL.get(initial) == FOLLOWS[state] or initial == "s" and state == START:
                    ways.append((INITIAL[initial], extra, "K"))
                ways.append((FOLLOWS[state], REROLE + extra, "R"))
            for after, cost, letter in ways:
                way = (cost + INSERT * k, "I" * k + letter)
                if best[before][after] is None or way < best[before][after]:
                    best[before][after] = way
            state = FOLLOWS[state]
    return tuple(map(tuple, best))


#: From each state the edits that make a legal end.
ENDINGS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}


def ranked(keys: list) -> list:
    """Each key's place among the keys; None stays."""
    order = {k: i for i, k in enumerate(sorted(k for k in keys if k is not None))}
    return [None if k is None else order[k] for k in keys]


@lru_cache(maxsize=None)
def table_of(initial: str, forced: bool, truncated: bool) -> tuple:
    """A row's table: from each state to each state (cost, place of the audit), or None."""
    out = []
    for ways in tokens(initial, forced, truncated):
        places = ranked([w and w[1] for w in ways])
        out.append(tuple(None if w is None else (w[0], p) for w, p in zip(ways, places, strict=True)))
    return tuple(out)


def ahead(vector: tuple, table: tuple) -> tuple:
    """(cost, place of the audit) for each state behind ``table``, from those before it."""
    best = []
    for after in STATES:
        ways = [(v[0] + row[after][0], v[1], row[after][1]) for v, row in zip(vector, table, strict=True) if v and row[after]]
        best.append(min(ways) if ways else None)
    places = ranked([b and b[1:] for b in best])
    return tuple(None if b is None else (b[0], p) for b, p in zip(best, places, strict=True))


def back(costs: tuple, table: tuple) -> tuple:
    """The least cost from each state before ``table``, from those behind it."""
    out = []
    for row in table:
        ways = [c + w[0] for w, c in zip(row, costs, strict=True) if w and c is not None]
        out.append(min(ways) if ways else None)
    return tuple(out)


def at(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in STATES)


class Run:
    """Tables one after another.

    Vectors less their least cost recur, and rows have few tables, so a worker
    remembers the steps between them (``of_rows``).
    """

    _AHEAD: dict = {}
    _BACK: dict = {}

    def __init__(self, tables: list[tuple], of_rows: bool = True):
        self.tables, self.of_rows = tables, of_rows

    def _ahead(self, vector: tuple, table: tuple) -> tuple[int, tuple]:
        key = (vector, id(table))
        if not self.of_rows or (known := self._AHEAD.get(key)) is None:
            moved = ahead(vector, table)
            least = min(x[0] for x in moved if x)
            known = least, tuple(x and (x[0] - least, x[1]) for x in moved)
            if self.of_rows:
                self._AHEAD[key] = known
        return known

    def _back(self, costs: tuple, table: tuple) -> tuple:
        key = (costs, id(table))
        if not self.of_rows or (known := self._BACK.get(key)) is None:
            moved = back(costs, table)
            least = min(x for x in moved if x is not None)
            known = tuple(None if x is None else x - least for x in moved)
            if self.of_rows:
                self._BACK[key] = known
        return known

    def forward(self, low: int, high: int, state: int) -> tuple[int, tuple]:
        total, vector = 0, at(state)
        for t in self.tables[low:high]:
            cost, vector = self._ahead(vector, t)
            total += cost
        return total, vector

    def backward(self, low: int, high: int, state: int) -> tuple:
        costs = tuple(0 if s == state else None for s in STATES)
        for t in reversed(self.tables[low:high]):
            costs = self._back(costs, t)
        return costs

    def table(self) -> tuple:
        """The table of the whole run."""
        out = []
        for s in STATES:
            total, vector = self.forward(0, len(self.tables), s)
            out.append(tuple(None if v is None else (total + v[0], v[1]) for v in vector))
        return tuple(out)

    def ending(self) -> tuple[int, int]:
        """The least cost from nothing to a legal end, and the state before its last insertions."""
        total, vector = self.forward(0, len(self.tables), START)
        cost, _, state = min((v[0] + ENDINGS[s][0], v[1], s) for s, v in enumerate(vector) if v)
        return total + cost, state

    def states(self, entry: int, leave: int) -> list[int]:
        """The states before, between and behind the tables on the best way from ``entry`` to ``leave``."""
        out = [entry] * (len(self.tables) + 1)
        out[-1] = leave
        spans = [(0, len(self.tables))]
        while spans:
            low, high = spans.pop()
            if high - low > 1:
                middle = (low + high) // 2
                _, before = self.forward(low, middle, out[low])
                behind = self.backward(middle, high, out[high])
                out[middle] = min((v[0] + c, v[1], s) for s, (v, c) in enumerate(zip(before, behind, strict=True)) if v and c is not None)[2]
                spans += [(low, middle), (middle, high)]
        return out


# --- rows -------------------------------------------------------------------


def faults(roles: list[str], texts: list[str], repeated: list[bool]) -> list[str]:
    """The first fault of each row: blank, duplicate, truncated, or none."""
    out = []
    for text, again in zip(texts, repeated, strict=True):
        bare = text.rstrip(SPACES)
        out.append("blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else "")
    return out


def tables(roles: list[str], found: list[str]) -> list[tuple]:
    return [table_of(r[:1] if r[:1] in INITIAL else "", f in ("blank", "duplicate"), f == "truncated") for r, f in zip(roles, found, strict=True)]


def edited(roles: list[str], texts: list[str], found: list[str], states: list[int], last: bool) -> tuple[str, list[str], list[str]]:
    """The audit, and the roles and texts that are left, for rows passed in ``states``."""
    audit, new_roles, new_texts = [], [], []

    def insert(letters: str, state: int) -> int:
        for _ in range(letters.count("I")):
            state = FOLLOWS[state]
            new_roles.append(ROLE[state])
            new_texts.append("")
        return state

    for i, (role, text, fault) in enumerate(zip(roles, texts, found, strict=True)):
        initial = role[:1] if role[:1] in INITIAL else ""
        letters = tokens(initial, fault in ("blank", "duplicate"), fault == "truncated")[states[i]][states[i + 1]][1]
        insert(letters, states[i])
        if letters[-1] != "D":
            new_roles.append(role if letters[-1] == "K" else ROLE[states[i + 1]])
            new_texts.append(text)
        audit.append(letters)
    if last:
        insert(ENDINGS[states[-1]][1], states[-1])
        audit.append(ENDINGS[states[-1]][1])
    return "".join(audit), new_roles, new_texts


def illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))


def repeats(roles: list[str], texts: list[str]) -> list[bool]:
    """Whether role and text of a row are those of an earlier one."""
    seen: set = set()
    out = []
    for key in zip(roles, texts, strict=True):
        out.append(key in seen)
        seen.add(key)
    return out


def turn_facts(turns: list) -> tuple:
    """The least and the greatest turn, and how many there are, in ascending rows (nulls first)."""
    real = [t for t in turns if t is not None]
    return (real[0], real[-1], 1 + sum(a != b for a, b in zip(real, real[1:], strict=False))) if real else (None, None, 0)


def repair(roles: list[str], texts: list[str], found: list[str]) -> tuple[int, str, list[str], list[str]]:
    """Cost, audit, roles and texts of the best repair of a conversation."""
    run = Run(tables(roles, found))
    cost, leave = run.ending()
    return cost, *edited(roles, texts, found, run.states(START, leave), True)


# --- over tables ------------------------------------------------------------

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _result_type(conv: T.DataType) -> T.StructType:
    """A conversation, or a part of one: counts (whole at part 0, else 0), audit, and the turns left."""
    return T.StructType([T.StructField("conv_id", conv), T.StructField("part", T.LongType()), T.StructField("whole", T.BooleanType()),
                         *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("audit", T.StringType()),
                         T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])


_PIECE = [("piece", pa.int64()), ("turns", pa.list_(pa.int64())), ("in_roles", pa.list_(pa.string())), ("in_texts", pa.list_(pa.string()))]


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
             "array<bigint>": pa.list_(pa.int64())}
    return [kinds[f.dataType.simpleString()] for f in schema]


def _gather(rows: DataFrame, partitions: int, piece_rows: int) -> DataFrame:
    """Results of the conversations that lie inside a partition, and pieces of the others."""
    result = _result_type(rows.schema["conv_id"].dataType)
    schema = T.StructType([*result.fields, T.StructField("piece", T.LongType()), T.StructField("turns", T.ArrayType(T.LongType())),
                           T.StructField("in_roles", T.ArrayType(T.StringType())), T.StructField("in_texts", T.ArrayType(T.StringType()))])
    names, n_result = schema.fieldNames(), len(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, types = TaskContext.get().partitionId(), None
        held: tuple | None = None  # the conversation being read
        turns, roles, texts, size, pieces, first = [], [], [], 0, 0, True
        out: list[tuple] = []
        weight = 0  # of the rows in ``out``

        def piece() -> None:
            nonlocal turns, roles, texts, size, pieces, weight
            weight += size
            out.append((held[0], *[None] * (n_result - 1), block << 24 | pieces, turns, roles, texts))
            turns, roles, texts, size, pieces = [], [], [], 0, pieces + 1

        def close(edge: bool) -> None:
            nonlocal turns, roles, texts, size, pieces, weight
            if edge or pieces:
                if turns:
                    piece()
            else:
                weight += size
                found = faults(roles, texts, repeats(roles, texts))
                low, high, n = turn_facts(turns)
                cost, audit, left, kept = repair(roles, texts, found)
                counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
                out.append((held[0], 0, True, high - low + 1 - n if n else 0, *counts, illegal(roles), cost, audit, left, kept, *[None] * 4))
            turns, roles, texts, size, pieces = [], [], [], 0, 0

        for batch in batches:
            types = [batch.column(0).type, *_arrow(schema)[1:]]
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] != conv:
                    close(edge=first)
                    first = False
                elif len(turns) >= piece_rows or size >= PIECE_BYTES:
                    piece()
                held = (conv,)
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                size += len(text)
                if weight > PIECE_BYTES:
                    yield _batch(out, types, names)
                    out, weight = [], 0
            if out:
                yield _batch(out, types, names)
                out, weight = [], 0
        if held is not None:
            close(edge=True)
            yield _batch(out, types, names)

    order = ["conv_id", "turn", "role", "text", "rid"]
    keyed = rows.withColumn("rid", F.monotonically_increasing_id())  # rows that repeat may lie in several partitions
    ordered = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return ordered.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _flat(table: tuple) -> tuple[list, list]:
    cells = [c for row in table for c in row]
    return [c and c[0] for c in cells], [c and c[1] for c in cells]


def _square(costs: list, places: list) -> tuple:
    cells = [None if c is None else (c, p) for c, p in zip(costs, places, strict=True)]
    return tuple(tuple(cells[4 * s:4 * s + 4]) for s in STATES)


#: What is known of a run of rows.
_NODE = ("low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
         "costs array<long>, places array<long>")
_NODE_NAMES = [x.split()[0] for x in _NODE.split(", ")]
_NODE_TYPES = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.list_(pa.int64())] * 2


def _joined(nodes: list[dict]) -> tuple:
    """What is known of runs one after another, from what is known of each."""
    real = [n for n in nodes if n["turns"]]
    turns = sum(n["turns"] for n in real) - sum(a["high"] == b["low"] for a, b in zip(real, real[1:], strict=False))
    table = Run([_square(n["costs"], n["places"]) for n in nodes], of_rows=False).table()
    sums = [sum(n[c] for n in nodes) for c in ("blank", "duplicate", "truncated", "illegal")]
    sums[3] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(nodes, nodes[1:], strict=False))
    return (real[0]["low"] if real else None, real[-1]["high"] if real else None, turns, *sums, nodes[0]["first"], nodes[-1]["last"], *_flat(table))


def _grouped(nodes: DataFrame, shift: int) -> DataFrame:
    """The nodes one level up: a node for each conversation and ``key >> shift``."""
    conv = nodes.schema["conv_id"]

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["key"])
        row = (rows[0]["conv_id"], rows[0]["parent"], *_joined(rows))
        return pa.Table.from_batches([_batch([row], [group.column("conv_id").type, pa.int64(), *_NODE_TYPES], ["conv_id", "key", *_NODE_NAMES])])

    schema = T.StructType([conv, T.StructField("key", T.LongType()), *T.StructType.fromDDL(_NODE).fields])
    return nodes.withColumn("parent", F.shiftright("key", shift)).groupBy("conv_id", "parent").applyInArrow(run, schema)


def _ways(nodes: DataFrame, parents: DataFrame, shift: int) -> DataFrame:
    """conv_id, key, entry, leave and last for each node, from those of the nodes one level up."""
    conv = nodes.schema["conv_id"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, up = sorted(left.to_pylist(), key=lambda r: r["key"]), right.to_pylist()[0]
        states = Run([_square(r["costs"], r["places"]) for r in rows], of_rows=False).states(up["entry"], up["leave"])
        out = [(r["conv_id"], r["key"], states[i], states[i + 1], up["last"] and i == len(rows) - 1) for i, r in enumerate(rows)]
        return pa.Table.from_batches([_batch(out, [left.column("conv_id").type, pa.int64(), pa.int32(), pa.int32(), pa.bool_()],
                                             ["conv_id", "key", "entry", "leave", "last"])])

    schema = T.StructType([conv, *T.StructType.fromDDL("key long, entry int, leave int, last boolean").fields])
    below = nodes.withColumn("parent", F.shiftright("key", shift)).groupBy("conv_id", "parent")
    return below.cogroup(parents.groupBy("conv_id", "key")).applyInArrow(run, schema)


def _repeated_rows(pieces: DataFrame) -> DataFrame:
    """piece and the places of its rows whose role and text an earlier row of the conversation has."""
    own = F.transform(F.arrays_zip("in_roles", "in_texts"), lambda x: F.unhex(F.sha2(F.concat(
        F.length(x["in_roles"]).cast("string"), F.lit(":"), x["in_roles"], x["in_texts"]), 256)))
    rows = write_table(pieces.select("conv_id", "piece", F.posexplode(own).alias("i", "print")), "structure-prints")
    place = F.struct("piece", "i")
    first = rows.groupBy("conv_id", "print").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written first: then both sides of the join are plain shuffles, and Spark splits a text that many rows have.
    first = write_table(first.select(F.col("conv_id").alias("c"), "print", "first"), "structure-firsts")
    again = rows.join(first, (rows["conv_id"].eqNullSafe(first["c"])) & (rows["print"] == first["print"])).filter(place != F.col("first"))
    return again.groupBy("piece", "conv_id").agg(F.collect_list("i").alias("again"))


def _long(pieces: DataFrame, blocks: int) -> DataFrame:
    """Results of the conversations in several pieces, a row for each piece."""
    conv = pieces.schema["conv_id"]
    again = write_table(_repeated_rows(pieces), "structure-repeats")
    marked = pieces.join(again.withColumnsRenamed({"conv_id": "c", "piece": "p"}),
                         (F.col("piece") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", F.col("piece").alias("key"), "turns", "in_roles", "in_texts", F.coalesce("again", F.array().cast("array<int>")).alias("again"))
    marked = write_table(marked, "structure-pieces")

    def facts(row: dict) -> tuple:
        marks = set(row["again"])
        return row["in_roles"], row["in_texts"], faults(row["in_roles"], row["in_texts"], [i in marks for i in range(len(row["turns"]))])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                roles, _, found = facts(row)
                counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
                out.append((row["conv_id"], row["key"], *turn_facts(row["turns"]), *counts, illegal(roles), roles[0][:1], roles[-1][:1],
                            *_flat(Run(tables(roles, found)).table())))
            yield _batch(out, [batch.column("conv_id").type, pa.int64(), *_NODE_TYPES], ["conv_id", "key", *_NODE_NAMES])

    # Up the tree: pieces, partitions, groups of partitions, and at last one node a conversation.
    node_type = T.StructType([conv, T.StructField("key", T.LongType()), *T.StructType.fromDDL(_NODE).fields])
    levels = [write_table(marked.mapInArrow(describe, node_type), "structure-nodes")]
    shifts, left = [24], blocks
    while left > 1:
        shifts.append(FAN.bit_length() - 1)
        left = -(-left // FAN)
    for shift in shifts:
        levels.append(write_table(_grouped(levels[-1], shift), "structure-nodes"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cost, leave = Run([_square(row["costs"], row["places"])], of_rows=False).ending()
                gaps = row["high"] - row["low"] + 1 - row["turns"] if row["turns"] else 0
                out.append((row["conv_id"], row["key"], START, leave, True, gaps, row["blank"], row["duplicate"], row["truncated"], row["illegal"], cost))
            yield _batch(out, [batch.column("conv_id").type, pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 6],
                         ["conv_id", "key", "entry", "leave", "last", *_COUNTS])

    top = T.StructType([conv, *T.StructType.fromDDL("key long, entry int, leave int, last boolean, " + ", ".join(f"{c} long" for c in _COUNTS)).fields])
    whole = write_table(levels[-1].mapInArrow(ends, top), "structure-wholes")
    # Down the tree: the states in which every node begins and ends.
    ways = whole.select("conv_id", "key", "entry", "leave", "last")
    for nodes, shift in zip(reversed(levels[:-1]), reversed(shifts), strict=True):
        ways = write_table(_ways(nodes, ways, shift), "structure-ways")

    # The counts stand at a conversation's first part.
    firsts = levels[0].groupBy("conv_id").agg(F.min("key").alias("key"))
    counts = firsts.join(whole.select(F.col("conv_id").alias("c"), *_COUNTS), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    # A key of a piece may serve two conversations' ends in a partition: both columns tell it.
    same = lambda a, b: (a["key"] == b["key"]) & a["conv_id"].eqNullSafe(b["conv_id"])
    ways = write_table(ways.join(counts, same(ways, counts), "left").select(
        ways["conv_id"].alias("c"), ways["key"].alias("k"), "entry", "leave", "last", *[F.coalesce(x, F.lit(0)).alias(x) for x in _COUNTS]), "structure-ways")
    both = marked.join(small_side(ways), (F.col("key") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c")))
    result = _result_type(conv.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                roles, texts, found = facts(row)
                states = Run(tables(roles, found)).states(row["entry"], row["leave"])
                out.append((row["conv_id"], row["key"], False, *[row[c] for c in _COUNTS], *edited(roles, texts, found, states, row["last"])))
            yield _batch(out, [batch.column("conv_id").type, *_arrow(result)[1:]], result.fieldNames())

    return both.drop("k", "c").mapInArrow(run, result)


def repair_structure(turns: DataFrame, part_bytes: int = PART_BYTES, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Every conversation of ``turns`` (conv_id, turn, role, text), audited and repaired.

    Returns conv_id, part, whole, gaps, blank, duplicate, truncated, illegal, cost,
    audit, roles and texts.  A conversation is one row (``whole``) or, where it is
    long or a partition's edge cuts it, several: their audits, roles and texts in
    order of ``part`` make up the whole, and the counts stand at the first.
    """
    spark = turns.sparkSession
    ship_package(spark)
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), full("role"), full("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    gathered = write_table(_gather(rows, partitions, piece_rows), "structure-gathered")
    result = _result_type(rows.schema["conv_id"].dataType).fieldNames()
    done = gathered.filter("piece is null").select(result)
    pieces = gathered.filter("piece is not null").select("conv_id", *[n for n, _ in _PIECE])
    return done if pieces.isEmpty() else done.unionByName(_long(pieces, partitions))


def digests(repaired: DataFrame) -> DataFrame:
    """A row for each conversation: its counts, whole audit, and the digest of its repaired ``role:text`` lines.

    A digest of a conversation in parts is made in one pass over them in order,
    holding one part at a time: SHA-256 can't be made from digests of parts.
    """
    conv = repaired.schema["conv_id"]
    schema = T.StructType([conv, *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("audit", T.StringType()),
                           T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, audit, made, begun, types = None, [], [], None, False, None

        def row() -> tuple:
            return (held[0], *counts, "".join(audit), made.hexdigest())

        for batch in batches:
            types, out = [batch.column("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()], []
            for r in batch.to_pylist():
                if held is None or r["whole"] or held[0] != r["conv_id"]:
                    if held is not None:
                        out.append(row())
                    held, counts, audit, made, begun = (r["conv_id"],), [0] * 6, [], hashlib.sha256(), False
                counts = [a + r[c] for a, c in zip(counts, _COUNTS, strict=True)]
                audit.append(r["audit"])
                for role, text in zip(r["roles"], r["texts"], strict=True):
                    made.update((("\n" if begun else "") + role + ":" + text).encode())
                    begun = True
            if out:
                yield _batch(out, types, schema.fieldNames())
        if held is not None:
            yield _batch([row()], types, schema.fieldNames())

    inside = repaired.filter("whole").mapInArrow(run, schema)
    parts = repaired.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
    return inside.unionByName(parts)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with a fifth and a twentieth of its rows damaged, chosen by a checksum of ``conv_id:turn``:
    dropped, emptied, without sentence ends, repeated, or given the role user."""
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(full("conv_id"), F.lit(":"), full("turn"))) % 20
    bare: Column = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(full("text"), "[.!?]", "")).otherwise(full("text"))
    rows = turns.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(full("role")).alias("role"), bare.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")
