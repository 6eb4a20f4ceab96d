"""Chat formatting with minimum-cost repair of turn order.

A conversation is legal if its roles are accepted by the turn automaton: an
optional system turn, then user and assistant in turn, ending with the
assistant.  Other conversations are repaired at least cost by a dynamic programme
over the automaton's states: each turn keeps its role or is relabelled, and then
opens a new turn, is merged into the turn before it, or opens a new turn after
an empty one that is inserted.  The repaired sequence is rendered.

A conversation may hold any share of all rows.  Rows are range-partitioned by
conversation and turn, so a long conversation spreads over partitions; each
partition holds a part of it.  A part's effect on the dynamic programme is a
matrix (least weight from each state to each state).  The driver joins the
matrices of the parts at partition edges, at most two for each partition, and so
learns the states in which every part begins and ends, and its first turn's number;
each part is then repaired by itself.  The result is the one the whole sequence would
have.  A conversation comes out cut at fixed turn numbers (every ``WHOLE_TURNS``),
wherever partitions cut it.

Defined results.  Turns are ordered by ``turn`` (null first), then role, then
a hash of the row.  Rows that repeat are turns that repeat (and are merged).  Null text is
empty text; a null or unknown role may become any role for ``UNKNOWN``.  Rows with
a null ``conv_id`` are one conversation.  Of equally cheap repairs one with more
kept, then more merged turns is taken; of those that are still equal, a hash of
the rows decides, so that the choice does not depend on where a conversation is
cut.  ``<|`` in a text is rendered as ``< |``.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, write_table

#: States: nothing yet, or the role of the turn that is open.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: The automaton: from each state the roles that may open a turn.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of an edit; of giving a turn without a known role one; of an empty turn.
MERGE, RELABEL, UNKNOWN, INSERT = 2, 3, 1, 4
#: A path's weight is its cost, then the sum of its steps' ranks, then of their ties.
COST, RANK, TIE_BITS = 1 << 104, 1 << 80, 40
RANKS = {"keep": 0, "merge": 1, "insert": 2}
NEVER = 1 << 140
#: Text bytes of a partition, and turns of a row of the result.
PART_BYTES, WHOLE_TURNS = 32 << 20, 10_000


def steps(role: int) -> list[tuple[int, int, int, str, int]]:
    """What can be done with a turn of ``role`` (0: unknown): state before, state
    after, cost, kind (keep, merge or insert) and the inserted role."""
    out = []
    for kind in ("keep", "merge", "insert"):
        for before in range(4):
            for after in (SYSTEM, USER, ASSISTANT):
                cost = 0 if after == role else RELABEL if role else UNKNOWN
                if kind == "keep" and after in NEXT[before]:
                    out.append((before, after, cost, kind, 0))
                elif kind == "merge" and after == before:
                    out.append((before, after, cost + MERGE, kind, 0))
                elif kind == "insert":
                    out += [(before, after, cost + INSERT, kind, x) for x in NEXT[before] if after in NEXT[x] and after not in NEXT[before]]
    return out


STEPS = [steps(r) for r in range(4)]


def weight(step: tuple, number: int, tie: int) -> int:
    """What a step adds to a path's weight; ``tie``: a hash of the turn."""
    mixed = (tie ^ (number + 1) * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    return step[2] * COST + RANKS[step[3]] * RANK + ((mixed ^ mixed >> 29) * 0x94D049BB133111EB & (1 << 64) - 1) // (1 << 64 - TIE_BITS)


def role_of(name: str | None) -> int:
    return ROLES.index(name) if name in ROLES[1:] else 0


def ending(state: int) -> list[int]:
    """The empty turns that a conversation in ``state`` still needs."""
    return [] if state in (START, ASSISTANT) else [ASSISTANT] if state == USER else [USER, ASSISTANT]


def forward(roles: list[int], ties: list[int], weights: dict[int, int]) -> tuple[dict[int, int], list[dict[int, tuple]]]:
    """The least weights after the turns, from those before; and each turn's step to each state."""
    back = []
    for role, tie in zip(roles, ties, strict=True):
        now: dict[int, int] = {}
        how: dict[int, tuple] = {}
        for number, step in enumerate(STEPS[role]):
            before, after = step[:2]
            if before in weights and (total := weights[before] + weight(step, number, tie)) < now.get(after, NEVER):
                now[after], how[after] = total, step
        back.append(how)
        weights = now
    return weights, back


def matrix(roles: list[int], ties: list[int]) -> list[list[int]]:
    """The least weight of the turns from each state to each state."""
    return [[forward(roles, ties, {s: 0})[0].get(t, NEVER) for t in range(4)] for s in range(4)]


def closing(state: int) -> int:
    return INSERT * len(ending(state)) * COST


def through(matrices: list[list[list[int]]]) -> list[int]:
    """The states before, between and after parts on the least path to a legal end."""
    weights, back = [0, NEVER, NEVER, NEVER], []
    for m in matrices:
        best = [min((weights[s] + m[s][t], s) for s in range(4)) for t in range(4)]
        back.append([s for _, s in best])
        weights = [w for w, _ in best]
    path = [min((weights[s] + closing(s), s) for s in range(4))[1]]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def repair(roles: list[int], ties: list[int] | None = None, entry: int = START, leave: int | None = None) -> tuple[int, list[tuple]]:
    """Cost and steps of the cheapest repair from state ``entry`` to ``leave``, or to a legal end."""
    weights, back = forward(roles, ties or [0] * len(roles), {entry: 0})
    if leave is None:
        total, leave = min((w + closing(s), s) for s, w in weights.items())
    else:
        total = weights[leave]
    path, state = [], leave
    for how in reversed(back):
        path.append(how[state])
        state = how[state][0]
    return total // COST, path[::-1]


def render(roles: list[int], texts: list[str | None], path: list[tuple], entry: int, last: bool) -> tuple[str, str, int]:
    """The rendered turns, a letter for each edit, and the turns opened.

    A turn is closed by what follows it, so that parts can be put together.
    """
    out, edits, opened, state = [], [], 0, entry

    def begin(role: int) -> None:
        nonlocal opened
        out.append(("<|end|>\n" if state != START else "") + f"<|{ROLES[role]}|>\n")
        opened += 1

    for role, text, (_, after, _, kind, inserted) in zip(roles, texts, path, strict=True):
        if kind == "insert":
            begin(inserted)
            state = inserted
        if kind == "merge":
            out.append("\n\n")
        else:
            begin(after)
        state = after
        out.append((text or "").replace("<|", "< |"))
        edits.append({"keep": "k", "merge": "m", "insert": "i"}[kind] if role == after else {"keep": "r", "merge": "M", "insert": "I"}[kind])
    if last:
        for role in ending(state):
            begin(role)
            edits.append("e")
            state = role
        if state != START:
            out.append("<|end|>\n")
    return "".join(out), "".join(edits), opened


def _parts(rows: DataFrame, partitions: int) -> DataFrame:
    """Conversations, or what a partition has of one, a row each and in order."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("no", T.IntegerType()), T.StructField("conv_id", conv),
                           T.StructField("edge", T.BooleanType()), T.StructField("roles", T.ArrayType(T.StringType())),
                           T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("ties", T.ArrayType(T.LongType())),
                           T.StructField("weights", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, no, held, roles, texts, ties, kind = TaskContext.get().partitionId(), 0, None, [], [], [], None

        def row(edge: bool) -> pa.RecordBatch:
            # As decimal numbers: they have more than 64 bits.
            weights = [str(w) for row in matrix([role_of(r) for r in roles], ties) for w in row] if edge else None
            return pa.RecordBatch.from_arrays([
                pa.array([block], pa.int32()), pa.array([no], pa.int32()), pa.array([held[0]], kind), pa.array([edge]),
                pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string())),
                pa.array([ties], pa.list_(pa.int64())), pa.array([weights], pa.list_(pa.string()))], schema.fieldNames())

        for batch in batches:
            kind = batch.column(0).type
            for c, role, text, tie in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if held is not None and held[0] != c:
                    yield row(edge=no == 0)
                    no, roles, texts, ties = no + 1, [], [], []
                held = (c,)
                roles.append(role)
                texts.append(text)
                ties.append(tie)
        if held is not None:
            yield row(edge=True)

    order = ["conv_id", "turn", "role", "tie", "rid"]
    keyed = rows.withColumns({"tie": F.xxhash64("turn", "role", "text"), "rid": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return ordered.select("conv_id", "role", "text", "tie").mapInArrow(run, schema)


def format_chats(turns: DataFrame, part_bytes: int = PART_BYTES, whole_turns: int = WHOLE_TURNS) -> DataFrame:
    """conv_id, part, n_turns, n_out, cost, edits and text for every conversation.

    ``turns``: conv_id, turn, role, text.  A conversation is one row (part 0); one
    of more than ``whole_turns`` turns is several, of so many turns each, whose
    texts in order of ``part`` make up the whole.  ``edits`` has a letter for each
    turn: kept, merged, inserted before; relabelled alike: r, M, I; e for an empty
    turn at the end.  ``cost`` is the whole conversation's at its last part, 0 at
    the others.
    """
    spark = turns.sparkSession
    ship_package(spark)
    rows = turns.select("conv_id", "turn", "role", "text")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    parts = write_table(_parts(rows, partitions), "chat-parts")
    # At most two parts of each partition are at its edges.
    edges = parts.filter("edge").select("block", "no", "conv_id", F.size("roles").alias("n"), "weights").orderBy("block", "no").collect()
    by: dict = {}
    for e in edges:
        by.setdefault(e["conv_id"], []).append(e)
    bounds = {}
    for own in by.values():
        if len(own) > 1:
            matrices = [[[int(w) for w in e["weights"][4 * s:4 * s + 4]] for s in range(4)] for e in own]
            states, first = through(matrices), 0
            cost = sum(m[s][t] // COST for m, s, t in zip(matrices, states, states[1:], strict=False)) + closing(states[-1]) // COST
            for i, e in enumerate(own):
                bounds[e["block"], e["no"]] = (first, states[i], states[i + 1], i == len(own) - 1, cost)
                first += e["n"]
    shared = spark.sparkContext.broadcast(bounds)
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, *[T.StructField(n, t) for n, t in (
        ("part", T.IntegerType()), ("n_turns", T.LongType()), ("n_out", T.LongType()), ("cost", T.LongType()), ("edits", T.StringType()),
        ("text", T.StringType()), ("place", T.LongType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            out = []
            for conv_id, block, no, names, texts, ties in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "no", "roles", "texts", "ties")), strict=True):
                roles = [role_of(r) for r in names]
                first, entry, leave, last, total = shared.value.get((block, no), (0, START, None, True, None))
                cost, path = repair(roles, ties, entry, leave)
                begin = 0
                while begin < len(roles):  # up to the next fixed turn number
                    end = min(len(roles), begin + whole_turns - (first + begin) % whole_turns)
                    done = last and end == len(roles)
                    text, edits, opened = render(roles[begin:end], texts[begin:end], path[begin:end], path[begin - 1][1] if begin else entry, done)
                    whole = (first + begin) % whole_turns == 0 and (done or (first + end) % whole_turns == 0)
                    out.append((conv_id, (first + begin) // whole_turns, end - begin, opened, (cost if total is None else total) if done else 0, edits, text,
                                None if whole else block))
                    begin = end
            if out:
                columns = zip(zip(*out, strict=True), (batch.column("conv_id").type, *kinds), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], schema.fieldNames())

    done = parts.select("block", "no", "conv_id", "roles", "texts", "ties").mapInArrow(run, schema)
    if not bounds:
        return done.drop("place")
    done = write_table(done, "chat-rendered")
    # Rows that a partition's edge has cut, of at most ``whole_turns`` turns: together again.
    joined = done.filter("place is not null").groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("place", "edits", "text"))).alias("p"), F.sum("n_turns").alias("n_turns"),
        F.sum("n_out").alias("n_out"), F.sum("cost").alias("cost")).select(
        "conv_id", "part", "n_turns", "n_out", "cost",
        F.concat_ws("", F.col("p.edits")).alias("edits"), F.concat_ws("", F.col("p.text")).alias("text"))
    return done.filter("place is null").drop("place").unionByName(joined)
