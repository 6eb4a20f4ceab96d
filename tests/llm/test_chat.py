import itertools
import random

import pytest
from conftest import SF_SMALL

from panes.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, part string, edge string, cost string"
LEGAL = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}


def brute(names):
    """The least cost over every choice of roles, merges and insertions."""
    if not names:
        return 0
    known, best = ("system", "user", "assistant"), 1 << 30
    for roles in itertools.product(known, repeat=len(names)):
        base = sum(0 if a == b else chat.RELABEL if a in known else chat.UNKNOWN for a, b in zip(names, roles, strict=True))
        costs = {"": base}
        for r in roles:
            now = {}
            for s, c in costs.items():
                for extra in itertools.chain([()], itertools.product(known, repeat=1), itertools.product(known, repeat=2)):
                    path = [s, *extra, r]
                    if all(x in LEGAL for x in zip(path, path[1:], strict=False)):
                        now[r] = min(now.get(r, 1 << 30), c + chat.INSERT * len(extra))
                if s == r:
                    now[r] = min(now.get(r, 1 << 30), c + chat.MERGE)
            costs = now
        for s, c in costs.items():
            best = min(best, c + {"assistant": 0, "user": chat.INSERT, "system": 2 * chat.INSERT}[s])
    return best


def legal(text):
    roles = [x.split("|>")[0] for x in text.split("<|") if x.split("|>")[0] in chat.ROLES[1:]]
    return not roles or all(x in LEGAL for x in zip(["", *roles], roles, strict=False)) and roles[-1] == "assistant"


def test_repairs_are_the_cheapest():
    names = ("system", "user", "assistant", "tool")
    for n in range(6):
        for seq in itertools.product(names, repeat=n):
            roles = [chat.role_of(x) for x in seq]
            cost, path = chat.repair(roles)
            assert len(path) == n
            if n <= 4:
                assert cost == brute(seq), seq
            assert legal(chat.render(roles, ["t"] * n, path, chat.START, True)[0]), seq


def conversations():
    r = random.Random(9)
    rows = [(c, t, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), f"text {c} {t}") for c in range(40) for t in range(r.randint(1, 9))]
    rows += [(100, t, r.choice(["user", "assistant", "system"]), f"t{t}") for t in range(700)]
    rows += [(None, 1, "user", None), (None, 2, "assistant", ""), (101, None, "user", "x"), (101, None, "user", "x"), (102, 1, None, "<|end|> trick"), (103, 1, "user", "y" * 200_000)]
    return rows


def whole(df):
    """The same by one pass over each conversation."""
    by = {}
    for c, t, role, text, tie in df.selectExpr("conv_id", "turn", "role", "text", "xxhash64(turn, role, text)").collect():
        by.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", tie, role, text))
    out = {}
    for c, own in by.items():
        own.sort(key=lambda x: x[:5])
        roles = [chat.role_of(x[5]) for x in own]
        cost, path = chat.repair(roles, [x[4] for x in own])
        text, edits, opened = chat.render(roles, [x[6] for x in own], path, chat.START, True)
        out[c] = (len(own), cost, text, opened)
    return out


@pytest.mark.parametrize(("part_bytes", "whole_turns"), [(32 << 20, 10_000), (1500, 10_000), (1500, 20)])
def test_split_conversations_give_what_one_pass_gives(spark, part_bytes, whole_turns):
    rows = conversations()
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA).repartition(5)
    out = {}
    for r in sorted(chat.format_chats(df, part_bytes, whole_turns).collect(), key=lambda r: r["part"]):
        n, cost, text, opened, parts = out.get(r["conv_id"], (0, 0, "", 0, 0))
        out[r["conv_id"]] = (n + r["n_turns"], cost + r["cost"], text + r["text"], opened + r["n_out"], parts + 1)
    expected = whole(df)
    assert {k: v[:2] for k, v in out.items()} == {k: v[:2] for k, v in expected.items()}
    for k, v in out.items():
        assert legal(v[2])
        assert v[2:4] == expected[k][2:], k
    if whole_turns == 20:
        assert out[100][4] > 1
    else:
        assert all(v[4] == 1 for v in out.values())


def test_no_conversations_and_whole_table(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    out = {r["conv_id"]: (r["n_turns"], r["cost"], r["text"], r["n_out"]) for r in chat.format_chats(turns).collect()}
    assert out == whole(turns)


def test_rows_do_not_depend_on_partitions(spark):
    """A conversation of 12,000 turns, and short ones, at 1, 4 and 8 shuffle partitions."""
    r = random.Random(2)
    rows = [(1, t, r.choice(["user", "assistant", "system", None]), f"t{t}") for t in range(12_000)] + [(c, t, "user", "x") for c in range(2, 30) for t in range(3)]
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 4, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted((tuple(x) for x in chat.format_chats(df.repartition(n)).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    long = sorted(x for x in found[0] if x[0] == 1)
    assert [x[1:3] for x in long] == [(0, 10_000), (1, 2_000)]
    # The whole cost at the last part.
    want = whole(df.filter("conv_id = 1"))[1]
    assert [x[4] for x in long] == [0, want[1]] and "".join(x[6] for x in long) == want[2]
