import hashlib
import itertools
import random
import re

import pytest
from conftest import SF_SMALL

from panes.llm import structure
from panes.llm.queries import LLM_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part string, key string, again string, audit string"


def brute(roles, found):
    """The least (cost, audit) over every choice of edits and insertions, and the initials left."""
    best = None
    for edits in itertools.product([k + x for k in ("", "I", "II") for x in "DKR"], repeat=len(roles)):
        for end in ("", "I", "II"):
            cost, options = 5 * len(end), [""]
            for role, fault, edit in zip(roles, found, edits, strict=True):
                cost += 5 * edit.count("I")
                options = [o + i for o in options for i in map("".join, itertools.product("ua", repeat=edit.count("I")))]
                if edit[-1] == "D":
                    cost += 2
                    continue
                if fault in ("blank", "duplicate"):
                    options = []
                    break
                cost += (edit[-1] == "R") + 5 * (fault == "truncated")
                options = [o + x for o in options for x in (role[:1] or "?" if edit[-1] == "K" else "ua")]
            options = [o + i for o in options for i in map("".join, itertools.product("ua", repeat=len(end)))]
            if any(re.fullmatch(r"(s?(ua)+)?", o) for o in options):
                best = min(best or (1 << 30, ""), (cost, "".join(edits) + end))
    return best


def audited(roles, found, piece=None):
    """Cost and audit, as one run or as pieces put together by their tables."""
    rows = structure.tables(roles, found)
    if piece is None:
        run = structure.Run(rows)
        cost, leave = run.ending()
        states = run.states(structure.START, leave)
    else:
        runs = [rows[i:i + piece] for i in range(0, len(rows), piece)]
        above = structure.Run([structure.Run(r).table() for r in runs], of_rows=False)
        cost, leave = above.ending()
        between = above.states(structure.START, leave)
        states = [structure.START]
        for r, a, b in zip(runs, between, between[1:], strict=False):
            states += structure.Run(r).states(a, b)[1:]
    return cost, structure.edited(roles, ["x"] * len(roles), found, states, True)


KINDS = [(r, f) for r in ("system", "user", "assistant", "tool") for f in ("", "truncated")] + [("user", "blank")]


def test_repairs_are_the_cheapest_and_the_least_audits():
    r = random.Random(4)
    every = [list(x) for n in range(3) for x in itertools.product(KINDS, repeat=n)]
    every += [[r.choice(KINDS) for _ in range(3)] for _ in range(60)]
    for rows in every:
        roles, found = [x for x, _ in rows], [f for _, f in rows]
        cost, (audit, left, texts) = audited(roles, found)
        assert (cost, audit) == brute(roles, found), rows
        assert re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for x in left)) and len(left) == len(texts)


def test_pieces_give_what_the_whole_run_gives():
    r = random.Random(6)
    for n in (2, 3, 7, 20, 100, 501):
        for piece in (1, 2, 3, 16, 99):
            rows = [r.choice(KINDS) for _ in range(n)]
            roles, found = [x for x, _ in rows], [f for _, f in rows]
            assert audited(roles, found) == audited(roles, found, piece)


def conversations():
    r = random.Random(9)
    say = lambda: r.choice(["Fine.", "Fine.", "no end", "", " \n", "What? ", "Long text! " * 3, f"n{r.random()}."])
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", None]), say()) for c in range(40) for t in sorted(r.choices(range(12), k=r.randint(1, 9)))]
    rows += [(100, t // 2, r.choice(["user", "assistant", "system"]), f"t{r.randint(0, 400)}.") for t in range(900)]
    rows += [(None, 1, "user", None), (None, None, "assistant", "b."), (101, None, "user", "x."), (101, None, "user", "x."), (102, 1, None, "y"),
             (103, 1, "user", "y" * 200_000), (104, 5, "user", "Same.")]
    return rows + [(105, 7, "user", "Same.")] * 300 + [(105, 9, "assistant", "Last.")]


def plain(rows):
    """A conversation at a time."""
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, own in by.items():
        own.sort()
        roles, texts = [x[2] for x in own], [x[3] for x in own]
        seen, found = set(), []
        for role, text in zip(roles, texts, strict=True):
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            found.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [x[1] for x in own if x[0]]
        # One pass over all rows that remembers every state's least (cost, audit) and what is left.
        best = {0: (0, "", ())}
        for role, text, fault in zip(roles, texts, found, strict=True):
            now = {}
            for state, (cost, audit, left) in best.items():
                ways = [(state, cost + 2, audit + "D", left)]
                if fault not in ("blank", "duplicate"):
                    extra, want = 5 * (fault == "truncated"), {0: 2, 1: 2, 2: 3, 3: 2}[state]
                    if {"s": 1, "u": 2, "a": 3}.get(role[:1]) in ((1, 2) if state == 0 else (want,)):
                        ways.append(({"s": 1, "u": 2, "a": 3}[role[:1]], cost + extra, audit + "K", (left, role, text)))
                    ways.append((want, cost + 1 + extra, audit + "R", (left, {2: "user", 3: "assistant"}[want], text)))
                for after, *way in ways:
                    now[after] = min(now.get(after, (1 << 60, "", ())), tuple(way), key=lambda w: w[:2])
            best = now
        cost, audit, left = min((best[s] for s in (0, 3) if s in best), key=lambda w: w[:2])
        lines = []
        while left:
            left, role, text = left
            lines.append(f"{role}:{text}")
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(x) for x in ("blank", "duplicate", "truncated")],
                  sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)), cost, audit,
                  hashlib.sha256("\n".join(reversed(lines)).encode()).hexdigest())
    return out


COLUMNS = [*structure._COUNTS, "audit", "repaired_sha256"]


@pytest.mark.parametrize(("part_bytes", "piece_rows", "fan"), [(32 << 20, 4096, 256), (3000, 4096, 256), (1500, 5, 2)])
def test_cut_conversations_give_what_one_pass_gives(spark, part_bytes, piece_rows, fan, monkeypatch):
    monkeypatch.setattr(structure, "FAN", fan)
    rows = conversations()
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA).repartition(5)
    repaired = structure.repair_structure(df, part_bytes, piece_rows)
    got = structure.digests(repaired).collect()
    want = plain(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r["conv_id"]], r["conv_id"]


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert structure.repair_structure(none).collect() == [] and structure.digests(structure.repair_structure(structure.damaged(none))).collect() == []


def test_registered_query(spark):
    rows = {r["conv_id"]: r for r in LLM_QUERIES["op11_hirschberg_repair"](spark, SF_SMALL).collect()}
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    import zlib

    left = []
    for t in turns:
        kind = zlib.crc32(f"{t['conv_id']}:{t['turn']}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", t["text"]) if kind == 2 else t["text"]
        left += [(t["conv_id"], t["turn"], "user" if kind == 4 else t["role"], text)] * (kind != 0) * (1 + (kind == 3))
    want = plain(left)
    assert set(rows) == {t["conv_id"] for t in turns}
    for c, r in rows.items():
        assert tuple(r[x] for x in COLUMNS) == want.get(c, (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())), c
