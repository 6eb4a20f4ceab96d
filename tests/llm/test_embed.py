import math
import random

import numpy as np
from conftest import SF_SMALL

from panes.llm import embed

SCHEMA = "vec_id long, embedding array<float>, label int, digest string, node string, unit string, place string"


def brute(rows, least):
    def unit(v, label):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        return x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())

    units = [unit(v, label) for _, v, label in rows]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= least:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    ids = {}
    for i in range(n):
        ids.setdefault(root(i), []).append(rows[i][0])
    c = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted([(rows[i][0], links[i], c[root(i)], c[root(i)] is None or rows[i][0] == c[root(i)]) for i in range(n)], key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()], key=repr)


def test_edges_and_clusters_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK", 12)
    monkeypatch.setattr(embed, "INTERVAL", 3)
    monkeypatch.setattr(embed, "GROUP", 2)
    monkeypatch.setattr(embed, "LEAF", 8)
    r = random.Random(5)
    rows = []
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    for i in range(260):
        c = r.choice(centres)
        rows.append((i, [float(np.float32(x + r.gauss(0, 0.12))) for x in c], r.choice([0, 0, 0, 1, 2])))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 8, 0), (403, [1.0] * 7 + [None], 0), (404, [1.0] * 7 + [float("nan")], 0),
             (405, [1.0] * 7 + [float("inf")], 0), (406, rows[1][1], None), (407, [1.0], 0), (408, [2.0], 0), (409, [-2.0], 0),
             (None, rows[2][1], rows[2][2]), (None, [9.0, 1.0, 7.0], 5), (5, rows[5][1], rows[5][2]), (410, [1e-30] * 8, 3), (411, [1e30] * 8, 3)]
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA).repartition(4)
    expected = brute(rows, 0.98)
    assert max(n for _, n, *_ in expected) > 40
    assert got(embed.near_vectors(df, 0.98)) == expected
    assert embed.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert got(embed.near_vectors(df, 0.9)) == brute(rows, 0.9)


def test_only_provably_distant_blocks_are_skipped():
    r = np.random.default_rng(1)
    a, b = r.normal(size=(90, 16)), r.normal(size=(70, 16))
    b[:30] = a[:30] + r.normal(size=(30, 16)) * 0.02
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    axes = embed.directions(list(a))
    eps = math.sqrt(2 - 2 * 0.98) + embed.SLACK
    found = set()
    for i, j in embed.join_intervals(a, b, embed.project(a, axes), embed.project(b, axes), 0.98, eps):
        found |= set(zip(i.tolist(), j.tolist(), strict=True))
    x, y = np.nonzero(a @ b.T >= 0.98)
    assert found == set(zip(x.tolist(), y.tolist(), strict=True)) and len(found) >= 25
