import hashlib

import numpy as np
import pytest

from panes.llm import kmeans

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, vector string, dots string, distance string"


def plain(rows, k, rounds, seed, size):
    """All distances anew in every round, in Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
            if max(map(abs, x)) < kmeans.MOST:
                kept.append((i, x))
    # Vectors of one id by their bytes.
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", np.array(r[1], np.int64).tobytes())
    centroids = [x for _, x in sorted(kept, key=key)[:k]]
    if len(kept) < k:
        centroids = [x for _, x in sorted(kept, key=key)]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids)) for _, x in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, best, strict=True) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    best = assign()
    by = {}
    for d, j in best:
        by[j] = by.get(j, 0) + d
    return sorted(((i, j, d, by[j], sum(by.values()), tuple(centroids[j])) for (i, _), (d, j) in zip(kept, best, strict=True)), key=repr)


def vectors(n, size, spread=1.0):
    r = np.random.default_rng(8)
    centres = r.normal(size=(5, size))
    return [(i, (centres[i % 5] + spread * r.normal(size=size)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize(("k", "rounds"), [(7, 5), (3, 0), (200, 2)])
def test_clusters_are_those_of_a_plain_recomputation(spark, k, rounds):
    size = 6
    rows = vectors(120, size) + [(3, [0.5] * size), (3, [0.5] * size), (None, [0.25] * size), (500, None), (501, [1.0] * 5), (502, [None] * size),
                                 (503, [float("nan")] * size), (504, [float("inf")] + [0.0] * 5), (505, [3e38] * size), (506, []), (507, [0.0] * size),
                                 (508, [-500_000.0] * size)]
    df = spark.createDataFrame([(i, v, 1, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(4)
    got = sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"]))
                  for r in kmeans.cluster(df, k, rounds, "2", size).collect()), key=repr)
    assert got == plain(rows, k, rounds, "2", size)


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    out = kmeans.cluster(none, 4, 2, "2", 6)
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_updates_are_exact_and_touch_what_changed(monkeypatch):
    r = np.random.default_rng(1)
    for most in (100, 1 << 26):
        x, before = r.integers(-most, most, (50, 9)), r.integers(-most, most, (6, 9))
        after = before.copy()
        after[1, 3] += 5
        after[4] += r.integers(-3, 4, 9)
        widths = []
        real = kmeans.exact_product
        monkeypatch.setattr(kmeans, "exact_product", lambda a, b: (widths.append(a.shape[1]), real(a, b))[1])
        dots = kmeans.update(x @ before.T, x, before, after)
        monkeypatch.setattr(kmeans, "exact_product", real)
        assert (dots == x @ after.T).all()
        assert sorted(widths) == sorted([1, int((after[4] != before[4]).sum())])
        best, apart = kmeans.nearest(dots, x, after)
        full = ((x[:, None] - after[None]) ** 2).sum(axis=2)
        assert (apart == full.min(axis=1)).all() and (best == full.argmin(axis=1)).all()
