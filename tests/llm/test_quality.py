import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from conftest import SF_SMALL

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import quality
from panes.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark):
    """Hand-made labels are not read in fitting; here they judge the result."""
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    rows = quality.score(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert len(rows) > 300 and right / len(rows) > 0.98
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["kept"] for r in good) / len(good) > 0.99
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.95


def test_edges(spark, edge_docs, no_docs):
    rows = quality.score(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["score"], r["kept"]))
    assert all(by[i] == [(0.0, False)] for i in (6, 7, 8))
    assert by[1] == by[2] and by[15][0] == by[15][1]
    assert by[12][0][1] and by[1][0][1]
    assert quality.score(no_docs).collect() == [] and quality.drop_bad(no_docs).collect() == []
    kept = quality.drop_bad(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_expectation_maximisation_finds_the_labellers_accuracies():
    r = np.random.default_rng(3)
    m, n = len(quality.LABELLERS), 60_000
    bad = r.random(n) < 0.15
    rates = np.stack([np.linspace(0.01, 0.1, m), np.linspace(0.5, 0.95, m)])
    votes = np.where(r.random((n, m)) < rates[bad.astype(int)], 1, 2) * (r.random((n, m)) < 0.8)
    patterns, counts = np.unique((votes * 3 ** np.arange(m - 1, -1, -1)).sum(axis=1), return_counts=True)
    model = quality.fit_labels(patterns, counts.astype(float))
    assert abs(model.prior - 0.15) < 0.01
    assert np.abs(model.rates - rates).max() < 0.03


def test_features_are_of_the_whole_text():
    good = "Some plain words stand here. " * 400
    p = quality.Profiles(pa.array([good, good + "$$$ ### " * 400]))
    assert p.odd[0] == 0 and p.odd[1] > 0.25
    assert shape("Thnd***") == "Aa*" and shape("+1(372)") == "+0(0)"


def shape(word):
    out, last = [], ""
    for c in word:
        k = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if k != last:
            out.append(k)
        last = k
    return "".join(out)


def flags(word):
    kind, core, letters = shape(word), word.rstrip(".,;:!?"), [c for c in word if c.isalpha()]
    plain = bool(core) and core.isalpha() and kind[:2] in ("Aa", "a", "A", "a.", "a,", "A.", "A,") and len(word) - len(core) <= 1
    shouted = len(letters) > 1 and word.upper() == word
    return {"odd": any(not c.isalnum() and c not in ".,;:!?'\"()-" for c in word), "shouted": shouted,
            "separator": not letters and not any(c.isdigit() for c in word), "plain": plain and not shouted,
            "ends": word[-1] in ".!?" and word[-2:-1].isalnum()}


def test_shapes_and_flags_are_those_of_a_character_loop():
    r = random.Random(5)
    letters = "abXYÉßéñİıǅ'’.,!?;:-_()\"0127²½ª中🙂\u0301Σς<|>$٣"
    words = sorted({"".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(20_000)})
    shapes, marks = quality.shapes_and_flags(pa.array(words))
    bits = {"odd": quality.ODD, "shouted": quality.SHOUTED, "separator": quality.SEPARATOR, "plain": quality.PLAIN, "ends": quality.ENDS}
    for word, kind, mark in zip(words, shapes.to_pylist(), marks.tolist(), strict=True):
        assert kind == shape(word), repr(word)
        assert {k: bool(mark & b) for k, b in bits.items()} == flags(word), repr(word)
    # A slice of an array, and none.
    assert quality.shapes_and_flags(pa.array(words)[7:9])[0].to_pylist() == [shape(w) for w in words[7:9]]
    assert len(quality.shapes_and_flags(pa.array([], pa.string()))[1]) == 0


def plain_scores(texts):
    """Votes, posteriors and scores once more, a document and a word at a time."""
    def profile(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines, marks, n = (text or "").split("\n"), [flags(w) for w in words], max(len(words), 1)
        p = {k: sum(m[k] for m in marks) / n for k in ("odd", "shouted", "separator", "plain", "ends")}
        p |= {"words": len(words), "again": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, "distinct": len(set(words)) / n,
              "pairs": len(set(zip(words, words[1:], strict=False))) / max(len(words) - 1, 1),
              "lines": len(lines), "copies": 1 - len(set(lines)) / len(lines), "shapes": Counter(map(shape, words))}
        return p

    def votes(p):
        v = lambda bad, good: 1 if bad else 2 if good else 0
        long = p["words"] >= 20
        return () if not p["words"] else (
            v(p["odd"] > .2, p["odd"] < .05), v(p["shouted"] > .25 and p["words"] > 2, p["shouted"] < .1),
            v(p["separator"] > .15, p["separator"] < .05), v(p["plain"] < .6, p["plain"] > .85), v(p["again"] > .15, p["again"] < .05),
            v(p["distinct"] < .4, p["distinct"] > .55) if long else 0, v(p["pairs"] < .6, p["pairs"] > .8) if long else 0,
            v(p["ends"] < .02 or p["ends"] > .5, .04 < p["ends"] < .4) if long else 0,
            v(p["copies"] > .4, p["copies"] < .25) if p["lines"] >= 4 else 0)

    profiles = [profile(t) for t in texts]
    cast = [votes(p) for p in profiles]
    counts = Counter(v for v in cast if v)
    q = {v: min(max(3 * v.count(1) / max(len(v) - v.count(0), 1), .01), .99) for v in counts}
    for _ in range(500):
        prior = (sum(n * q[v] for v, n in counts.items()) + 1) / (sum(counts.values()) + 2)
        rates = [[(sum(n * w[v] for v, n in counts.items() if v[j] == 1) + 1) / (sum(n * w[v] for v, n in counts.items() if v[j]) + 2)
                  for j in range(9)] for w in ({v: 1 - x for v, x in q.items()}, q)]
        like = lambda v, r: math.prod(r[j] if x == 1 else 1 - r[j] if x else 1 for j, x in enumerate(v))
        new = {v: (b := prior * like(v, rates[1])) / (b + (1 - prior) * like(v, rates[0])) for v in counts}
        done, q = max(abs(new[v] - q[v]) for v in q) < 1e-9, new
        if done:
            break
    bucket = lambda x: xxhash.xxh3_64_intdigest(x.encode()) % quality.WEIGHTS

    def features(p):
        by = Counter()
        for k, n in p["shapes"].items():
            by[bucket(k)] += n
        out = [(b, math.sqrt(n / p["words"])) for b, n in by.items()]
        long = p["words"] >= 20
        for name, x in (("again", p["again"]), ("copied words", 1 - p["distinct"] if long else 0), ("copied pairs", 1 - p["pairs"] if long else 0),
                        ("copied lines", p["copies"] if p["lines"] >= 4 else 0)):
            out += [(bucket(f"{name} > {s}"), .5) for s in range(10) if x > s / 10]
        return out

    rows = [(features(p), 1 - q[v]) for p, v in zip(profiles, cast, strict=True) if v]
    good = sum(g for _, g in rows)
    w, m, s = Counter(), Counter(), Counter()
    for t in range(1, 301):
        gradient = Counter()
        for f, g in rows:
            z = sum(w[b] * x for b, x in f) + w["all"]
            e = (.5 / max(good, 1) if g > .5 else .5 / max(len(rows) - good, 1)) * (1 / (1 + math.exp(-z)) - g)
            for b, x in f:
                gradient[b] += e * x
            gradient["all"] += e
        for b in gradient:
            d = gradient[b] + 1e-5 * w[b]
            m[b], s[b] = .9 * m[b] + .1 * d, .999 * s[b] + .001 * d * d
            w[b] -= .1 * (m[b] / (1 - .9 ** t)) / (math.sqrt(s[b] / (1 - .999 ** t)) + 1e-10)
    return [(1 / (1 + math.exp(-sum(w[b] * x for b, x in features(p)) - w["all"])) if v else 0.0, 1 - q[v] if v else 0.0)
            for p, v in zip(profiles, cast, strict=True)]


def test_registered_query_is_what_a_plain_recomputation_gives(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in LLM_QUERIES["op4_weak_labels"](spark, SF_SMALL).collect()}
    want = plain_scores([d["text"] for d in docs])
    assert len(got) == len(docs)
    for d, (score, weak) in zip(docs, want, strict=True):
        r = got[d["doc_id"]]
        assert abs(r["weak_good"] - weak) < 1e-5
        assert abs(r["score"] - score) < 1e-3
        assert r["kept"] == (score >= quality.KEEP) or abs(score - quality.KEEP) < 1e-3


def test_the_sample_does_not_depend_on_the_files(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_DOCUMENTS", 120)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a, b = ({r["doc_id"]: round(r["score"], 4) for r in quality.score(docs.repartition(n)).collect()} for n in (1, 7))
    assert a == b
