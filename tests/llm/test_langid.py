import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import langid


def plain_bundle(text, letters):
    """A trigram at a time."""
    seq, out = [0], np.zeros(letters.dimensions, np.int64)
    for c in text or "":
        x = ord(c.lower()[0]) if c.isalpha() else ord(c) if unicodedata.category(c)[0] == "M" else 0
        if x or seq[-1]:
            seq.append(x)
    seq += [0] * (seq[-1] != 0)
    for a, b, c in zip(seq, seq[1:], seq[2:], strict=False):
        if b:
            va, vb, vc = (letters.vector(np.array([x]))[0].astype(np.int64) for x in (a, b, c))
            out += np.roll(va, 2) * np.roll(vb, 1) * vc
    return out


TEXTS = [None, "", " \n", "a", "12 + 3", "One two, three!", "naïve ÉÉ ß", "中文字 и русский", "हिन्दी भाषा", "x" * 3000, "\nlines\n\nof text\n", "🙂", "Ab" * 20]


@pytest.mark.parametrize("dense", [0.0, 0.02, 2.0])
def test_bundles_are_sums_of_bound_trigrams(dense, monkeypatch):
    monkeypatch.setattr(langid, "DENSE", dense)
    monkeypatch.setattr(langid, "LOOK_TRIGRAMS", 7)
    letters = langid.Letters(64)
    r = random.Random(3)
    texts = TEXTS + ["".join(r.choice("abcdeéß .,X1") for _ in range(r.randint(0, 90))) for _ in range(60)]
    found = langid.Trigrams(pa.array(texts), letters)
    own = found.bundles(letters)
    want = np.stack([plain_bundle(t, letters) for t in texts])
    assert (own == want).all()
    assert found.has_letters.tolist() == [any(c.isalpha() for c in t or "") for t in texts]
    group = np.arange(len(texts)) % 3
    assert (found.bundles(letters, group, 3) == np.stack([want[group == g].sum(axis=0) for g in range(3)])).all()
    # A letter's vector is its own, whatever else a worker has met.
    assert (langid.Letters(64).vector(np.array([ord("q")])) == letters.vector(np.array([ord("q")]))).all()


def test_large_alphabets_and_no_texts(monkeypatch):
    letters = langid.Letters(32)
    texts = ["".join(chr(0x4E00 + (i * 7919 + j * 104729) % 5000) for j in range(300)) for i in range(4)]
    assert (langid.Trigrams(pa.array(texts), letters).bundles(letters) == np.stack([plain_bundle(t, letters) for t in texts])).all()
    assert langid.Trigrams(pa.array([], pa.string()), letters).bundles(letters).shape == (0, 32)


def test_held_out_accuracy_and_plain_recomputation(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    assert len(rows) == len(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in rows.items() if r["held_out"])
    assert sum(rows[i]["lang_pred"] == truth[i][0] for i in held) / len(held) > 0.98
    for lang, n in Counter(truth[i][0] for i in held).items():  # each language for itself
        assert sum(rows[i]["lang_pred"] == lang for i in held if truth[i][0] == lang) / n > 0.95
    small = {i: v for i, v in truth.items() if i < 150}
    letters = langid.letters_of(256)
    bundles = {i: plain_bundle(t, letters) for i, (_, t) in small.items()}
    names = sorted({v[0] for i, v in small.items() if i not in held})
    sums = np.stack([sum(b for i, b in bundles.items() if i not in held and small[i][0] == n) for n in names]).astype(float)
    sums /= np.linalg.norm(sums, axis=1)[:, None]
    for r in langid.identify(docs.filter("doc_id < 150"), dimensions=256).collect():
        b = bundles[r["doc_id"]]
        cosines = sums @ b / max(np.linalg.norm(b), 1)
        assert r["lang_pred"] == names[cosines.argmax()] and abs(r["score"] - max(0, cosines.max())) < 1e-5


def test_edges(spark, edge_docs, no_docs, monkeypatch):
    rows = langid.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (6, 7, 8))
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "und") for r in rows)
    assert by[None]["held_out"]
    assert langid.identify(no_docs).collect() == []
    # Nothing to learn from.
    untaught = edge_docs.withColumn("lang", edge_docs["lang"].substr(1, 0)).replace("", None, ["lang"])
    assert {r["lang_pred"] for r in langid.identify(untaught).collect()} == {"und"}
    names, prototypes = langid.learn(edge_docs)
    marked = langid.with_language(edge_docs.withColumnRenamed("part", "language") if "part" in edge_docs.columns else edge_docs, names, prototypes)
    assert len(marked.columns) == len(edge_docs.columns) + 1
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 0)
    with pytest.raises(Exception, match="column of languages"):
        langid.learn(edge_docs)
