import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import packing
from panes.llm.queries import LLM_QUERIES

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def check(docs, pieces, tokenizer, capacity, crc=None):
    """Every id of every document in exactly one piece, sequences gapless and full or a power of two."""
    crc = crc or (lambda p: zlib.crc32(bytes(p["ids"])))
    want = {}
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(d, []).append(ids)
    got = {}
    for p in pieces:
        got.setdefault(p["doc_id"], []).append(p)
    assert set(got) == set(want)
    for d, all_ids in want.items():
        own = sorted(got[d], key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            at = 0
            for p in own:
                assert p["start"] == at and p["doc_tokens"] == len(all_ids[0])
                assert crc(p) == zlib.crc32(all_ids[0][at:at + p["length"]].tobytes())
                at += p["length"]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and at & (at - 1) == 0
    return sequences


def test_whole_table(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = LLM_QUERIES["op5_min_bin_slack"](spark, SF_SMALL).collect()
    sequences = check(docs, rows, tokenizer, 4096, crc=lambda p: p["ids_crc32"])
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 4096) + 12


@pytest.mark.parametrize("capacity", [64, 4096])
def test_edges(spark, edge_docs, no_docs, tokenizer, capacity, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 500)
    vocabulary = open(FILE).read()
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    check(docs, packing.pack(edge_docs, vocabulary, 2, capacity).collect(), tokenizer, capacity)
    assert packing.pack(no_docs, vocabulary, 2, capacity).collect() == []
    # A pool of nothing but copies, whose length divides no window.
    same = spark.createDataFrame([(i, "three plain words") for i in range(100)], "doc_id long, text string").coalesce(1)
    check([(i, "three plain words") for i in range(100)], packing.pack(same, vocabulary, 2, capacity).collect(), tokenizer, capacity)


def test_fill_is_the_best_of_all_choices():
    r = random.Random(1)
    for _ in range(300):
        lengths = sorted(r.sample(range(1, 40), r.randint(1, 5)))
        counts = {n: r.randint(1, 3) for n in lengths}
        capacity = r.randint(1, 90)
        every = [n for n in lengths for _ in range(counts[n])]
        best = max(sum(c) for k in range(len(every) + 1) for c in combinations(every, k) if sum(c) <= capacity)
        taken = packing.fill(lengths, counts, capacity)
        assert all(0 < k <= counts[n] for n, k in taken.items())
        assert sum(n * k for n, k in taken.items()) == best


def test_words_have_the_librarys_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 20_000)  # forgets all the time
    ids_of = packing.WordIds(open(FILE).read())
    r = random.Random(2)
    letters = "abcXYZéÉßñÑİıǅ'’.,!?-_0127²½ª中🙂\u0301\u00ad\u200b\x1c\x85 Σς<|>"
    words = ["".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(5000)]
    words += ["".join(r.choice("''stremvlLDx.1É'") for _ in range(r.randint(1, 9))) for _ in range(5000)]
    words = sorted({*words, "it's", "we'LL", "'s's'rex", "'", "x''s", "<|endoftext|>", "x<|startoftext|>y", "<", "|", "a" * 3000, "é" * 3000})
    for low in range(0, len(words), 1000):
        own = words[low:low + 1000]
        values, starts, lengths = ids_of(pa.array(own, pa.large_string()))
        for w, s, n in zip(own, starts, lengths, strict=True):
            assert values[s:s + n].tolist() == tokenizer.encode(w, add_special_tokens=False).ids, repr(w)
        assert sum(map(len, ids_of.parts.known.to_pylist())) < 60_000
    assert [len(x) for x in ids_of(pa.array([], pa.large_string()))] == [0, 0, 0]


def test_a_file_of_another_form_is_left_to_the_library(spark, edge_docs):
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.is_known_form(open(FILE).read()) and not packing.is_known_form(open(other).read())
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    check(docs, packing.pack(edge_docs, open(other).read(), 2, 256).collect(), Tokenizer.from_file(other), 256)
