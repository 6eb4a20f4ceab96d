import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import spm

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def own():
    return spm.Encoder(MODEL)


def test_ids_equal_the_librarys(own, library):
    r = random.Random(5)
    letters = "ab e  \n\tté▁ñ中文🙂the ingABC.,;0 12"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 200))) for _ in range(800)]
    texts += ["     ", " ", "  x", "x  ", "a" * 5000, "ab" * 3000, " " * 500, "\n\n \n  a", "ﬁ Ⅷ é", ""]
    ids, bounds = own(pa.array([*texts, None]))
    assert bounds[-1] == bounds[-2]
    for i, t in enumerate(texts):
        mine = ids[bounds[i]:bounds[i + 1]].tolist()
        assert mine == library.encode(t), repr(t[:80])
        assert own.one(t).tolist() == mine
        assert spm.decode(mine, own.pieces.raw) == t.replace("▁", " ") == library.decode(mine)


def test_the_window_stays_bounded(own, library):
    """One unbroken word of 30,000 characters, fed in chunks."""
    r = random.Random(8)
    text = "".join(r.choice("etaoinshrdlu") for _ in range(30_000))
    v, ids, widest = spm.Viterbi(own.pieces), [], 0
    for i in range(0, len(text), 37):
        ids += v.feed((spm.SPACE if i == 0 else "") + text[i:i + 37])
        widest = max(widest, len(v.back))
    assert ids and ids + v.close() == library.encode(text)
    assert widest <= 2 * (spm.STRIDE + own.pieces.longest)


def test_shared_beginnings_are_walked_once(library, monkeypatch):
    walked, feed = [], spm.Viterbi.feed
    monkeypatch.setattr(spm.Viterbi, "feed", lambda v, text: walked.append(len(text)) or feed(v, text))
    r = random.Random(4)
    stems = ["understand", "interest", "中文字🙂", "a\0", "x" * 60, "ſ\u0301"]
    words = [x + "".join(r.choice("esting\0é文") for _ in range(n)) for x in stems for n in range(9)] + ["a", "a\0b", "y" * 70]
    texts = [" ".join(words), *words, " ".join(reversed(words))]
    ids, bounds = spm.Encoder(MODEL)(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library.encode(t) for t in texts]
    assert sum(walked) < 0.6 * sum(len(spm.SPACE + w) for w in set(words))


def test_unigram_paths_are_the_best():
    class Model(spm.Pieces):
        def __init__(self, score):
            self.kind, self.score, self.byte, self.pairs = "unigram", score, {}, {}
            self.id = {p: i for i, p in enumerate(score)}
            self.longest, self.missing = max(map(len, score)), min(score.values()) - 10
            self.suffixes()

    r = random.Random(3)
    score = {"".join(p): -r.random() * 10 for n in (1, 2, 3) for p in itertools.product("abc", repeat=n) if n == 1 or r.random() < 0.5}
    model = Model(score)

    def best(text):
        if not text:
            return 0.0
        return max(score[text[:n]] + best(text[n:]) for n in (1, 2, 3) if text[:n] in score and n <= len(text))

    names = list(score)
    for _ in range(60):
        text = "".join(r.choice("abc") for _ in range(r.randint(1, 12)))
        v = spm.Viterbi(model)
        ids = v.feed(text) + v.close()
        assert "".join(names[i] for i in ids) == text
        assert abs(sum(score[names[i]] for i in ids) - best(text)) < 1e-9
    long = "".join(r.choice("abc") for _ in range(5000))
    v = spm.Viterbi(model)
    ids = v.feed(long) + v.close()
    total = np.full(len(long) + 1, -np.inf)
    total[0] = 0
    for i in range(1, len(long) + 1):
        total[i] = max(total[i - n] + score[long[i - n:i]] for n in (1, 2, 3) if n <= i and long[i - n:i] in score)
    assert abs(sum(score[names[i]] for i in ids) - total[-1]) < 1e-6


def test_tables(spark, edge_docs, no_docs, library):
    rows = edge_docs.select("doc_id", "text").collect()
    out = spm.encode_texts(edge_docs, MODEL).select("doc_id", "ids", spm.decode_column(F.col("ids"), MODEL).alias("back")).collect()
    key = lambda x: repr(x)
    assert sorted([(r["doc_id"], r["ids"], r["back"]) for r in out], key=key) == sorted(
        [(r["doc_id"], library.encode(r["text"] or ""), (r["text"] or "").replace("▁", " ")) for r in rows], key=key)
    assert spm.encode_texts(no_docs, MODEL).collect() == []
    both = spm.encode_texts(edge_docs, MODEL, decoded=True).collect()
    assert sorted([(r["doc_id"], r["ids"], r["decoded"]) for r in both], key=key) == sorted([(r["doc_id"], r["ids"], r["back"]) for r in out], key=key)
