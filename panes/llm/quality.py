"""Quality classifier from weak labels.

Heuristic labellers vote on every document: bad, good, or no vote.  The votes of
one document form a pattern; the corpus is reduced to a count per pattern (at
most ``3 ** labellers`` rows, a few hundred in fact), from which expectation
maximisation estimates how often each labeller votes bad on bad and on good
documents, and so the posterior of each pattern (Dawid and Skene, 1979; an
abstention says nothing).  Counts cover all documents.

The posteriors are the labels of a hashed linear scorer: logistic regression on
hashed word shapes and repetition features.  It is fitted on a bounded sample
(``FIT_DOCUMENTS``, chosen by hash) and then scores every document's whole text,
where no labeller needs to have voted.  No hand-made label is read.

Defined results.  A document without words (null, empty or white space only) has
score 0 and is rejected: there is nothing to train on.  Equal texts have equal
scores, whatever their other columns.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, hash_sample, ship_package
from .words import code_points, slices, split_words

#: Documents the scorer is fitted on at most, and its number of weights.
FIT_DOCUMENTS, WEIGHTS = 20_000, 1 << 16
#: A document is kept if the scorer's probability of being good reaches this.
KEEP = 0.5
#: Text bytes that a worker looks at at once.
LOOK_BYTES = 2 << 20

# --- statistics of texts ----------------------------------------------------

#: Flags of a word.
ODD, SHOUTED, SEPARATOR, PLAIN, ENDS = 1, 2, 4, 8, 16


class Marks:
    """What a character is, looked up by code point; learned as characters appear."""

    ALPHA, UPPER, DIGIT, ALNUM, CAPITAL, CLOSES, ENDS, USUAL = (1 << i for i in range(8))

    def __init__(self):
        self.table = np.zeros(0x110000, np.uint8)
        self.seen = np.zeros(0x110000, bool)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        for x in np.unique(points[~self.seen[points]]).tolist():
            c = chr(x)
            self.table[x] = (self.ALPHA * c.isalpha() | self.UPPER * c.isupper() | self.DIGIT * c.isdigit() | self.ALNUM * c.isalnum()
                             | self.CAPITAL * (c.upper() == c) | self.CLOSES * (c in ".,;:!?") | self.ENDS * (c in ".!?")
                             | self.USUAL * (c in ".,;:!?'\"()-"))
            self.seen[x] = True
        return self.table[points]


_MARKS = Marks()


def distinct_counts(owner: np.ndarray, values: np.ndarray, kinds: int, n: int) -> np.ndarray:
    """How many distinct values (below ``kinds``) each of the ``n`` owners has."""
    keys = np.sort(owner * kinds + values)
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.bincount(keys[first] // kinds, minlength=n)


def shapes_and_flags(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The shape and the flags of each of the distinct, non-empty words.

    A shape has A for capitals, a for other letters, 0 for digits and the rest as
    it is; runs count once.
    """
    points, begins = code_points(words)
    if not len(begins):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    m, word = _MARKS(points), np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(points))))
    has = lambda bit: m & bit > 0
    count = lambda mask: np.add.reduceat(mask, begins, dtype=np.int64)
    lasts = np.append(begins[1:], len(points)) - 1
    sizes = lasts - begins + 1

    alpha, digit = has(Marks.ALPHA), has(Marks.DIGIT)
    kind = np.where(alpha, np.where(has(Marks.UPPER), ord("A"), ord("a")), np.where(digit, ord("0"), points)).astype(np.uint32)
    runs = np.ones(len(kind), bool)
    runs[1:] = kind[1:] != kind[:-1]
    runs[begins] = True
    kinds, lengths = kind[runs], count(runs)
    starts = np.cumsum(lengths) - lengths
    flat = kinds.tobytes().decode("utf-32-le").encode()
    widths = np.where(kinds < 0x80, 1, np.where(kinds < 0x800, 2, np.where(kinds < 0x10000, 3, 4)))
    offsets = np.append(0, np.cumsum(np.add.reduceat(widths, starts))).astype(np.int32)
    shapes = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(flat))

    # Characters up to the last one that is no closing mark.
    inner = np.where(has(Marks.CLOSES), -1, np.arange(len(points)))
    core = np.maximum(np.maximum.reduceat(inner, begins) + 1 - begins, 0)
    letters = count(alpha)
    second = np.where(lengths > 1, kinds[np.minimum(starts + 1, len(kinds) - 1)], 0)
    begun = (second == 0) | (second == ord(".")) | (second == ord(",")) | (kinds[starts] == ord("A")) & (second == ord("a"))
    plain = (core > 0) & (letters == core) & (sizes - core <= 1) & begun
    shouted = (letters > 1) & (count(~has(Marks.CAPITAL)) == 0)
    odd = count(~has(Marks.ALNUM) & ~has(Marks.USUAL)) > 0
    ends = has(Marks.ENDS)[lasts] & (sizes > 1) & has(Marks.ALNUM)[np.maximum(lasts - 1, 0)]
    return shapes, (ODD * odd | SHOUTED * shouted | SEPARATOR * ((letters == 0) & (count(digit) == 0))
                    | PLAIN * (plain & ~shouted) | ENDS * ends)


def _described(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashed shape and the flags of each word."""
    import xxhash

    shapes, marks = shapes_and_flags(words)
    coded_shapes = shapes.dictionary_encode()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(x) % WEIGHTS for x in coded_shapes.dictionary.to_pylist()), np.int64, len(coded_shapes.dictionary))
    return hashed[coded_shapes.indices.to_numpy(zero_copy_only=False)], marks


class Profiles:
    """Word statistics of a batch of texts."""

    def __init__(self, texts: pa.Array):
        self.texts = pc.fill_null(texts, "")
        n = self.n = len(texts)
        self.owner, words = split_words(texts)
        encoded = words.dictionary_encode()
        codes, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        buckets, marks = _described(distinct)
        self.buckets, flag = buckets[codes], marks[codes]
        self.words = np.bincount(self.owner, minlength=n)
        share = lambda mask: np.bincount(self.owner[mask], minlength=n) / np.maximum(self.words, 1)
        self.odd, self.shouted, self.separators, self.plain, self.ends = (
            share(flag & f > 0) for f in (ODD, SHOUTED, SEPARATOR, PLAIN, ENDS))
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == codes[:-1]) & (self.owner[1:] == self.owner[:-1])
        self.again = share(again)
        kinds = len(distinct) + 1
        self.distinct = distinct_counts(self.owner, codes, kinds, n) / np.maximum(self.words, 1)
        same = self.owner[1:] == self.owner[:-1]
        pairs = codes[:-1][same].astype(np.int64) * kinds + codes[1:][same]
        self.pairs = distinct_counts(self.owner[1:][same], pairs, kinds * kinds, n) / np.maximum(self.words - 1, 1)
        lines = [x.split("\n") for x in self.texts.to_pylist()]
        self.lines = np.array([len(x) for x in lines])
        self.line_copies = np.array([1 - len(set(x)) / len(x) for x in lines])


# --- labellers --------------------------------------------------------------


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """1 for a bad vote, 2 for a good one, 0 for none."""
    return np.where(bad, 1, np.where(good, 2, 0))


#: Name and votes of each labeller; they overlap on purpose.
LABELLERS = {
    "odd symbols": lambda p: _vote(p.odd > 0.2, p.odd < 0.05),
    "shouting": lambda p: _vote((p.shouted > 0.25) & (p.words > 2), p.shouted < 0.1),
    "separators": lambda p: _vote(p.separators > 0.15, p.separators < 0.05),
    "plain words": lambda p: _vote(p.plain < 0.6, p.plain > 0.85),
    "word after itself": lambda p: _vote(p.again > 0.15, p.again < 0.05),
    "few distinct words": lambda p: np.where(p.words >= 20, _vote(p.distinct < 0.4, p.distinct > 0.55), 0),
    "few distinct pairs": lambda p: np.where(p.words >= 20, _vote(p.pairs < 0.6, p.pairs > 0.8), 0),
    "sentence ends": lambda p: np.where(p.words >= 20, _vote((p.ends < 0.02) | (p.ends > 0.5), (p.ends > 0.04) & (p.ends < 0.4)), 0),
    "copied lines": lambda p: np.where(p.lines >= 4, _vote(p.line_copies > 0.4, p.line_copies < 0.25), 0),
}


def patterns(p: Profiles) -> np.ndarray:
    """Each text's votes as one number, a base-3 digit for each labeller."""
    out = np.zeros(p.n, np.int64)
    for vote in LABELLERS.values():
        out = out * 3 + np.where(p.words > 0, vote(p), 0)
    return out


def votes_of(pattern: np.ndarray) -> np.ndarray:
    """A row of votes for each pattern."""
    m = len(LABELLERS)
    return np.asarray(pattern)[:, None] // 3 ** np.arange(m - 1, -1, -1)[None] % 3


# --- label model ------------------------------------------------------------


class LabelModel:
    """``prior``: share of bad documents; ``rates[c, j]``: how often labeller j, when
    it votes, votes bad on documents of class c (0 good, 1 bad)."""

    def __init__(self, prior: float, rates: np.ndarray):
        self.prior, self.rates = prior, rates

    def bad(self, pattern: np.ndarray) -> np.ndarray:
        """The posterior probability of bad for each pattern."""
        votes = votes_of(pattern)
        logs = [np.log(x) + np.where(votes == 1, np.log(r), np.where(votes == 2, np.log1p(-r), 0)).sum(axis=1)
                for x, r in ((1 - self.prior, self.rates[0]), (self.prior, self.rates[1]))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_labels(pattern: np.ndarray, counts: np.ndarray, rounds: int = 500) -> LabelModel:
    """Expectation maximisation over pattern counts, from the share of bad votes."""
    votes = votes_of(pattern)
    if not len(votes):
        return LabelModel(0.5, np.full((2, votes.shape[1]), 0.5))
    bad, cast = (votes == 1).sum(axis=1), (votes > 0).sum(axis=1)
    q = np.clip(3 * bad / np.maximum(cast, 1), 0.01, 0.99)
    before = None
    for _ in range(rounds):
        rates = np.empty((2, votes.shape[1]))
        for c, share in ((0, 1 - q), (1, q)):
            w = (counts * share)[:, None]
            # One vote of either kind more, so that no rate is 0 or 1.
            rates[c] = ((w * (votes == 1)).sum(axis=0) + 1) / ((w * (votes > 0)).sum(axis=0) + 2)
        model = LabelModel(((counts * q).sum() + 1) / (counts.sum() + 2), rates)
        q = model.bad(pattern)
        if before is not None and np.abs(q - before).max() < 1e-9:
            break
        before = q
    return model


# --- scorer -----------------------------------------------------------------


def features(p: Profiles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hashed feature and value, sorted by text."""
    import xxhash

    named = lambda x: xxhash.xxh3_64_intdigest(x.encode()) % WEIGHTS
    keys, counts = np.unique(p.owner * WEIGHTS + p.buckets, return_counts=True)
    doc, bucket = keys // WEIGHTS, keys % WEIGHTS
    value = np.sqrt(counts / p.words[doc])
    docs, buckets, values = [doc], [bucket], [value]
    full = np.flatnonzero(p.words > 0)
    for name, x in (("again", p.again), ("copied words", np.where(p.words >= 20, 1 - p.distinct, 0)),
                    ("copied pairs", np.where(p.words >= 20, 1 - p.pairs, 0)), ("copied lines", np.where(p.lines >= 4, p.line_copies, 0))):
        for step in range(0, 10):  # a step function of the share, as features of their own
            over = full[x[full] > step / 10]
            docs.append(over)
            buckets.append(np.full(len(over), named(f"{name} > {step}")))
            values.append(np.full(len(over), 0.5))
    doc, bucket, value = np.concatenate(docs), np.concatenate(buckets), np.concatenate(values)
    order = np.argsort(doc, kind="stable")
    return doc[order], bucket[order], value[order]


class Scorer:
    """``weights[:-1]`` by hashed feature, the last one for every document."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def good(self, p: Profiles) -> np.ndarray:
        """The probability of good for each text; 0 without words."""
        doc, bucket, value = features(p)
        z = np.bincount(doc, self.weights[bucket] * value, p.n) + self.weights[-1]
        return np.where(p.words > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 300, decay: float = 1e-5) -> Scorer:
    """Logistic regression (Adam, all rows a step) on soft labels; the classes weigh the same."""
    weights = np.zeros(WEIGHTS + 1)
    if not rows:
        return Scorer(weights)
    row = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    bucket, value = (np.concatenate(x) for x in zip(*rows, strict=True))
    weigh = np.where(good > 0.5, 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1))
    used, place = np.unique(bucket, return_inverse=True)
    w, m, v = np.zeros(len(used) + 1), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[place] * value, len(rows)) + w[-1]
        error = weigh * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - good)
        gradient = np.append(np.bincount(place, error[row] * value, len(used)), error.sum()) + decay * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient * gradient
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
    weights[used], weights[-1] = w[:-1], w[-1]
    return Scorer(weights)


# --- over tables ------------------------------------------------------------


def _profiles(batch: pa.RecordBatch, column: str) -> Iterator[Profiles]:
    for part in slices(batch, column, LOOK_BYTES):
        yield Profiles(part.column(column))


def fit(docs: DataFrame) -> tuple[LabelModel, Scorer]:
    """The label model of all documents, and the scorer its posteriors train."""
    ship_package(docs.sparkSession)
    texts = docs.select("text")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in _profiles(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(patterns(p)[p.words > 0])], ["pattern"])

    counted = texts.mapInArrow(vote, "pattern long").groupBy("pattern").count().collect()
    found = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["count"] for r in counted], np.float64)
    labels = fit_labels(found, counts)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in _profiles(batch, "text"):
                doc, bucket, value = features(p)
                cuts = np.searchsorted(doc, np.arange(1, p.n))
                pick = np.flatnonzero(p.words > 0)
                b, v = np.split(bucket.astype(np.int32), cuts), np.split(value.astype(np.float32), cuts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(patterns(p)[pick]), pa.array([b[i].tobytes() for i in pick], pa.binary()),
                    pa.array([v[i].tobytes() for i in pick], pa.binary())], ["pattern", "buckets", "values"])

    # By id and text: a text that many documents have gets its share, not all or nothing.
    chosen = hash_sample(docs.select("doc_id", "text").filter(F.col("text").isNotNull()), ["doc_id", "text"], FIT_DOCUMENTS, int(counts.sum()))
    sample = chosen.select("text").mapInArrow(describe, "pattern long, buckets binary, values binary").limit(FIT_DOCUMENTS).collect()
    rows = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["values"], np.float32)) for r in sample]
    good = 1 - labels.bad(np.array([r["pattern"] for r in sample], np.int64)) if sample else np.zeros(0)
    return labels, fit_scorer(rows, good)


def score_column(text: Column, labels: LabelModel, scorer: Scorer) -> Column:
    """For a text: struct(score, weak_good): the scorer's and the labellers' probability of good."""
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("weak_good", T.DoubleType())])

    @F.arrow_udf(kind)
    def scored(texts: pa.Array) -> pa.Array:
        scores, weak = [], []
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        for p in _profiles(batch, "text"):
            scores.append(scorer.good(p))
            weak.append(np.where(p.words > 0, 1 - labels.bad(patterns(p)), 0.0))
        flat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0))
        return pa.StructArray.from_arrays([flat(scores), flat(weak)], ["score", "weak_good"])

    return scored(text)


def score(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, score, weak_good and kept for every row of ``docs`` (doc_id, text)."""
    labels, scorer = fit(docs)
    rows = docs.select("doc_id", score_column(F.col("text"), labels, scorer).alias("s"))
    return rows.select("doc_id", F.round("s.score", 6).alias("score"), F.round("s.weak_good", 6).alias("weak_good"),
                       (F.col("s.score") >= keep).alias("kept"))


def drop_bad(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """``docs`` without the rows the classifier rejects; all columns as they were."""
    labels, scorer = fit(docs)
    name = fresh_name(docs, "quality")
    marked = docs.withColumn(name, score_column(F.col("text"), labels, scorer))
    return marked.filter(F.col(f"{name}.score") >= keep).drop(name)
