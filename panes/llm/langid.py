"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 in ``DIMENSIONS`` dimensions, drawn
from its code point alone, so that letters of any script have one.  A trigram is
bound into one vector: the product, component by component, of its letters'
vectors, the first rotated twice and the second once.  A text's vector is the
bundle (sum) of its trigrams' vectors, and a language's prototype the bundle of
all texts it is learned from (Kanerva, "Hyperdimensional Computing", 2009; Joshi,
Halseth and Kanerva, "Language Geometry using Random Indexing", 2016).  The
language whose prototype has the largest cosine with a text's vector is taken.

Sums are integers, so nothing depends on how the rows are dealt.  A task adds up
one bundle for each language; what reaches the driver is a prototype for each
language: at most ``MOST_LANGUAGES``, beyond which the column is no column of
languages and an error is raised.

Defined results.  Letters (and marks on them) are lower-cased; all else separates
words.  A word's ends are letters of their own in its trigrams.  Null text, a text
without letters, and any text where nothing was learned are ``und`` with score 0.
The score is the cosine, 0 if it is negative.  Of equal cosines the language that
sorts first is taken.  Rows without a language, or whose text is null or has no
letter, teach nothing.  A null ``doc_id`` counts as an empty text in the choice of
held-out rows.  Rows that repeat count as often as they come.  An empty table
gives no rows.  Other columns are neither read nor renamed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name, ship_package
from .words import slices

DIMENSIONS = 1024
MOST_LANGUAGES = 10_000
#: What a text without letters is called (fixed value).
UNKNOWN = "und"
#: Text bytes, trigrams and entries of a table that a worker looks at at once.
LOOK_BYTES, LOOK_TRIGRAMS, LOOK_CELLS = 2 << 20, 2048, 1 << 22
#: From this share of entries that are not 0, a table of counts is multiplied as a whole.
DENSE = 0.02


class Letters:
    """By code point its lower-case letter (0: none) and its vector; learned as letters appear."""

    def __init__(self, dimensions: int):
        self.lower = np.full(0x110000, -1, np.int32)
        self.number = np.full(0x110000, -1, np.int32)
        self.vectors = np.zeros((0, dimensions), np.int8)
        self.dimensions = dimensions

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.lower[points]
        if len(found) and found.min() < 0:
            for x in np.unique(points[found < 0]).tolist():
                c = chr(x)
                self.lower[x] = ord(c.lower()[0]) if c.isalpha() else x if unicodedata.category(c)[0] == "M" else 0
            found = self.lower[points]
        return found

    def vector(self, letters: np.ndarray) -> np.ndarray:
        """A row for each letter; 0, the end of a word, has one too."""
        new = np.unique(letters[self.number[letters] < 0])
        if len(new):
            self.number[new] = len(self.vectors) + np.arange(len(new))
            bits = np.stack([np.random.Generator(np.random.PCG64(0x5EED << 24 | int(x))).integers(0, 2, self.dimensions) for x in new])
            self.vectors = np.concatenate([self.vectors, (2 * bits - 1).astype(np.int8)])
        return self.vectors[self.number[letters]]

    def bound(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """The vector of each trigram."""
        return np.roll(self.vector(first), 2, axis=1) * np.roll(self.vector(second), 1, axis=1) * self.vector(third)


_LETTERS: dict[int, Letters] = {}


def letters_of(dimensions: int) -> Letters:
    return _LETTERS.setdefault(dimensions, Letters(dimensions))


class Trigrams:
    """The trigrams of a batch of texts: entries (trigram, text, count), ascending; and whether a text has letters."""

    def __init__(self, texts: pa.Array, letters: Letters):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = self.n = len(texts)
        # An end of a word before, between and after the texts.
        joined = "\n" + "".join(t + "\n" for t in texts.to_pylist())
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        owner = np.concatenate([[0], np.repeat(np.arange(n), pc.utf8_length(texts).to_numpy(zero_copy_only=False) + 1)])
        seq = letters(points)
        keep = np.ones(len(seq), bool)
        keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)
        seq, owner = seq[keep], owner[keep]
        middle = np.flatnonzero(seq)
        present = np.zeros(0x110000, bool)
        present[seq] = True
        alphabet = np.flatnonzero(present)
        size = len(alphabet)
        code = (np.cumsum(present) - 1)[seq]
        key = (code[middle - 1] * size + code[middle]) * size + code[middle + 1]
        if size**3 <= LOOK_CELLS:
            used = np.flatnonzero(np.bincount(key, minlength=size**3))
            place = np.zeros(size**3, np.int64)
            place[used] = np.arange(len(used))
            kind = place[key]
        else:
            used, kind = np.unique(key, return_inverse=True)
        self.kinds = alphabet[used // size**2], alphabet[used // size % size], alphabet[used % size]
        cells = np.sort(kind * n + owner[middle])
        first = np.ones(len(cells), bool)
        first[1:] = cells[1:] != cells[:-1]
        starts = np.flatnonzero(first)
        self.count = np.diff(np.append(starts, len(cells)))
        self.kind, self.text = np.divmod(cells[starts], max(n, 1))
        self.has_letters = np.bincount(owner[middle], minlength=n) > 0

    def bundles(self, letters: Letters, group: np.ndarray | None = None, groups: int | None = None) -> np.ndarray:
        """The bundle of each text, or of each group of texts: exact sums."""
        text = self.text if group is None else group[self.text]
        n = self.n if group is None else groups
        out = np.zeros((n, letters.dimensions))
        kind, count = self.kind, self.count
        total = len(self.kinds[0])
        exact = np.float32 if count.sum() < 1 << 24 else np.float64  # sums below 2**24 are exact in single precision
        for low in range(0, total, LOOK_TRIGRAMS):
            high = min(low + LOOK_TRIGRAMS, total)
            vectors = letters.bound(*(k[low:high] for k in self.kinds)).astype(exact)
            a, b = np.searchsorted(kind, (low, high))
            t, k, c = text[a:b], kind[a:b] - low, count[a:b]
            step = max(1, LOOK_CELLS // (high - low))
            if b - a >= DENSE * n * (high - low):
                for row in range(0, n, step):
                    rows = min(step, n - row)
                    inside = (t >= row) & (t < row + rows)
                    table = np.bincount((t[inside] - row) * (high - low) + k[inside], c[inside], rows * (high - low))
                    out[row:row + rows] += table.astype(exact).reshape(rows, -1) @ vectors
            else:
                order = np.argsort(t, kind="stable")
                t, k, c = t[order], k[order], c[order]
                for at in range(0, len(t), 2048):
                    own = t[at:at + 2048]
                    begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                    out[own[begins]] += np.add.reduceat(vectors[k[at:at + 2048]] * c[at:at + 2048, None].astype(exact), begins, axis=0)
        return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: a fifth, by a checksum of its id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The languages in ``docs`` (lang, text), sorted, and their prototypes, of length 1."""
    ship_package(docs.sparkSession)
    rows = docs.select("lang", "text").filter("lang is not null and text is not null")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = letters_of(dimensions), {}
        for batch in batches:
            for part in slices(batch, "text", LOOK_BYTES):
                found = Trigrams(part.column("text"), letters)
                coded = part.column("lang").dictionary_encode()
                names = coded.dictionary.to_pylist()
                own = found.bundles(letters, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(names))
                for name, x in zip(names, own, strict=True):
                    sums[name] = sums[name] + x.astype(np.int64) if name in sums else x.astype(np.int64)
                if len(sums) > MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages: is this a column of languages?")
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))], ["lang", "bundle"])

    parts = rows.mapInArrow(bundle, "lang string, bundle array<long>")
    # Dimension by dimension, so that no group holds more than a number a task.
    summed = parts.select("lang", F.posexplode("bundle").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    one = summed.groupBy("lang").agg(F.collect_list(F.struct("d", "x")).alias("xs"))
    found = one.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: is this a column of languages?")
    bundles = {r["lang"]: np.array([x for _, x in sorted((x["d"], x["x"]) for x in r["xs"])], np.float64) for r in found}
    names = sorted(k for k, x in bundles.items() if np.any(x))
    return names, np.stack([bundles[k] / np.linalg.norm(bundles[k]) for k in names]) if names else np.zeros((0, dimensions))


def language_column(text: Column, names: list[str], prototypes: np.ndarray) -> Column:
    """For a text: struct(lang, score)."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    dimensions = prototypes.shape[1]

    @F.arrow_udf(kind)
    def found(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", LOOK_BYTES):
            letters = letters_of(dimensions)
            grams = Trigrams(part.column("text"), letters)
            if names:
                own = grams.bundles(letters)
                size = np.linalg.norm(own, axis=1)
                cosines = own @ prototypes.T / np.maximum(size, 1)[:, None]
                best = cosines.argmax(axis=1)
                known = grams.has_letters
                langs += [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                scores.append(np.where(known, np.clip(cosines[np.arange(grams.n), best], 0, 1), 0.0))
            else:
                langs += [UNKNOWN] * grams.n
                scores.append(np.zeros(grams.n))
        flat = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(flat)], ["lang", "score"])

    return found(text)


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs`` (doc_id, lang, text).

    Learned from the rows that are not held out.
    """
    rows = docs.select("doc_id", "lang", "text")
    names, prototypes = learn(rows.filter(~held_out(F.col("doc_id"))), dimensions)
    marked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language_column(F.col("text"), names, prototypes).alias("found"))
    return marked.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.round("found.score", 6).alias("score"))


def with_language(docs: DataFrame, names: list[str], prototypes: np.ndarray, column: str = "language") -> DataFrame:
    """``docs`` with a column of the language of their text; all others as they were."""
    name = fresh_name(docs, column) if column.lower() in {c.lower() for c in docs.columns} else column
    return docs.withColumn(name, language_column(F.col("text"), names, prototypes)["lang"])
