"""Packing token ids into windows by minimum bin slack.

A task tokenises its rows and keeps a pool of documents by remaining length (a
multiset).  A window takes the longest document of the pool first; a subset-sum
dynamic programme over a bitset then finds, of all multisets of the remaining
lengths, the one that fills the window closest to its capacity, and backtracking
gives the count of each length.  Slack that no multiset can fill is filled by
cutting a piece off the longest document left.  A document longer than a window
fills windows of its own first.  What is left when a task ends is cut into
sequences whose lengths are powers of two, which need no padding: fewer than
``log2(capacity) + 1`` short sequences a task.

Nothing is shuffled: windows need not mix documents of different tasks.  A
task's memory holds one batch and one pool (``POOL_TOKENS``), whatever the input
and however many copies of one document it holds.

Defined results.  Null text is empty text: one piece holding the end id alone.
Repeated rows are packed as often as they come.  ``doc_id`` may be null or
repeat; it is carried, not used.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

import json
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ship_package
from .words import code_points, gather, slices, split_words

#: Tokens in a task's pool before it starts to fill windows (8 MB of ids).
POOL_TOKENS = 2_000_000
#: Bytes of parts of words, with their ids, that a worker remembers; text bytes it looks at at once.
REMEMBERED_BYTES, LOOK_BYTES = 24 << 20, 2 << 20

# --- tokenising -------------------------------------------------------------

#: The split pattern of the vocabulary file, for Latin letters, and what else of its
#: form the array code below stands for (fixed values).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PRETOKEN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Letters of the pattern's endings after an apostrophe, one or two of them (fixed values).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def is_known_form(vocabulary: str) -> bool:
    """Whether a tokenizer file normalises and splits as the array code does."""
    file = json.loads(vocabulary)
    return (file.get("normalizer") == NORMALIZER and file.get("pre_tokenizer") == PRE_TOKENIZER and not file.get("post_processor")
            and not file.get("truncation") and file["model"]["type"] == "BPE" and not file["model"].get("dropout")
            and all(t["content"].startswith("<|") for t in file.get("added_tokens", [])))


def byte_letters() -> dict[int, str]:
    """The public byte-to-letter table of byte-level BPE: printable bytes stand
    for themselves, the others for the letters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Letters:
    """By code point: its class, its lower case, and whether a word of such is split here."""

    OTHER, LETTER, NUMBER = range(3)

    def __init__(self):
        import regex

        top = 0x250  # Latin; beyond it the library does all of it
        self.lower = np.arange(top + 1, dtype=np.uint32)
        self.kind, self.plain = np.zeros(top + 1, np.uint8), np.zeros(top + 1, bool)
        for x in [*range(0x21, 0x7F), *range(0xA1, top)]:
            c = chr(x)
            self.plain[x] = len(c.lower()) == 1 and ord(c.lower()) < top
            if self.plain[x]:
                self.lower[x] = ord(c.lower())
                self.kind[x] = self.LETTER if regex.match(r"\p{L}", c.lower()) else self.NUMBER if regex.match(r"\p{N}", c.lower()) else self.OTHER
        self.top = top


def runs_of(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The code points between ``starts`` as strings."""
    widths = np.where(values < 0x80, 1, np.where(values < 0x800, 2, np.where(values < 0x10000, 3, 4)))
    offsets = np.append(0, np.cumsum(np.add.reduceat(widths, starts) if len(starts) else [])).astype(np.int64)
    data = values.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))


class PartIds:
    """Ids of parts of words, remembered as arrays; the parts used longest ago go first."""

    def __init__(self, tokenize, most_bytes: int):
        self.tokenize, self.most_bytes, self.turn = tokenize, most_bytes, 0
        self.letters = byte_letters()
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.starts, self.lengths, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _forget(self) -> None:
        size = 8 + 20 + pc.binary_length(self.known).to_numpy(zero_copy_only=False) + 4 * self.lengths
        if size.sum() > self.most_bytes:
            latest = np.argsort(-self.used, kind="stable")
            keep = np.sort(latest[np.cumsum(size[latest]) <= self.most_bytes // 2])
            self.known = self.known.take(pa.array(keep))
            self.ids = gather(self.ids, self.starts[keep], self.lengths[keep])
            self.lengths, self.used = self.lengths[keep], self.used[keep]
            self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, parts: pa.Array) -> np.ndarray:
        """The number of each of the distinct parts; ``ids``, ``starts`` and ``lengths`` hold until the next call."""
        self._forget()
        self.turn += 1
        found = pc.index_in(parts, value_set=self.known)
        missing = parts.filter(pc.is_null(found))
        at = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(missing))
        ids = []
        for part in missing.to_pylist():
            spelled = part if part.isascii() and part.isalnum() else "".join([self.letters[b] for b in part.encode()])
            ids.append([t.id for t in self.tokenize(spelled)])
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known = pa.concat_arrays([self.known, missing])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, lengths.sum())]).astype("<u4")
        self.used = np.concatenate([self.used, np.zeros(len(ids), np.int32)])
        self.used[at] = self.turn
        return at


class WordIds:
    """Ids of words.

    The vocabulary's pattern never matches white space, so the ids of a text are
    those of its words in a row, and those of a word are those of the parts the
    pattern finds in it.  All words of a slice are split at once, as arrays of code
    points; a part is tokenised when a worker first meets it.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.by_words = is_known_form(vocabulary)
        self.letters = Letters()
        model = self.tokenizer.model
        self.parts = PartIds(model.tokenize, REMEMBERED_BYTES)

    def of_texts(self, texts: pa.Array) -> list[np.ndarray]:
        """The library's own ids, for a file of another form."""
        found = self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def split(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The parts of the words in a row, how many each has, and which words are left to the library."""
        points, begins = code_points(words)
        if not len(begins):
            return pa.array([], pa.large_string()), begins, np.zeros(0, bool)
        low = np.minimum(points, self.letters.top)
        strange = ~self.letters.plain[low]
        special = np.zeros(len(points), bool)  # where a special token may stand
        special[:-1] = (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        special[begins[1:] - 1] = False
        rest = np.add.reduceat(strange | special, begins, dtype=np.int64) > 0
        lengths = np.diff(np.append(begins, len(points)))
        inside = np.repeat(~rest, lengths)
        low, lengths = low[inside], np.where(rest, 0, lengths)
        first = np.zeros(len(low) + 1, bool)
        first[(np.cumsum(lengths) - lengths)[~rest]] = True
        values, kind = self.letters.lower[low], self.letters.kind[low]
        starts = first[:-1].copy()
        starts[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == Letters.NUMBER)
        ends = np.append(values, [0, 0, 0])
        for ending in ENDINGS:
            at = np.flatnonzero(starts & (values == ord("'")))
            for i, c in enumerate(ending):
                at = at[~first[np.minimum(at + i + 1, len(low))] & (ends[at + i + 1] == ord(c))]
            for i in range(len(ending)):
                starts[at + i + 1] = False
            after = at + len(ending) + 1
            starts[after[after < len(low)]] = True
        places = np.flatnonzero(starts)
        owner = np.repeat(np.arange(len(lengths)), lengths)[places]
        return runs_of(values, places), np.bincount(owner, minlength=len(lengths)), rest

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct words in a row, where each begins, and how many it has."""
        parts, n_parts, rest = self.split(words)
        coded_parts = parts.dictionary_encode()
        numbers = self.parts(coded_parts.dictionary)[coded_parts.indices.to_numpy(zero_copy_only=False)]
        sizes = self.parts.lengths[numbers]
        values = gather(self.parts.ids, self.parts.starts[numbers], sizes)
        owner = np.repeat(np.arange(len(n_parts)), n_parts)
        lengths = np.bincount(owner, sizes, len(n_parts)).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        if rest.any():  # beyond Latin letters, and where a special token may stand
            found = self.of_texts(words.filter(pa.array(rest)))
            lengths[rest] = [len(x) for x in found]
            starts[rest] = len(values) + np.cumsum(lengths[rest]) - lengths[rest]
            values = np.concatenate([values, *found])
        return values, starts, lengths


_WORD_IDS: dict[int, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """One for each vocabulary and worker process."""
    key = hash(vocabulary)
    if key not in _WORD_IDS:
        _WORD_IDS.clear()
        _WORD_IDS[key] = WordIds(vocabulary)
    return _WORD_IDS[key]


def tokenise(texts: pa.Array, ids_of: WordIds, end_id: int) -> list[np.ndarray]:
    """For each text its ids (unsigned, 32 bits), then ``end_id``."""
    if not ids_of.by_words:
        return [np.append(x, np.uint32(end_id)).astype("<u4") for x in ids_of.of_texts(texts)]
    owner, words = split_words(texts)
    encoded = words.dictionary_encode()
    codes, distinct = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    values, starts, lengths = ids_of(distinct)
    values = np.append(values, np.uint32(end_id)).astype("<u4")
    starts, lengths = np.append(starts, len(values) - 1), np.append(lengths, 1)
    # The end id as one more word after each text's words.
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    codes = np.insert(codes.astype(np.int64), ends, len(distinct))
    ids = gather(values, starts[codes], lengths[codes])
    counted = np.concatenate(([0], np.cumsum(lengths[codes])))
    bounds = counted[ends + np.arange(1, len(texts) + 1)]
    return np.split(ids, bounds[:-1]) if len(texts) else []


# --- packing ----------------------------------------------------------------


def fill(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length make the largest sum of at most ``capacity``.

    Bit ``s`` of the bitset tells that the lengths so far can make the sum ``s``.
    ``lengths`` are tried from the longest; it stops once ``capacity`` is met.
    """
    everything = (1 << (capacity + 1)) - 1
    sums, before, tried = 1, [], []
    for length in reversed(lengths[: bisect_right(lengths, capacity)]):
        before.append(sums)
        tried.append(length)
        left, some = min(counts[length], capacity // length), 1
        while left:  # any count up to the one there is, in doubling steps
            some = min(some, left)
            sums |= (sums << (some * length)) & everything
            left, some = left - some, 2 * some
        if sums >> capacity:
            break
    total, taken = sums.bit_length() - 1, {}
    for length, reached in zip(reversed(tried), reversed(before), strict=True):
        n = 0
        while not reached >> total & 1:
            total, n = total - length, n + 1
        if n:
            taken[length] = n
    return taken


class Pool:
    """Documents, or what is left of them, by remaining length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.lengths: list[int] = []  # the distinct ones, ascending
        self.counts: dict[int, int] = {}
        self.held: dict[int, list] = defaultdict(list)
        self.tokens = 0

    def put(self, doc, start: int, ids: np.ndarray, tokens: int) -> None:
        n = len(ids)
        if not self.counts.get(n):
            insort(self.lengths, n)
            self.counts[n] = 0
        self.counts[n] += 1
        self.held[n].append((doc, start, ids, tokens))
        self.tokens += n

    def take(self, n: int):
        self.counts[n] -= 1
        if not self.counts[n]:
            del self.lengths[bisect_right(self.lengths, n) - 1]
        self.tokens -= n
        return self.held[n].pop()

    def cut(self, n: int):
        """A piece of ``n`` ids off the longest document; the rest of it stays."""
        doc, start, ids, tokens = self.take(self.lengths[-1])
        if len(ids) > n:
            self.put(doc, start + n, ids[n:], tokens)
        return doc, start, ids[:n], tokens

    def window(self) -> list:
        """The pieces of the next window; full as long as the pool can fill it."""
        pieces = [self.take(self.lengths[-1])]
        room = self.capacity - len(pieces[0][2])
        if room:
            for length, n in fill(self.lengths, self.counts, room).items():
                pieces += [self.take(length) for _ in range(n)]
                room -= n * length
        while room and self.tokens:
            pieces.append(self.cut(min(room, self.lengths[-1])))
            room -= len(pieces[-1][2])
        return pieces

    def rest(self) -> Iterator[list]:
        """The last sequences: all the pool holds, in powers of two."""
        while self.tokens:
            room, pieces = min(self.capacity, 1 << (self.tokens.bit_length() - 1)), []
            while room:
                pieces.append(self.cut(min(room, self.lengths[-1])))
                room -= len(pieces[-1][2])
            yield pieces


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096) -> DataFrame:
    """The pieces of every document's ids, packed into sequences.

    ``docs``: doc_id, text.  ``vocabulary``: the contents of a tokenizer file.
    ``capacity``: a power of two.  Returns, for each piece, doc_id, start (its
    document's ids before it), length, ids (little-endian, 32 bits each),
    doc_tokens (with ``end_id``), sequence_id (unique, not gapless) and offset.
    Every sequence is full or a power of two long.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", "text")
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)] + [
        T.StructField(n, t) for n, t in (("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()),
                                         ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()))])
    shared = spark.sparkContext.broadcast(vocabulary)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, pool = word_ids(shared.value), Pool(capacity)
        sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        doc_type, names = None, schema.fieldNames()

        def emit(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, tokens in pieces:
                out.append((doc, start, len(ids), ids.tobytes(), tokens, sequence, offset))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [doc_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            doc_type = batch.column(0).type
            for part in slices(batch, "text", LOOK_BYTES):
                for doc, ids in zip(part.column(0).to_pylist(), tokenise(part.column(1), ids_of, end_id), strict=True):
                    whole = len(ids) - len(ids) % capacity
                    for at in range(0, whole, capacity):
                        emit([(doc, at, ids[at:at + capacity], len(ids))])
                    if whole < len(ids):
                        pool.put(doc, whole, ids[whole:].copy(), len(ids))
                if pool.tokens >= POOL_TOKENS:
                    while pool.tokens >= max(POOL_TOKENS // 2, capacity):
                        emit(pool.window())
                if out:
                    yield flush()
        while pool.tokens >= capacity:
            emit(pool.window())
        for pieces in pool.rest():
            emit(pieces)
        if out:
            yield flush()

    return rows.mapInArrow(packed, schema)
