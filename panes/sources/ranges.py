"""One JSON document of any layout, read by many tasks (S3).

A JSON array has no marks that tell a task where an element begins: a bracket, a
comma or a line end may stand inside a string.  So the document is cut anywhere
(Spark's text reader splits it at commas, wherever they are), and

1. each range is run through the automaton of strings and brackets once for every
   state it may begin in: outside a string, inside, or behind a backslash.  What is
   left of a range is a map: the state and the change of depth at its end, and the
   depths at which it has commas outside strings;
2. a scan over a document's maps, in order, gives the state and the depth at which
   each range truly begins.  That is a row of fixed size for a whole range
   (``maxPartitionBytes``), so a document of 100 TB has less than a million;
3. each range is read again from its true state.  The commas at depth 1 are the
   borders of elements; elements inside a range come out at once, and the parts of
   one that ranges cut are put together, keyed by the range it begins in.

No task holds more of a document than a batch of the reader's rows, or one element.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lexical states: outside a string, inside, behind a backslash inside.
OUT, IN, ESCAPED = range(3)
_QUOTE, _BACK, _COMMA, _OPEN, _CLOSE = ord('"'), ord("\\"), ord(","), ord("["), ord("]")


def lex(text: bytes, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For ``text`` from ``state``: its bytes, which of them are outside strings, the depth
    behind each (from 0), and the state at the end."""
    given = np.frombuffer(text, np.uint8)
    b = np.concatenate([[_BACK], given]).astype(np.uint8) if state == ESCAPED else given
    if not len(b):
        return given, np.zeros(0, bool), np.zeros(0, np.int64), state
    at = np.arange(len(b))
    plain = np.maximum.accumulate(np.where(b != _BACK, at, -1))  # the last byte that is no backslash
    run = np.concatenate([[0], (at - plain)[:-1]])  # backslashes right before a byte
    quote = (b == _QUOTE) & (run % 2 == 0)
    inside = (np.cumsum(quote) + (state != OUT)) % 2 == 1
    outside = ~inside & ~quote  # behind a closing quote it is outside again, the quote is not
    step = np.where(outside, np.isin(b, (_OPEN, ord("{"))).astype(np.int64) - np.isin(b, (_CLOSE, ord("}"))), 0)
    depth = np.cumsum(step)
    end = (ESCAPED if (at - plain)[-1] % 2 else IN) if inside[-1] else OUT
    skip = 1 if state == ESCAPED else 0
    return given, outside[skip:], depth[skip:], end


class RangeMap:
    """What a range does to each state it may begin in, taken in piece by piece."""

    def __init__(self):
        self.ends, self.deltas = [OUT, IN, ESCAPED], [0, 0, 0]
        self.commas: list[set[int]] = [set(), set(), set()]
        self.first = b""  # the first byte that is no white space

    def take(self, text: bytes) -> None:
        self.first = self.first or text.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
        for s in (OUT, IN, ESCAPED):
            b, outside, depth, end = lex(text, self.ends[s])
            self.commas[s].update((np.unique(depth[outside & (b == _COMMA)]) + self.deltas[s]).tolist())
            self.ends[s], self.deltas[s] = end, self.deltas[s] + (int(depth[-1]) if len(depth) else 0)


def _pieces(batches):
    """(path, begin of the range, text) in order; ``text`` is what a batch has of a range, and
    commas that the reader took out stand behind every piece but a range's last."""
    held = None
    for batch in batches:
        paths, starts, values = (batch.column(i).to_pylist() for i in range(3))
        begin = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (paths[i], starts[i]) != (paths[begin], starts[begin]):
                key, text = (paths[begin], starts[begin]), ",".join(values[begin:i]).encode()
                if held is not None:
                    yield *held[0], held[1] + (b"," if held[0] == key else b"")
                held, begin = (key, text), i
    if held is not None:
        yield *held[0], held[1]


def range_maps(batches):
    """``mapInArrow`` body of the first reading."""
    import pyarrow as pa

    def row(key, m):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([m.ends], pa.list_(pa.int32())), pa.array([m.deltas], pa.list_(pa.int64())),
             pa.array([[sorted(c) for c in m.commas]], pa.list_(pa.list_(pa.int64()))), pa.array([m.first.decode("latin-1")])],
            ["path", "start", "ends", "deltas", "commas", "first"])

    key, m = None, None
    for path, start, text in _pieces(batches):
        if key != (path, start):
            if m is not None:
                yield row(key, m)
            key, m = (path, start), RangeMap()
        m.take(text)
    if m is not None:
        yield row(key, m)


_MAPS = "path string, start long, ends array<int>, deltas array<long>, commas array<array<long>>, first string"
_BEGINS = "path string, start long, state int, depth long, owner long, last boolean, fault string"


def scan(group):
    """A document's ranges, each with the state and depth it begins in, and the range in
    which the element that it begins in the middle of began."""
    import pyarrow as pa

    rows = sorted(group.to_pylist(), key=lambda r: r["start"])
    state, depth, owner, out = OUT, 0, rows[0]["start"], []
    first = next((r["first"] for r in rows if r["first"]), "")
    for i, r in enumerate(rows):
        last = i == len(rows) - 1
        out.append([r["path"], r["start"], state, depth, owner, last, None])
        border = 1 - depth in r["commas"][state]
        state, depth = r["ends"][state], depth + r["deltas"][state]
        if not last:  # the comma at which the reader cut
            border = border or state == OUT and depth == 1
            state = IN if state == ESCAPED else state
        if border:
            owner = r["start"]
    if first != "[" or state != OUT or depth != 0:
        fault = "is no JSON array" if first != "[" else "ends inside a string or an open bracket"
        for r in out:
            r[-1] = fault
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["path", "start", "state", "depth", "owner", "last", "fault"])


class Cutter:
    """Cuts a range into elements, from the state it begins in."""

    def __init__(self, state: int, depth: int):
        self.state, self.depth = state, depth
        self.held: list[bytes] = []
        self.begun = False  # whether a border of this range stands before what is held
        self.opened = False  # whether that border is the document's first bracket

    def take(self, text: bytes) -> list[tuple[bytes, bool, bool, bool]]:
        """(text, whether it began in this range, opened, closed) for each element that ends here."""
        b, outside, depth, end = lex(text, self.state)
        depth = depth + self.depth
        before = np.concatenate([[self.depth], depth[:-1]])
        comma = outside & (b == _COMMA) & (depth == 1)
        first = outside & (b == _OPEN) & (before == 0)
        close = outside & (b == _CLOSE) & (depth == 0)
        out, begin = [], 0
        for i in np.flatnonzero(comma | first | close).tolist():
            self.held.append(text[begin:i])
            if not first[i]:  # what stands before the first bracket is no element
                out.append((b"".join(self.held), self.begun, self.opened, bool(close[i])))
            self.held, self.begun, self.opened, begin = [], True, bool(first[i]), i + 1
        self.held.append(text[begin:])
        self.state, self.depth = end, int(depth[-1]) if len(depth) else self.depth
        return out


_PARTS = "path string, owner long, start long, part int, text string, opened boolean, closed boolean"


def element_parts(begins: dict):
    """``mapInArrow`` body of the second reading: elements (``part`` is null) and parts of elements."""
    def run(batches):
        import pyarrow as pa

        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
        names = [x.split()[0] for x in _PARTS.split(", ")]
        key, begin, cutter, out, size = None, None, None, [], 0

        def ended(found):
            nonlocal size
            for element, begun, opened, closed in found:
                out.append((key[0], key[1] if begun else begin[2], key[1], None if begun else 0, element.decode(), opened, closed))
                size += len(element)

        def finish():
            if not begin[3]:  # the comma that the reader cut at
                ended(cutter.take(b","))
            if cutter.depth > 0:  # what is left goes on in the next range
                out.append((key[0], key[1] if cutter.begun else begin[2], key[1], 1, b"".join(cutter.held).decode(), cutter.opened, False))

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for path, start, text in _pieces(batches):
            if key != (path, start):
                if cutter is not None:
                    finish()
                key, begin = (path, start), begins.value.get((path, start))
                cutter = Cutter(begin[0], begin[1]) if begin else None  # none: its document has a fault
            if cutter is not None:
                ended(cutter.take(text))
            if size > 8 << 20:
                yield flush()
                out, size = [], 0
        if cutter is not None:
            finish()
        if out:
            yield flush()

    return run


def array_elements(spark: SparkSession, path: str, range_bytes: int | None = None, mode: str = "strict", **options) -> DataFrame:
    """The texts of the elements of the JSON arrays under ``path``: one column ``element``.

    ``range_bytes``: bytes of a range (default: the session's split size).  Strict
    mode fails on a document that is no array or whose brackets or strings do not
    end; permissive mode leaves it out.  What is between two commas is an element,
    empty or not; an empty array has none.
    """
    own = spark
    if range_bytes is not None:
        own = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(key):
                own.conf.set(key, value)
        own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    pieces = own.read.options(**options).option("lineSep", ",").text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    ranges = pieces.mapInArrow(range_maps, _MAPS).groupBy("path").applyInArrow(scan, _BEGINS).collect()
    faults = {r["path"]: r["fault"] for r in ranges if r["fault"]}
    if faults and mode == "strict":
        raise ValueError("; ".join(f"{p} {f}" for p, f in sorted(faults.items())[:5]))
    begins = spark.sparkContext.broadcast({(r["path"], r["start"]): (r["state"], r["depth"], r["owner"], r["last"]) for r in ranges if not r["fault"]})
    # Written, as two branches read it.
    parts_path = scratch_path(spark, "document-elements")
    pieces.mapInArrow(element_parts(begins), _PARTS).write.parquet(parts_path)
    parts = spark.read.schema(_PARTS).parquet(parts_path)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "")
    cut = parts.where("part is not null").groupBy("path", "owner").agg(text.alias("text"), F.max("opened").alias("opened"), F.max("closed").alias("closed"))
    every = parts.where("part is null").select("text", "opened", "closed").unionByName(cut.select("text", "opened", "closed"))
    blank = F.trim(F.translate("text", "\t\r\n", "   ")) == ""
    return every.where(~(blank & F.col("opened") & F.col("closed"))).select(F.col("text").alias("element"))
