"""Line dedup over a store of line hashes in levelled, sorted runs.

A run is a table (hash, n): in how many documents of some batches a line was
found, bucketed by hash and sorted within its buckets.  A new batch is reduced
to one row per line, anti-joined with the merged runs, which drops the lines
known to be frequent already (their count no longer matters), and what is left
becomes a run of level 0.  When a level has ``fanout`` runs they are merged into
one run of the next level.  Runs share their buckets, so that a batch is held
against any number of runs, and two runs are merged, by sort-merge joins that
shuffle no run.

Stops.  A run counts once what it is about has been written behind it: the runs it
replaces and the batches it holds.  Opening the store passes over (and removes) runs
without that and runs that a complete one replaces, so a stop at any point, between
writing a merged run and deleting the old ones too, leaves every count right.  A
batch with a name that the store holds already is not counted again.

A line's hash is 128 bits of its key.  In a task, a document's lines are hashed
once and repeated lines of a document count once, so that what is shuffled is at
most a row per distinct line and task.

Defined results.  Null or empty text is one empty line.  A line's key is the
line with space and U+0009 to U+000D stripped at both ends and A-Z lower-cased.
Keys of at least ``min_chars`` code points in at least ``min_docs`` documents
lose all their lines; a document that loses every line has an empty text.  Each
row is a document, rows that repeat too, whatever its ``doc_id``.  An empty
table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panes.session import scratch_path

from .common import BROADCAST_ROWS, delete_path, list_paths, ship_package, write_table
from .words import slices

#: White space that is stripped: U+0020 and U+0009 to U+000D (fixed value).
SPACES = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None) -> tuple[list[str], list[bytes]]:
    """The lines of a text, and their keys."""
    raw = (text or "").encode()
    return raw.split(b"\n"), [x.strip(SPACES).lower() for x in raw.split(b"\n")]


class LineRuns:
    """The store, in folder ``path``; opened again by its path.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 2, buckets: int = 64):
        self.spark, self.path, self.fanout = spark, path, fanout
        names = list_paths(spark, path)
        self.buckets = next((int(n.split("-")[3]) for n in names if n.startswith("run-")), buckets)
        found = sorted(tuple(map(int, n.split("-")[1:3])) for n in names if re.fullmatch(r"run-\d+-\d+-\d+", n))
        self.next = 1 + max((n for _, n in found), default=-1)
        about = {r: self._read_about(r) for r in found}
        replaced = {tuple(x) for a in about.values() if a for x in a["replaces"]}
        self.runs = [r for r in found if about[r] and r not in replaced]
        self.batches = {r: about[r]["batches"] for r in self.runs}
        for run in found:
            if run not in self.runs:
                self._remove(run)

    def _read_about(self, run: tuple[int, int]) -> dict | None:
        folder = os.path.join(self._folder(run), "_about")
        if "_SUCCESS" not in list_paths(self.spark, folder):
            return None
        # The reader passes over names that begin with an underscore, but not over the folder it is given.
        return json.loads(self.spark.read.text(folder).first()[0])

    def _write_about(self, run: tuple[int, int], about: dict) -> None:
        rows = self.spark.createDataFrame([(json.dumps(about),)], "value string")
        rows.coalesce(1).write.text(os.path.join(self._folder(run), "_about"))

    def _remove(self, run: tuple[int, int]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS panes_run_{hashlib.md5(self._folder(run).encode()).hexdigest()}")
        delete_path(self.spark, self._folder(run))

    def _folder(self, run: tuple[int, int]) -> str:
        return os.path.join(self.path, f"run-{run[0]}-{run[1]}-{self.buckets}")

    def _table(self, run: tuple[int, int]) -> DataFrame:
        folder = self._folder(run)
        name = "panes_run_" + hashlib.md5(folder.encode()).hexdigest()
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (hash BINARY, n BIGINT) USING parquet "
                       f"CLUSTERED BY (hash) SORTED BY (hash) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame, level: int, shuffled: bool, batches: list[str], replaces: list[tuple[int, int]]) -> None:
        run = (level, self.next)
        self.next += 1
        name = "panes_run_" + hashlib.md5(self._folder(run).encode()).hexdigest()
        if shuffled:
            rows = rows.repartition(self.buckets, "hash")
        (rows.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
            .option("path", self._folder(run)).saveAsTable(name))
        self._write_about(run, {"replaces": replaces, "batches": batches})
        self.runs = sorted({*self.runs, run} - set(replaces))
        self.batches[run] = batches

    def _merged(self, runs: list[tuple[int, int]]) -> DataFrame:
        # Not a union: in Spark 4.1 the union of two bucketed tables, grouped by the
        # bucketing column, leaves groups apart.
        first, *others = map(self._table, runs)
        for other in others:
            n = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            first = first.join(other.withColumnRenamed("n", "m").hint("merge"), "hash", "full").select("hash", n.alias("n"))
        return first

    def counts(self) -> DataFrame:
        """hash, n over all batches; exact for lines not yet called frequent in ``add``."""
        if not self.runs:
            return self.spark.createDataFrame([], "hash binary, n long")
        return self._merged(self.runs)

    def _unfinished(self, batch: DataFrame, enough: int) -> DataFrame:
        """``batch`` without the lines that the runs together have ``enough`` times."""
        rows, seen = batch.select("hash", "n").repartition(self.buckets, "hash"), F.lit(0)
        for i, run in enumerate(self.runs):
            rows = rows.join(self._table(run).withColumnRenamed("n", f"n{i}").hint("merge"), "hash", "left")
            seen = seen + F.coalesce(f"n{i}", F.lit(0))
        return rows.filter(seen < enough).select("hash", "n")

    def add(self, batch: DataFrame, enough: int, name: str | None = None) -> None:
        """Take in a batch (hash, n: a row for each line); lines found ``enough`` times before are done.

        ``name``: a batch of that name is taken in once, however often it is added.
        """
        if name is None or not any(name in own for own in self.batches.values()):
            self._write(self._unfinished(batch, enough), 0, True, [] if name is None else [name], [])
        level = 0
        while len(full := [r for r in self.runs if r[0] == level]) >= self.fanout:
            self._write(self._merged(full), level + 1, False, sorted(x for r in full for x in self.batches[r]), full)
            for run in full:
                self._remove(run)
                del self.batches[run]
            level += 1


def _hash_rows(texts: DataFrame, others: list[str], min_chars: int) -> DataFrame:
    """``others`` and one ``hash`` for each distinct line of each text."""
    schema = T.StructType([texts.schema[c] for c in others] + [T.StructField("hashes", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text"):
                found = []
                for text in part.column("text").to_pylist():
                    keys = {k for k in line_keys(text)[1] if len(k) >= min_chars}
                    if min_chars > 1:
                        keys = {k for k in keys if len(k.decode()) >= min_chars}
                    found.append([xxhash.xxh3_128_digest(k) for k in keys])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], pa.array(found, pa.list_(pa.binary()))],
                                                 schema.fieldNames())

    return texts.select(*others, "text").mapInArrow(run, schema).select(*others, F.explode("hashes").alias("hash"))


_FREQUENT: dict[int, frozenset] = {}


def _without(texts: DataFrame, others: list[str], frequent, per_row: bool) -> DataFrame:
    """``others``, the kept text, n_lines and n_dropped.

    ``frequent``: a broadcast of all frequent hashes in a row, or, with
    ``per_row``, unused: then column ``gone`` has those of the row's text.
    """
    schema = T.StructType([texts.schema[c] for c in others] + [
        T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        gone: frozenset = frozenset()
        if not per_row:
            if id(frequent) not in _FREQUENT:
                _FREQUENT.clear()
                _FREQUENT[id(frequent)] = frozenset(frequent.value[i:i + 16] for i in range(0, len(frequent.value), 16))
            gone = _FREQUENT[id(frequent)]
        for batch in batches:
            for part in slices(batch, "text"):
                rows, kept, total, dropped = part.column("text").to_pylist(), [], [], []
                gones = part.column("gone").to_pylist() if per_row else None
                for i, text in enumerate(rows):
                    lines, keys = line_keys(text)
                    here = frozenset(gones[i] or ()) if per_row else gone
                    # An empty key is never stored, so it is never among them.
                    left = [x for x, k in zip(lines, keys, strict=True) if xxhash.xxh3_128_digest(k) not in here] if here else lines
                    kept.append(b"\n".join(left).decode())
                    total.append(len(lines))
                    dropped.append(len(lines) - len(left))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in others], pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                    schema.fieldNames())

    return texts.select(*others, "text", *(["gone"] if per_row else [])).mapInArrow(run, schema)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, runs: LineRuns | None = None,
                        batches: int = 3, most_broadcast: int = BROADCAST_ROWS, name: str | None = None) -> DataFrame:
    """doc_id, text (without frequent lines), n_lines and n_dropped for every row of ``docs``.

    ``name`` names the documents in a store that outlives the call: called again
    after a stop, with the same name, no batch is counted twice.

    The documents are taken in by ``batches`` hash-chosen batches, each counted
    into ``runs`` (a new store if none is given; a given one also counts what it
    has seen before).  Up to ``most_broadcast`` frequent hashes (16 bytes each)
    go to all tasks; if there are more, lines and hashes are joined by shuffles.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if runs is None:
        runs = LineRuns(spark, scratch_path(spark, "line-runs"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select("doc_id", "text")
    cut = texts.withColumn("batch", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches)).cast("int"))
    counted = write_table(_hash_rows(cut, ["batch"], min_chars).groupBy("batch", "hash").agg(F.count(F.lit(1)).alias("n")),
                          "line-counts", partition_by=["batch"])
    for b in range(batches):
        runs.add(counted.filter(F.col("batch") == b), min_docs, None if name is None else f"{name}:{b}")
    frequent = write_table(runs.counts().filter(F.col("n") >= min_docs).select("hash"), "frequent-lines")
    if frequent.limit(most_broadcast + 1).count() <= most_broadcast:
        shared = spark.sparkContext.broadcast(b"".join(bytes(r["hash"]) for r in frequent.collect()))
        return _without(texts, ["doc_id"], shared, per_row=False)
    # What a text loses depends on the text alone.
    keyed = texts.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    hits = _hash_rows(keyed, ["key"], min_chars).join(frequent, "hash").groupBy("key").agg(F.collect_set("hash").alias("gone"))
    return _without(keyed.join(hits, "key", "left"), ["doc_id"], None, per_row=True)
