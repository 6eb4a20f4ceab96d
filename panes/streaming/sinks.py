"""Sinks, taps, fan-out and running.

Every streaming sink has its own checkpoint under the shared checkpoint
folder, so a query restarted after a lost executor or driver resumes from its
committed offsets and state.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import encode_utf8, to_json_record
from ..session import scratch_path


def reserialize(records: DataFrame, parsed_col: str) -> DataFrame:
    """Re-serialise a parsed record (``json.dumps`` of ``json.loads``) as bytes.

    JSON-equal to the input; VARIANT writes object keys sorted.
    """
    return records.select(encode_utf8(to_json_record(parsed_col)).alias("value"))


def with_types(df: DataFrame) -> DataFrame:
    """Typed tap (K4): each column next to its SQL type name."""
    return df.select("*", *[F.typeof(c).alias(f"{c}_type") for c in df.columns])


def print_tap(df: DataFrame, label: str = "") -> DataFrame:
    """Print tap (K3): every row is printed by the task that has it, one line
    each, to its standard output (an executor's log), and passed on unchanged."""
    def lines(batches):
        for batch in batches:
            for row in batch.to_pylist():
                # One write a line: print writes the line end apart, and workers share an output.
                sys.stdout.write(label + str(tuple(row.values())) + "\n")
                sys.stdout.flush()
            yield batch

    return df.mapInArrow(lines, df.schema)


@dataclass
class Sink:
    """Where one branch goes: ``format`` plus options (path, topic, servers)."""
    format: str = "parquet"
    options: dict = field(default_factory=dict)
    output_mode: str = "append"
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    checkpoint: str | None = None
    tap: str | None = None  # print each row, after this label, before it is written


def write_stream(df: DataFrame, sink: Sink, name: str) -> StreamingQuery:
    """Start one streaming write with its own checkpoint (K1 / K2 stream form)."""
    spark = df.sparkSession
    chk = sink.checkpoint or scratch_path(spark, f"{name}-checkpoint")
    if sink.tap is not None:
        df = print_tap(df, sink.tap)
    w = (df.writeStream.format(sink.format).options(**sink.options)
           .outputMode(sink.output_mode).option("checkpointLocation", chk)
           .queryName(name))
    if sink.trigger:  # empty: Spark's default, a new micro-batch as soon as possible
        w = w.trigger(**sink.trigger)
    return w.start()


def write_messages(messages: DataFrame, sink: Sink, name: str = "publish") -> StreamingQuery:
    """Message sink (K1): only the ``value`` column (plus ``key`` when present)."""
    cols = [c for c in ("key", "value") if c in messages.columns]
    return write_stream(messages.select(*cols), sink, name)


def publish(messages: DataFrame, format: str, mode: str = "append", **options) -> None:
    """Batch publish (K2): write every ``value`` once, from the executors."""
    cols = [c for c in ("key", "value") if c in messages.columns]
    messages.select(*cols).write.format(format).mode(mode).options(**options).save()


def fan_out(branches: dict[str, tuple[DataFrame, Sink]], checkpoint: str | None = None) -> dict[str, StreamingQuery]:
    """One definition feeding several branches (D1): one query per branch,
    each with its own checkpoint, all running together.

    With ``checkpoint``, a branch's checkpoint is ``<checkpoint>/<branch>``: a job
    started again with the same folder goes on where it stopped.  Each branch
    reads the source by itself, so ``n`` branches read it ``n`` times; on a bus
    where that matters, publish once and derive the rest from what was published.
    """
    started: dict[str, StreamingQuery] = {}
    for name, (df, sink) in branches.items():
        if checkpoint and not sink.checkpoint:
            sink = replace(sink, checkpoint=os.path.join(checkpoint, name))
        try:
            started[name] = write_stream(df, sink, name)
        except Exception:
            for q in started.values():
                q.stop()
            raise
    return started


def run_available(queries: StreamingQuery | dict[str, StreamingQuery],
                  timeout: float | None = None, stop_at_timeout: bool = False) -> None:
    """Block until all queries finish (``wait_until_finish``, D4).

    When one fails the others are stopped and its failure is raised, whatever
    the others are doing.  With ``timeout``, queries still running after so many
    seconds are stopped; that is an error unless ``stop_at_timeout`` (a
    continuous job run for a while).
    """
    qs = [queries] if isinstance(queries, StreamingQuery) else list(queries.values())
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while True:
            running = [q for q in qs if q.isActive]  # first: a query may fail between the two looks
            for q in qs:
                if q.exception() is not None:
                    raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
            if not running:
                return
            if end is not None and time.monotonic() > end:
                if stop_at_timeout:
                    return
                raise TimeoutError(f"streaming query {running[0].name} did not finish in {timeout} s")
            time.sleep(0.1)
    finally:
        for q in qs:
            q.stop()


def materialize(df: DataFrame, name: str, output_mode: str = "append",
                timeout: float | None = None) -> DataFrame:
    """Run a stream over all data available now into parquet under the shared
    checkpoint folder; return the committed result as a batch DataFrame."""
    out = scratch_path(df.sparkSession, f"{name}-out")
    run_available(write_stream(df, Sink("parquet", {"path": out}, output_mode), os.path.basename(out)), timeout)
    return df.sparkSession.read.schema(df.schema).parquet(out)


#: The end record of a bounded input: a message later than any window that counts.
END_TIME = "9999-01-01 00:00:00"


def end_record(spark: SparkSession) -> DataFrame:
    """One message whose payload and publish time name ``END_TIME``."""
    payload = '{"timestamp": "' + END_TIME + '", "end": true}'
    return spark.range(1).select(encode_utf8(F.lit(payload)).alias("data"), F.lit(END_TIME).cast("timestamp").alias("publish_time"))


def with_end(messages: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """The messages followed by an end record, and what puts the record there.

    A watermark only passes the windows before the last event.  So run a query
    over these messages to the end of its input, put the end record behind it,
    and run the query again from its checkpoint: the record moves the watermark
    past every real window, which then fire.  The record's own windows never
    close, so it is not counted.
    """
    spark = messages.sparkSession
    ends = scratch_path(spark, f"{name}-ends")
    # The folder exists, and has no record, from the start.
    end_record(spark).limit(0).write.parquet(ends)
    behind = spark.readStream.schema("data binary, publish_time timestamp").parquet(ends)
    both = messages.select("data", "publish_time").unionByName(behind)
    return both, lambda: end_record(spark).write.mode("append").parquet(ends)


def materialize_to_end(messages: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Run ``build(messages)`` over a bounded input to its end: every window closes."""
    spark = messages.sparkSession
    out, chk = (scratch_path(spark, f"{name}-{x}") for x in ("out", "checkpoint"))
    both, put_end = with_end(messages, name)
    counts = build(both)
    for last in (False, True):
        if last:
            put_end()
        run_available(write_stream(counts, Sink("parquet", {"path": out}, checkpoint=chk), os.path.basename(out)))
    return spark.read.schema(counts.schema).parquet(out)


def materialize_firings(df: DataFrame, name: str, panes: int, every: str = "1 second",
                        then: tuple[int, Callable[[], None]] | None = None, settle: float = 0,
                        checkpoint: str | None = None) -> DataFrame:
    """Run a processing-time-fired stream until ``panes`` panes have fired, then
    stop it; return what was committed as a batch DataFrame.

    ``availableNow`` does not end while timers are pending, so the caller says
    how many panes the input opens.  ``then``: once so many have fired, call
    this (for instance to let more messages arrive); the stream then goes on for
    ``settle`` seconds at least after it has read them, so that a pane fired
    twice would show.
    """
    spark = df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    q = write_stream(df, Sink("parquet", {"path": out}, "append", {"processingTime": every}, checkpoint), os.path.basename(out))
    try:
        fired, sent, read_by = 0, False, None
        while fired < panes or (sent and (read_by is None or time.monotonic() < read_by + settle)):
            if q.exception() is not None:
                raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
            # Progress is reported only after a batch commits, and by then the
            # sink's log exists: the read goes through it, so it sees
            # committed files only.
            fired = spark.read.schema(df.schema).parquet(out).count() if q.lastProgress else 0
            if sent and read_by is None and any(p["batchId"] > last and p["numInputRows"] for p in q.recentProgress):
                read_by = time.monotonic()
            if then and not sent and fired >= then[0]:
                last, sent = q.lastProgress["batchId"], True
                then[1]()
            time.sleep(0.5)
    finally:
        q.stop()
    return spark.read.schema(df.schema).parquet(out)


class LateRows:
    """Late rows dropped over a whole run (L1).

    Spark keeps the last 100 progress reports; ``look`` adds those it has not
    seen, so call it at least once every 100 micro-batches.  Spark counts rows
    after the partial aggregate: late rows of one task and window count once.
    """

    def __init__(self) -> None:
        self.seen: dict[int, int] = {}

    def look(self, query: StreamingQuery) -> int:
        for p in query.recentProgress:
            self.seen[p["batchId"]] = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        return sum(self.seen.values())


def dropped_late_rows(query: StreamingQuery) -> int:
    """Late rows dropped over the reports Spark still has (see ``LateRows``)."""
    return LateRows().look(query)
