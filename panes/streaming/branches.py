"""All branches of a fan-out from one read of the source.

``sinks.fan_out`` starts a query for each branch, and each reads and parses the
source.  Here one query does: its ``foreachBatch`` parses a micro-batch once,
keeps it for the writes, and hands out the window counts that fire, the records
republished, the messages that cannot be read, and the late rows.

The open windows are a table of their own, ``<checkpoint>/panes/batch_id=<id>``:
a row for each open window with its count, and the latest time seen.  A batch's
result depends on the batch and on the table of the batch before, and every
write replaces what the same batch wrote before.  So a batch that is run again
after a failure, between any two writes, gives each row once.  Counts are folded
in every task before they are shuffled; raw rows are never shuffled.

A row is late if the end of its window is not after the watermark, the latest
time in the batches before less ``delay``; late rows are in no count.  Windows
whose end the watermark has passed after a batch fire with that batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import decode_utf8, encode_utf8
from ..functions.timestamps import duration_us, micros_to_ntz
from ..operators.windows import COUNT
from .event_time import payload_time
from .sinks import print_tap, publish

#: What a batch hands out.
BRANCHES = ("counts", "records", "rejects", "late")
#: Writes one branch of one batch; called again with the same batch id after a failure.
Writer = Callable[[DataFrame, int], None]

_STATE = "pane_us long, n long, mark_us long"


def folder(path: str, format: str = "parquet") -> Writer:
    """A writer to ``<path>/batch_id=<id>``, which a repeated batch replaces."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").format(format).save(os.path.join(path, f"batch_id={batch_id}"))

    return write


def sent_to(format: str, options: dict) -> Writer:
    """A writer of every ``value`` to a bus: a batch that is run again is sent again."""
    return lambda rows, batch_id: publish(rows, format, **options)


def printed(label: str) -> Writer:
    """A writer that prints every row, by the task that has it."""
    return lambda rows, batch_id: print_tap(rows, label).write.format("noop").mode("overwrite").save()


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a branch."""
    return spark.read.schema(schema + ", batch_id long").parquet(path).drop("batch_id")


def _state_path(checkpoint: str, batch_id: int) -> str:
    return os.path.join(checkpoint, "panes", f"batch_id={batch_id}")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _open(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """The open windows (pane_us, n) after a batch, and the latest time seen."""
    path = _state_path(checkpoint, batch_id)
    fs, p = _fs(spark, path)
    if batch_id < 0 or not fs.exists(p):
        return spark.createDataFrame([], "pane_us long, n long"), None
    table = spark.read.schema(_STATE).parquet(path)
    return table.where("pane_us is not null").select("pane_us", "n"), table.agg(F.max("mark_us")).first()[0]


def _panes(at: Column, size_us: int) -> Column:
    return at - F.pmod(at, F.lit(size_us))


def _counts(fired: DataFrame, size_us: int) -> DataFrame:
    return fired.select(micros_to_ntz("pane_us").alias("window_start"),
                        micros_to_ntz(F.col("pane_us") + F.lit(size_us)).alias("window_end"), F.col("n").alias(COUNT))


def fan_out_once(messages: DataFrame, writers: dict[str, Writer], checkpoint: str, size: str = "10 seconds", field: str = "timestamp",
                 delay: str = "0 seconds", basis: str = "event", mode: str = "permissive", trigger: dict | None = None,
                 name: str | None = None) -> StreamingQuery:
    """Start the query over ``messages`` (data, publish_time); see the module's text.

    ``writers`` has a writer for some or all of ``BRANCHES``: counts (window_start,
    window_end, n), records (value), rejects (data, publish_time) and late
    (window_start, data, publish_time).  ``basis``: whether the watermark follows
    the ``event`` time or the ``publish`` time.  Strict mode fails on a message
    that cannot be read, and has no rejects.
    """
    if unknown := set(writers) - set(BRANCHES):
        raise ValueError(f"no such branches: {sorted(unknown)}")
    if basis not in ("event", "publish"):
        raise ValueError("basis must be 'event' or 'publish'")
    spark, size_us, delay_us = messages.sparkSession, duration_us(size), duration_us(delay)
    at = F.unix_micros(payload_time("data", field, mode))
    mark = at if basis == "event" else F.unix_micros("publish_time")
    parsed = messages.select("data", "publish_time", at.alias("at_us"), mark.alias("mark_us"))

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before, seen = _open(session, checkpoint, batch_id - 1)
            good = held.where(F.col("at_us").isNotNull())
            pane = _panes(F.col("at_us"), size_us)
            # No watermark yet: nothing is late.
            late = F.lit(False) if seen is None else pane + F.lit(size_us) <= F.lit(seen - delay_us)
            if "records" in writers:
                writers["records"](good.select(encode_utf8(decode_utf8("data")).alias("value")), batch_id)
            if "rejects" in writers:
                writers["rejects"](held.where(F.col("at_us").isNull()).select("data", "publish_time"), batch_id)
            if "late" in writers:
                writers["late"](good.where(late).select(micros_to_ntz(pane).alias("window_start"), "data", "publish_time"), batch_id)
            own = good.where(~late).select(pane.alias("pane_us"), F.lit(1).cast("long").alias("n"))
            now = held.where(F.col("at_us").isNotNull()).agg(F.max("mark_us")).first()[0]
            latest = max((x for x in (seen, now) if x is not None), default=None)
            table = before.unionByName(own).groupBy("pane_us").agg(F.sum("n").alias("n"))
            fires = F.lit(False) if latest is None else F.col("pane_us") + F.lit(size_us) <= F.lit(latest - delay_us)
            if "counts" in writers:
                writers["counts"](_counts(table.where(fires), size_us), batch_id)
            left = table.where(~fires).select("pane_us", "n", F.lit(None).cast("long").alias("mark_us"))
            marks = session.createDataFrame([(None, None, latest)], _STATE)
            left.unionByName(marks).write.mode("overwrite").parquet(_state_path(checkpoint, batch_id))
        finally:
            held.unpersist()
        # A batch that is run again needs the table of the batch before it; older ones are done with.
        fs, p = _fs(session, _state_path(checkpoint, batch_id - 2))
        fs.delete(p, True)

    w = parsed.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(checkpoint, "query"))
    w = w.queryName(name) if name else w
    trigger = {"availableNow": True} if trigger is None else trigger
    return (w.trigger(**trigger) if trigger else w).start()


def write_messages_once(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, write: Writer | None = None) -> StreamingQuery:
    """Message sink (K1) that holds every message once: a batch's messages (``value``,
    and ``key`` if there is one) go to ``<path>/batch_id=<id>``.

    A failure after the write and before Spark's commit runs the batch again, with
    the same messages, and the folder is replaced.  ``write``: another writer that
    a repeated batch does not change.
    """
    columns = [c for c in ("key", "value") if c in messages.columns]
    w = messages.select(*columns).writeStream.foreachBatch(write or folder(path)).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if trigger is None else trigger
    return (w.trigger(**trigger) if trigger else w).start()


def drain(spark: SparkSession, checkpoint: str, write: Writer, size: str = "10 seconds") -> None:
    """Fire the windows that are still open when a bounded input has ended, as batch -1.

    Call it when the query has ended for good: it leaves the table of open windows
    as it is, so that calling it again replaces the same counts.
    """
    fs, p = _fs(spark, os.path.join(checkpoint, "panes"))
    ids = [int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(p)] if fs.exists(p) else []
    table, _ = _open(spark, checkpoint, max(ids, default=-1))
    write(_counts(table, duration_us(size)), -1)
