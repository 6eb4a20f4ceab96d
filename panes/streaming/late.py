"""Windows on event time under a watermark on publish time, late rows included.

A bus knows how far it has sent, not what times its payloads name, so the
watermark here follows ``publish_time`` while windows are on the payload's time.
A window fires once when the watermark passes its end; a row whose window's end
the watermark had passed before the row came is late.  Late rows are not dropped:
each comes out, tagged, in the same stream as the counts, so that the counts and
the late rows add up to the input.

Plan: event time and window key in the JVM -> one row per task, window and
micro-batch in Arrow (``mapInArrow``: the count, and the rows packed as bytes) ->
``groupBy(window).transformWithState`` in event-time mode, holding the open count
and a timer at the window's end; both go when the window fires.  Whether rows are
late is decided for a window as a whole, since all its rows of a micro-batch meet
the same watermark; packed rows are only opened where they are late.

A window that most rows fall in can be dealt over ``salts`` keys: each then fires
a part of the window's count, which ``pane_counts`` adds up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..functions.timestamps import duration_str, duration_us, micros_to_ntz
from ..operators.windows import COUNT
from .event_time import payload_time
from .triggers import _needs_rocksdb

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows and payload bytes of a packed row at most.
PACK_ROWS, PACK_BYTES = 4096, 1 << 20
#: The tags of the output.
COUNTED, LATE = "count", "late"

_PARTIAL = StructType([StructField("pane_key", LongType()), StructField("salt", LongType()), StructField(COUNT, LongType()),
                       StructField("rows", BinaryType())])
_OUT = StructType([StructField("kind", StringType()), StructField("pane_key", LongType()), StructField(COUNT, LongType()),
                   StructField("data", BinaryType()), StructField("publish_us", LongType())])
_STATE = StructType([StructField("n", LongType())])


def _packed(keys, salt, data, times):
    """One partial row for all of ``data`` and ``times``, which are of one window."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    table = pa.table({"data": data, "publish_us": times})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return keys, salt, table.num_rows, sink.getvalue().to_pybytes()


def partial_rows(salts: int, pack_rows: int = PACK_ROWS, pack_bytes: int = PACK_BYTES):
    """``mapInArrow`` body: a batch's rows packed by window, in pieces of a bounded size."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % salts
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by("pane_key").combine_chunks()
            out, keys = [], table.column("pane_key").to_pylist()
            sizes = pc.fill_null(pc.binary_length(table.column("data")), 0).to_pylist()
            begin, held = 0, 0
            for i in range(1, len(keys) + 1):
                held += sizes[i - 1]
                if i == len(keys) or keys[i] != keys[begin] or i - begin >= pack_rows or held >= pack_bytes:
                    own = table.slice(begin, i - begin)
                    out.append(_packed(keys[begin], salt, own.column("data"), own.column("publish_us")))
                    begin, held = i, 0
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["pane_key", "salt", COUNT, "rows"])

    return run


class LateAware(StatefulProcessor):
    """The open count of a window; a timer at its end."""

    def __init__(self, size_us: int):
        self.size_us = size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end_us = key[0] + self.size_us
        if end_us <= timerValues.getCurrentWatermarkInMs() * 1000:
            yield from self._late(key[0], rows)
            return
        add = sum(r[COUNT] for r in rows)
        if self.open.exists():
            add += self.open.get()[0]
        else:
            self.handle.registerTimer(-(-end_us // 1000))
        self.open.update((add,))

    @staticmethod
    def _late(pane_key: int, rows) -> Iterator[Row]:
        import pyarrow as pa

        for r in rows:
            for batch in pa.ipc.open_stream(bytes(r["rows"])):
                for data, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield Row(kind=LATE, pane_key=pane_key, n=1, data=data, publish_us=at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n = self.open.get()[0]
        self.open.clear()
        yield Row(kind=COUNTED, pane_key=key[0], n=n, data=None, publish_us=None)

    def close(self) -> None:
        pass


def count_with_late_rows(messages: DataFrame, size: str = "10 seconds", field: str = "timestamp", delay: str = "0 seconds",
                         mode: str = "strict", salts: int = 1) -> DataFrame:
    """Fired counts and late rows of ``messages`` (data, publish_time), output mode append.

    ``kind`` is ``count`` (``n`` rows in the window; once for a window and salt) or
    ``late`` (one row: ``n`` is 1, with its ``data`` and ``publish_time``).
    ``delay`` is the allowed lateness, on the publish time's clock.  Strict mode
    fails on a message without a readable time; permissive mode leaves it out.
    A message without a publish time moves no watermark, and counts.
    """
    _needs_rocksdb(messages)
    size_us = duration_us(size)
    if size_us % 1000:
        raise ValueError("windows of whole milliseconds: the watermark has no finer clock")
    at = F.unix_micros(payload_time("data", field, mode))
    rows = messages.withWatermark("publish_time", duration_str(delay)).select(
        (at - F.pmod(at, F.lit(size_us))).alias("pane_key"), "data", F.unix_micros("publish_time").alias("publish_us"))
    if mode != "strict":
        rows = rows.where(F.col("pane_key").isNotNull())
    out = (rows.mapInArrow(partial_rows(salts), _PARTIAL).groupBy("pane_key", "salt")
               .transformWithState(LateAware(size_us), _OUT, "Append", "EventTime"))
    return out.select("kind", micros_to_ntz("pane_key").alias("window_start"),
                      micros_to_ntz(F.col("pane_key") + F.lit(size_us)).alias("window_end"), COUNT, "data",
                      micros_to_ntz("publish_us").alias("publish_time"))


def pane_counts(fired: DataFrame) -> DataFrame:
    """The count of each window that has fired (a bounded result of ``count_with_late_rows``)."""
    return fired.where(F.col("kind") == COUNTED).groupBy("window_start", "window_end").agg(F.sum(COUNT).cast("long").alias(COUNT))


def late_rows(fired: DataFrame) -> DataFrame:
    """The late messages: their window, payload and publish time."""
    return fired.where(F.col("kind") == LATE).select("window_start", "window_end", "data", "publish_time")
