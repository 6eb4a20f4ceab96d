"""Processing-time triggers in DISCARDING mode (T4, T5, A1).

A pane opens at the first arrival for its key (the global window, or one
arrival-time window) and fires ``delay`` later by the processing-time clock.
``repeat=False`` (the reference: no ``Repeatedly``) fires each key once and
drops later arrivals; ``repeat=True`` opens a new pane at the next arrival.

Plan: payload check and arrival window key in the JVM -> per-task partial counts
in Arrow (``mapInArrow``) -> ``groupBy(key).transformWithState`` holding the open
count, or the mark of a fired pane, and one timer per open pane.  The stateful operator sees one row per key per
task per micro-batch, never the raw rows of a hot key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..functions.timestamps import duration_str, duration_us, micros_to_ntz
from ..operators.windows import COUNT, count_fixed, count_global
from ..session import scratch_path
from .event_time import arrival_time

# The processor and the Arrow function run in Python workers; ship this
# module's code with them so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PANE_KEY = "pane_key"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PARTIAL_SCHEMA = StructType([StructField(PANE_KEY, LongType()), StructField(COUNT, LongType())])
_OPEN_STATE = StructType([StructField("n", LongType())])
_CLOSED_STATE = StructType([StructField("closed", BooleanType())])


def partial_counts(batches):
    """``mapInArrow`` body: rows per pane key within one task, one batch out."""
    import pyarrow as pa

    t = None
    for b in batches:
        if not b.num_rows:
            continue
        own = pa.Table.from_batches([b]).group_by(PANE_KEY).aggregate([([], "count_all")])
        own = own.select([PANE_KEY, "count_all"]).rename_columns([PANE_KEY, COUNT])
        if t is not None:  # one row per key is held, however many batches there are
            own = pa.concat_tables([t, own]).group_by(PANE_KEY).aggregate([(COUNT, "sum")])
            own = own.select([PANE_KEY, f"{COUNT}_sum"]).rename_columns([PANE_KEY, COUNT])
        t = own
    if t is None:
        return
    keys = t.column(PANE_KEY).cast(pa.int64())
    counts = t.column(COUNT).cast(pa.int64())
    yield pa.RecordBatch.from_arrays([keys.combine_chunks(), counts.combine_chunks()],
                                     schema=pa.schema([(PANE_KEY, pa.int64()), (COUNT, pa.int64())]))


class PaneCount(StatefulProcessor):
    """Count per pane; fire ``delay_ms`` after the pane's first arrival."""

    def __init__(self, delay_ms: int, repeat: bool = False, closed_ttl_ms: int | None = None):
        self.delay_ms = delay_ms
        self.repeat = repeat
        self.closed_ttl_ms = closed_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # An open pane never expires; only the mark of a fired one may.
        self.pane = handle.getValueState("pane", _OPEN_STATE)
        self.closed = handle.getValueState("closed", _CLOSED_STATE, self.closed_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        add = sum(r[COUNT] for r in rows)
        if self.closed.exists():  # fired once already: later arrivals are dropped
            return iter([])
        n = self.pane.get()[0] if self.pane.exists() else None
        if n is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
            n = 0
        self.pane.update((n + add,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.pane.exists():
            return iter([])
        n = self.pane.get()[0]
        self.pane.clear()
        if not self.repeat:
            self.closed.update((True,))
        return iter([Row(pane_key=key[0], n=n)])

    def close(self) -> None:
        pass


def _needs_rocksdb(df: DataFrame) -> None:
    # transformWithState needs the RocksDB state store; the session is the caller's.
    if "RocksDB" not in (df.sparkSession.conf.get(STATE_PROVIDER, "") or ""):
        raise ValueError(f"processing-time panes need {STATE_PROVIDER} set to {ROCKSDB}")


def count_after_processing_time(df: DataFrame, delay: str = "10 seconds",
                                window: str | None = None, repeat: bool = False,
                                closed_ttl: str | None = None, mode: str = "strict") -> DataFrame:
    """Count per pane fired by a processing-time delay (T4 without ``window``,
    T5 with fixed windows of ``time_col``).  Streaming, output mode append.

    Output: ``n`` (global) or ``window_start, window_end, n`` (windows).
    ``df`` has messages (``data``, ``publish_time``); their payloads are decoded
    and parsed, and only good ones count (``event_time.arrival_time``).
    ``closed_ttl`` bounds how long a fired window keeps dropping arrivals; by
    default for ever, at one small row of state a window.
    """
    _needs_rocksdb(df)
    arrived = df.select(arrival_time(mode).alias("_t"))
    if mode != "strict":
        arrived = arrived.where(F.col("_t").isNotNull())
    if window is None:
        # The key hangs on the checked time, so the check stays in the plan.
        key = F.when(F.col("_t").isNotNull(), F.lit(0)).cast("long")
    else:
        size = duration_us(window)
        at = F.unix_micros("_t")
        key = at - F.pmod(at, F.lit(size))
    keyed = arrived.select(key.alias(PANE_KEY))
    ttl = duration_us(closed_ttl) // 1000 if closed_ttl else None
    proc = PaneCount(duration_us(delay) // 1000, repeat, ttl)
    panes = (keyed.mapInArrow(partial_counts, _PARTIAL_SCHEMA)
                  .groupBy(PANE_KEY)
                  .transformWithState(proc, _PARTIAL_SCHEMA, "Append", "ProcessingTime"))
    if window is None:
        return panes.select(COUNT)
    size_us = duration_us(window)
    return panes.select(micros_to_ntz(PANE_KEY).alias("window_start"),
                        micros_to_ntz(F.col(PANE_KEY) + F.lit(size_us)).alias("window_end"), COUNT)


def count_per_trigger(df: DataFrame, path: str, every: str = "10 seconds",
                      window: str | None = None, time_col: str = "publish_time",
                      checkpoint: str | None = None, available_now: bool = False):
    """Repeating, discarding panes on the trigger clock: each micro-batch
    counts only its own rows (the ``foreachBatch`` form of T4 / T5 with
    ``Repeatedly``).  Panes open on the trigger clock, not at the first
    arrival, which is the one difference from ``repeat=True`` above.

    Each batch goes to ``<path>/batch_id=<id>`` with overwrite, so a batch
    replayed after a failure replaces its own output instead of adding to it.
    Returns the started query.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = count_global(batch) if window is None else count_fixed(batch, time_col, window)
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    chk = checkpoint or scratch_path(df.sparkSession, "per-trigger-checkpoint")
    trig = {"availableNow": True} if available_now else {"processingTime": duration_str(every)}
    return (df.writeStream.foreachBatch(write).option("checkpointLocation", chk)
              .trigger(**trig).start())
