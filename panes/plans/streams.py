"""The reference's streaming pipelines, and registered queries that replay the
``events`` table as a message stream and run them to completion.

Each registered query starts the stream with ``availableNow``, writes to
parquet under the shared checkpoint folder and returns what was committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_utf8, encode_utf8, json_valid
from ..functions.timestamps import format_iso, micros_to_ntz, to_instant
from ..operators.windows import fixed_window
from ..session import scratch_path
from ..sources.messages import messages_from_records, table_stream, tap_messages
from ..sources.tables import table
from ..streaming.branches import BRANCHES, drain, fan_out_once, folder, read_folder, write_messages_once
from ..streaming.event_time import rejected, with_arrival_time, with_event_time
from ..streaming.late import COUNTED, LATE, count_with_late_rows, late_rows, pane_counts
from ..streaming.metrics import RunMetrics, observed
from ..streaming.state import fired_panes, open_panes
from ..streaming.sinks import (Sink, fan_out, materialize, materialize_firings, materialize_to_end, print_tap,
                               run_available, with_end, write_stream)
from ..streaming.triggers import ROCKSDB, STATE_PROVIDER, count_after_processing_time
from ..streaming.windows import count_on_watermark, counts_as_messages
from .queries import (FIXED_SIZE, GLOBAL_PANE_DELAY, SLIDING_PERIOD, SLIDING_SIZE,
                      WINDOW_PANE_DELAY, event_record)


# --------------------------------------------------------------- branches --

def passthrough(messages: DataFrame, mode: str = "strict") -> DataFrame:
    """Branch B of the fan-out (D1 + P1 P2 P4 P6): decode, check that the payload
    is JSON, publish it again as UTF-8 bytes.

    The checked original text is sent (JSON-equal to re-serialising it), so no
    record is rebuilt.  Strict mode fails on bad UTF-8 or JSON; permissive
    mode drops such messages.
    """
    text = decode_utf8("data", mode)
    bad = ~json_valid(text)
    if mode == "strict":
        checked = F.when(bad, F.raise_error(F.lit("message payload is not JSON"))).otherwise(text)
        return messages.select(encode_utf8(checked).alias("value"))
    return messages.where(~bad).select(encode_utf8(text).alias("value"))


def event_time_counts(messages: DataFrame, size: str = FIXED_SIZE, period: str | None = None,
                      delay: str = "0 seconds", trigger: str = "default",
                      mode: str = "strict", method: str = "expand") -> DataFrame:
    """Branch A: event time from ``timestamp``, window, count."""
    return count_on_watermark(with_event_time(messages, "timestamp", delay, mode),
                              size, period, trigger, method=method)


# --------------------------------------------------------------- pipelines --

def _with_rejects(branches: dict, messages: DataFrame, rejects: Sink | None, field: str | None) -> dict:
    return {**branches, "rejects": (rejected(messages, field), rejects)} if rejects else branches


def fixed_window_job(messages: DataFrame, count_sink: Sink, out_sink: Sink,
                     size: str = FIXED_SIZE, delay: str = "0 seconds", mode: str = "strict",
                     checkpoint: str | None = None, rejects: Sink | None = None):
    """Fixed-window count printed / stored, raw records republished (fan-out)."""
    return fan_out(_with_rejects({
        "window-counts": (event_time_counts(messages, size, None, delay, mode=mode), count_sink),
        "records": (passthrough(messages, mode), out_sink),
    }, messages, rejects, "timestamp"), checkpoint)


def sliding_window_job(messages: DataFrame, count_sink: Sink, out_sink: Sink,
                       size: str = SLIDING_SIZE, period: str = SLIDING_PERIOD,
                       delay: str = "0 seconds", mode: str = "strict",
                       checkpoint: str | None = None, rejects: Sink | None = None):
    """Sliding-window count plus the republished records (fan-out)."""
    return fan_out(_with_rejects({
        "window-counts": (event_time_counts(messages, size, period, delay, mode=mode), count_sink),
        "records": (passthrough(messages, mode), out_sink),
    }, messages, rejects, "timestamp"), checkpoint)


def watermark_count_job(messages: DataFrame, out_sink: Sink, trigger: str = "after_watermark",
                        size: str = FIXED_SIZE, delay: str = "0 seconds", mode: str = "strict",
                        checkpoint: str | None = None, rejects: Sink | None = None, tap: str | None = None):
    """Fixed-window counts published as messages (D2 with T2 / T3).  ``tap``: each
    count is printed, after this label, before it is published (K3)."""
    counts = event_time_counts(messages, size, None, delay, trigger, mode)
    counts = counts if tap is None else print_tap(counts, tap)
    return fan_out(_with_rejects({"published-counts": (counts_as_messages(counts).select("value"), out_sink)},
                                 messages, rejects, "timestamp"), checkpoint)


def global_delay_job(messages: DataFrame, count_sink: Sink, out_sink: Sink,
                     delay: str = "10 seconds", repeat: bool = False, mode: str = "strict",
                     checkpoint: str | None = None, rejects: Sink | None = None):
    """Global window fired by a processing-time delay (T4), plus the republished
    records (fan-out).  Needs a processing-time trigger on ``count_sink``."""
    return fan_out(_with_rejects({
        "pane-counts": (count_after_processing_time(messages, delay, None, repeat, mode=mode), count_sink),
        "records": (passthrough(messages, mode), out_sink),
    }, messages, rejects, None), checkpoint)


def processing_time_count_job(messages: DataFrame, out_sink: Sink, size: str = FIXED_SIZE,
                              delay: str = "30 seconds", repeat: bool = False, mode: str = "strict",
                              checkpoint: str | None = None, rejects: Sink | None = None, tap: str | None = None):
    """Fixed windows of arrival time, each fired once ``delay`` after its first
    arrival (T5), counts published as messages (D2), and printed if ``tap`` (K3)."""
    counts = count_after_processing_time(messages, delay, size, repeat, mode=mode)
    counts = counts if tap is None else print_tap(counts, tap)
    return fan_out(_with_rejects({"published-counts": (counts_as_messages(counts).select("value"), out_sink)},
                                 messages, rejects, None), checkpoint)


# ------------------------------------------------------ registered queries --

def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` replayed as a bus: each row's JSON, published at ``ts``."""
    ev = table_stream(spark, sf_dir, "events")
    return messages_from_records(ev, event_record(ev), "ts")


def stream_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed 10 s event-time windows, append mode."""
    return materialize_to_end(event_messages(spark, sf_dir), lambda m: event_time_counts(m, FIXED_SIZE), "stream_fixed_window")


def stream_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding 20 s / 10 s event-time windows."""
    return materialize_to_end(event_messages(spark, sf_dir), lambda m: event_time_counts(m, SLIDING_SIZE, SLIDING_PERIOD),
                              "stream_sliding_window")


def stream_sliding_window_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sliding windows from 10 s slices summed by a chained
    windowed aggregate (the opt-in plan for wide windows; the replay has no
    late rows, so it equals the default plan)."""
    return materialize_to_end(event_messages(spark, sf_dir),
                              lambda m: event_time_counts(m, SLIDING_SIZE, SLIDING_PERIOD, method="slices"),
                              "stream_sliding_window_slices")


def _published_counts(spark: SparkSession, sf_dir: str, trigger: str, name: str) -> DataFrame:
    out = materialize_to_end(
        event_messages(spark, sf_dir),
        lambda m: counts_as_messages(event_time_counts(m, FIXED_SIZE, trigger=trigger)).select("value"), name)
    return out.select(decode_utf8("value").alias("value"))


def stream_count_after_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per window, fired on the watermark, published."""
    return _published_counts(spark, sf_dir, "after_watermark", "stream_count_after_watermark")


def stream_count_default_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the default trigger."""
    return _published_counts(spark, sf_dir, "default", "stream_count_default_trigger")


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message source, both branches of the fixed-window job at once
    (counts, and the records republished), each through its own sink.  Run
    twice from one checkpoint: the second run closes the last windows."""
    counts, records, chk = (scratch_path(spark, f"stream_fan_out-{x}") for x in ("counts", "records", "checkpoint"))
    messages = event_messages(spark, sf_dir)
    to_end, put_end = with_end(messages, "stream_fan_out")
    for last in (False, True):
        if last:
            put_end()
        run_available(fan_out({"window-counts": (event_time_counts(to_end), Sink("parquet", {"path": counts})),
                               "records": (passthrough(messages), Sink("parquet", {"path": records}))}, chk))
    counted = spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, n long").parquet(counts)
    sent = spark.read.schema("value binary").parquet(records)
    return counted.select(F.lit("counts").alias("branch"), "window_start", "n", F.lit(None).cast("string").alias("payload")).unionByName(
        sent.select(F.lit("records").alias("branch"), F.lit(None).cast("timestamp_ntz").alias("window_start"),
                    F.lit(None).cast("long").alias("n"), decode_utf8("value").alias("payload")))


# Fifths of the time range of ``events``, in the order they are sent.
LATE_ORDER = (2, 3, 0, 4, 1)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: ``events`` sent out of time order, a fifth of the time range a
    micro-batch, allowed lateness 0.

    A batch's rows are held against the watermark of the batch before, which is
    the latest time up to then.  So fifth 0, sent third, is late behind fifth 2,
    and fifth 1, sent last, behind fifth 3: neither is counted.
    """
    ev = table(spark, sf_dir, "events")
    replay = _in_fifths(spark, ev, LATE_ORDER, "stream_late_rows")
    return materialize_to_end(messages_from_records(replay, event_record(replay), "ts"),
                              lambda m: event_time_counts(m, FIXED_SIZE), "stream_late_rows")


def _time_range(ev: DataFrame) -> tuple[int, int]:
    """The first and the last time of ``events`` in microseconds."""
    at = F.unix_micros(to_instant("ts", ev.schema["ts"].dataType))
    return tuple(ev.select(F.coalesce(F.min(at), F.lit(0)), F.coalesce(F.max(at), F.lit(0))).first())


def _in_fifths(spark: SparkSession, ev: DataFrame, order: tuple[int, ...], name: str) -> DataFrame:
    """``ev`` replayed a fifth of its time range a micro-batch, the fifths in ``order``."""
    at = F.unix_micros(to_instant("ts", ev.schema["ts"].dataType))
    low, high = _time_range(ev)
    part = F.floor((at - F.lit(low)) * 5 / F.lit(high - low + 1))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bus = scratch_path(spark, f"{name}-bus")
    for fifth in order:
        # Numbered by row, so that each of the files gets rows: a batch is so many files.
        ev.where(part == fifth).repartition(files).write.option("maxRecordsPerFile", 0).mode("append").parquet(bus)
    written = len([n for n in _names(spark, bus) if n.endswith(".parquet")])
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", written // len(order)).parquet(bus)


def delayed_messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``events`` sent in the order of ``ts``, their publish time, a fifth of the time
    range a micro-batch; each payload names a time before that, by 0 to 19 hundredths
    of the range."""
    ev = table(spark, sf_dir, "events")
    low, high = _time_range(ev)
    replay = _in_fifths(spark, ev, (0, 1, 2, 3, 4), name)
    at = F.unix_micros(to_instant("ts", ev.schema["ts"].dataType))
    back = F.pmod(F.col("event_id") * 7919, F.lit(20)) * F.lit((high - low) // 100)
    record = F.struct("event_id", format_iso(micros_to_ntz(at - back)).alias("timestamp"))
    return messages_from_records(replay, record, "ts")


def stream_publish_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 s windows of the payload's time under a watermark on the
    publish time.  A row whose window the watermark has passed comes out as a late
    row; counts and late rows add up to the table."""
    spark = pane_session(spark)
    fired = materialize_to_end(delayed_messages(spark, sf_dir, "stream_publish_watermark"),
                               lambda m: count_with_late_rows(m, FIXED_SIZE, salts=2), "stream_publish_watermark")
    counts = pane_counts(fired).select(F.lit(COUNTED).alias("kind"), "window_start", "n", F.lit(None).cast("string").alias("payload"),
                                       F.lit(None).cast("timestamp_ntz").alias("publish_time"))
    late = late_rows(fired).select(F.lit(LATE).alias("kind"), "window_start", F.lit(1).cast("long").alias("n"),
                                   decode_utf8("data").alias("payload"), "publish_time")
    return counts.unionByName(late)


def stream_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, records, rejects and late rows of one read.  ``events`` sent
    as for ``stream_late_rows``; every tenth payload is cut short and can't be read."""
    ev = table(spark, sf_dir, "events")
    replay = _in_fifths(spark, ev, LATE_ORDER, "stream_one_read")
    sent = messages_from_records(replay, event_record(replay), "ts")
    text = decode_utf8("data")
    cut = F.expr("substring(data, 1, length(data) - 1)")
    broken = text.rlike(r'"event_id":\d*3,')
    messages = sent.select(F.when(broken, cut).otherwise(F.col("data")).alias("data"), "publish_time")
    paths = {b: scratch_path(spark, f"stream_one_read-{b}") for b in BRANCHES}
    writers = {b: folder(path) for b, path in paths.items()}
    checkpoint = scratch_path(spark, "stream_one_read-checkpoint")
    run_available(fan_out_once(messages, writers, checkpoint, FIXED_SIZE, name="stream_one_read"))
    drain(spark, checkpoint, writers["counts"], FIXED_SIZE)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    counts = read_folder(spark, paths["counts"], "window_start timestamp_ntz, window_end timestamp_ntz, n long").select(
        F.lit("counts").alias("branch"), "window_start", "n", none("string", "payload"))
    records = read_folder(spark, paths["records"], "value binary").select(
        F.lit("records").alias("branch"), none("timestamp_ntz", "window_start"), none("long", "n"), decode_utf8("value").alias("payload"))
    rejects = read_folder(spark, paths["rejects"], "data binary, publish_time timestamp").select(
        F.lit("rejects").alias("branch"), none("timestamp_ntz", "window_start"), none("long", "n"), decode_utf8("data").alias("payload"))
    late = read_folder(spark, paths["late"], "window_start timestamp_ntz, data binary, publish_time timestamp").select(
        F.lit("late").alias("branch"), "window_start", none("long", "n"), decode_utf8("data").alias("payload"))
    return counts.unionByName(records).unionByName(rejects).unionByName(late)


def _names(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)]


def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records republished unchanged (read back as text)."""
    out = materialize(passthrough(event_messages(spark, sf_dir)), "stream_passthrough")
    return out.select(decode_utf8("value").alias("payload"))


def stream_messages_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the records republished through the sink that holds every message once, a
    fifth of the time range a micro-batch."""
    path, checkpoint = (scratch_path(spark, f"stream_messages_once-{x}") for x in ("out", "checkpoint"))
    replay = _in_fifths(spark, table(spark, sf_dir, "events"), (0, 1, 2, 3, 4), "stream_messages_once")
    run_available(write_messages_once(passthrough(messages_from_records(replay, event_record(replay), "ts")), path, checkpoint))
    return read_folder(spark, path, "value binary").select(decode_utf8("value").alias("payload"))


def _tap_out(tapped: DataFrame) -> DataFrame:
    from ..functions.timestamps import instant_to_ntz
    cols = [instant_to_ntz("publish_time").alias("publish_time")]
    if "data" in tapped.columns:
        cols.append(decode_utf8("data").alias("data"))
    return tapped.select(*cols)


def stream_message_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish time of every message."""
    tapped = tap_messages(event_messages(spark, sf_dir))
    return _tap_out(materialize(tapped, "stream_message_tap"))


def stream_message_tap_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish time and payload of every message."""
    tapped = tap_messages(event_messages(spark, sf_dir), with_data=True)
    return _tap_out(materialize(tapped, "stream_message_tap_data"))


def stream_arrival_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed windows of arrival (publish) time, no assignment step."""
    return materialize_to_end(event_messages(spark, sf_dir), lambda m: count_on_watermark(with_arrival_time(m), FIXED_SIZE),
                              "stream_arrival_fixed_window")


def _windows(ev: DataFrame) -> int:
    """How many 10 s windows the rows of ``events`` are in: the panes they open."""
    return ev.select(fixed_window("ts", FIXED_SIZE).start.alias("w")).distinct().count()


def pane_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` with the state store that processing-time panes need.

    The caller's session is left as it is.
    """
    if ROCKSDB in (spark.conf.get(STATE_PROVIDER, "") or ""):
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(STATE_PROVIDER, ROCKSDB)
    return own


def stream_global_pane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global window fired 10 s (processing time) after
    its first arrival.  The replay puts every message in the first
    micro-batch, so the one pane holds them all."""
    spark = pane_session(spark)
    counts = count_after_processing_time(event_messages(spark, sf_dir), GLOBAL_PANE_DELAY)
    return materialize_firings(counts, "stream_global_pane", min(1, _windows(table(spark, sf_dir, "events"))))


def stream_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed 10 s windows of arrival time, each fired 30 s
    (processing time) after its first arrival; all windows open in the first
    micro-batch of the replay, holding all their rows."""
    spark = pane_session(spark)
    counts = count_after_processing_time(event_messages(spark, sf_dir), WINDOW_PANE_DELAY,
                                         FIXED_SIZE)
    return materialize_firings(counts, "stream_window_panes", _windows(table(spark, sf_dir, "events")))


def _in_two_halves(spark: SparkSession, sf_dir: str, name: str, window: str | None, delay: str) -> DataFrame:
    """Even events arrive, their panes fire, then odd events arrive."""
    spark = pane_session(spark)
    ev = table(spark, sf_dir, "events")
    even, odd = ev.where(F.pmod("event_id", F.lit(2)) == 0), ev.where(F.pmod("event_id", F.lit(2)) == 1)
    bus = scratch_path(spark, f"{name}-bus")
    even.write.parquet(bus)
    replay = spark.readStream.schema(ev.schema).parquet(bus)
    counts = count_after_processing_time(messages_from_records(replay, event_record(replay), "ts"), delay, window)
    panes, first = (1, 1) if window is None else (_windows(ev), _windows(even))
    return materialize_firings(counts, name, panes, then=(first, lambda: odd.write.mode("append").parquet(bus)), settle=7)


def stream_window_panes_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 A1: even events arrive, their panes fire after 5 s, then odd events do.
    A fired pane drops them; windows without even events fire with them."""
    return _in_two_halves(spark, sf_dir, "stream_window_panes_closed", FIXED_SIZE, "5 seconds")


def stream_global_pane_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 A1: even events arrive and the global pane fires; what arrives later is not in it."""
    return _in_two_halves(spark, sf_dir, "stream_global_pane_closed", None, "5 seconds")


def stream_pane_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 A1: what the pane query holds, from its checkpoint: the panes open after the
    first batch, which has all messages, and the marks of fired panes at the end."""
    spark = pane_session(spark)
    checkpoint = scratch_path(spark, "stream_pane_state-checkpoint")
    counts = count_after_processing_time(event_messages(spark, sf_dir), "5 seconds", FIXED_SIZE)
    materialize_firings(counts, "stream_pane_state", _windows(table(spark, sf_dir, "events")), checkpoint=checkpoint)
    tagged = lambda df, when, n: df.select(F.lit(when).alias("state"), F.col("pane_start").alias("window_start"), n.alias("n"))
    none = F.lit(None).cast("long")
    return tagged(open_panes(spark, checkpoint, 0), "open, first batch", F.col("n")).unionByName(
        tagged(fired_panes(spark, checkpoint, 0), "fired, first batch", none)).unionByName(
        tagged(open_panes(spark, checkpoint), "open, at the end", F.col("n"))).unionByName(
        tagged(fired_panes(spark, checkpoint), "fired, at the end", none))


#: Files, a micro-batch each, that the metrics' replay is dealt over.
METRIC_BATCHES = 12


def stream_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 L1: metrics observed in every micro-batch of a run, added up by a listener."""
    ev = table(spark, sf_dir, "events")
    bus = scratch_path(spark, "stream_run_metrics-bus")
    ev.repartition(METRIC_BATCHES).write.option("maxRecordsPerFile", 0).parquet(bus)
    replay = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(bus)
    seen = observed(replay, "events", n=F.count(F.lit(1)), errors=F.count_if(F.col("event_type") == "error"), last=F.sum("event_id"))
    with RunMetrics(spark) as metrics:
        query = write_stream(seen, Sink("noop"), "stream_run_metrics")
        run_available(query)
        found = metrics.of(query)
    rows = [(k, int(found.get(k, 0))) for k in ("rows read", "rows dropped", "events.n", "events.errors", "events.last")]
    return spark.createDataFrame(rows, "metric string, total long")


STREAM_QUERIES = {
    "stream_fixed_window": stream_fixed_window,
    "stream_sliding_window": stream_sliding_window,
    "stream_sliding_window_slices": stream_sliding_window_slices,
    "stream_count_after_watermark": stream_count_after_watermark,
    "stream_count_default_trigger": stream_count_default_trigger,
    "stream_passthrough": stream_passthrough,
    "stream_message_tap": stream_message_tap,
    "stream_message_tap_data": stream_message_tap_data,
    "stream_arrival_fixed_window": stream_arrival_fixed_window,
    "stream_global_pane": stream_global_pane,
    "stream_window_panes": stream_window_panes,
    "stream_fan_out": stream_fan_out,
    "stream_late_rows": stream_late_rows,
    "stream_publish_watermark": stream_publish_watermark,
    "stream_one_read": stream_one_read,
    "stream_messages_once": stream_messages_once,
    "stream_pane_state": stream_pane_state,
    "stream_run_metrics": stream_run_metrics,
    "stream_window_panes_closed": stream_window_panes_closed,
    "stream_global_pane_closed": stream_global_pane_closed,
}
