"""Streams over file folders: watermark firing and late data (F4, F4b), fan-out,
strict failures."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from panes.functions.codec import encode_utf8
from panes.plans.streams import fixed_window_job, passthrough, event_time_counts
from panes.sources.lines import read_lines
from panes.sources.messages import normalize_messages
from panes.streaming.sinks import Sink, materialize, run_available

BASE = dt.datetime(2020, 1, 1)
SENTINEL = "9999-12-31 23:59:00"


def payload(second=None, stamp=None):
    t = stamp or str(BASE + dt.timedelta(seconds=second))
    return json.dumps({"timestamp": t, "item": "x"})


def write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        p = os.path.join(folder, f"b{i}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))


def messages(spark, folder):
    lines = read_lines(spark, folder, stream=True, maxFilesPerTrigger=1)
    return normalize_messages(lines, encode_utf8("value"), F.current_timestamp())


F4 = [[payload(1), payload(12)], [payload(25), payload(5)], [payload(3), payload(26)],
      [payload(41)], [payload(51)], [payload(stamp=SENTINEL)]]


def counts_by_start(df):
    return {(r.window_start - BASE).seconds: r.n for r in df.collect()}


def test_f4_late_row_dropped_and_windows_fire_once(spark, scratch):
    write_batches(f"{scratch}/in", F4)
    out = materialize(event_time_counts(messages(spark, f"{scratch}/in")), "f4")
    assert counts_by_start(out) == {0: 2, 10: 1, 20: 2, 40: 1, 50: 1}


def test_f4b_watermark_delay_keeps_late_rows(spark, scratch):
    write_batches(f"{scratch}/in", F4[:4])
    counts = event_time_counts(messages(spark, f"{scratch}/in"), delay="30 seconds")
    assert counts_by_start(materialize(counts, "f4b")) == {0: 3}


def test_fan_out_counts_and_passthrough(spark, scratch):
    write_batches(f"{scratch}/in", F4)
    msgs = messages(spark, f"{scratch}/in")
    qs = fixed_window_job(msgs, Sink("parquet", {"path": f"{scratch}/counts"}),
                          Sink("parquet", {"path": f"{scratch}/out"}))
    run_available(qs, 300)
    assert counts_by_start(spark.read.parquet(f"{scratch}/counts")) == {0: 2, 10: 1, 20: 2, 40: 1, 50: 1}
    sent = [json.loads(bytes(r.value).decode()) for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert len(sent) == 9  # every message, late ones too: the branch has no window
    assert sorted(s["timestamp"] for s in sent)[0] == "2020-01-01 00:00:01"


def test_passthrough_strict_fails_on_bad_json(spark, scratch):
    write_batches(f"{scratch}/in", [[payload(1), "not json"]])
    with pytest.raises(Exception, match="not JSON"):
        materialize(passthrough(messages(spark, f"{scratch}/in")), "bad")


def test_passthrough_permissive_drops_bad_json(spark, scratch):
    write_batches(f"{scratch}/in", [[payload(1), "not json", "[1, 2]"]])
    out = materialize(passthrough(messages(spark, f"{scratch}/in"), "permissive"), "perm")
    assert sorted(bytes(r.value).decode() for r in out.collect()) == sorted([payload(1), "[1, 2]"])


def test_event_time_strict_fails_without_timestamp(spark, scratch):
    write_batches(f"{scratch}/in", [[json.dumps({"item": 1})]])
    with pytest.raises(Exception, match="timestamp"):
        materialize(event_time_counts(messages(spark, f"{scratch}/in")), "nots")


def test_sliding_stream(spark, scratch):
    write_batches(f"{scratch}/in", [[payload(5.5), payload(stamp=SENTINEL)]])
    counts = event_time_counts(messages(spark, f"{scratch}/in"), "20 seconds", "10 seconds")
    got = {(r.window_start - BASE).total_seconds(): r.n for r in materialize(counts, "sl").collect()}
    assert got == {-10.0: 1, 0.0: 1}


def test_f4c_per_trigger_discarding_counts(spark, scratch):
    from panes.streaming.sinks import run_available
    from panes.streaming.triggers import count_per_trigger
    write_batches(f"{scratch}/in", F4[:4])
    q = count_per_trigger(messages(spark, f"{scratch}/in"), f"{scratch}/out", available_now=True)
    run_available(q, 300)
    got = {r.batch_id: r.n for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert [got[i] for i in sorted(got)] == [2, 2, 2, 1]


def test_late_rows_are_reported_and_accounted(spark, scratch):
    from panes.streaming.sinks import dropped_late_rows, write_stream
    write_batches(f"{scratch}/in", F4)
    q = write_stream(event_time_counts(messages(spark, f"{scratch}/in")),
                     Sink("parquet", {"path": f"{scratch}/out"}), "late")
    run_available(q, 300)
    emitted = sum(r.n for r in spark.read.parquet(f"{scratch}/out").collect())
    dropped = dropped_late_rows(q)
    assert dropped == 1                     # the :03 row of b2
    assert emitted + dropped + 1 == 9       # + the sentinel, still in an open window


def test_restart_from_checkpoint_no_duplicates(spark, scratch):
    from panes.streaming.sinks import write_stream
    sink = Sink("parquet", {"path": f"{scratch}/out"}, checkpoint=f"{scratch}/chk")
    write_batches(f"{scratch}/in", F4[:3])
    run_available(write_stream(event_time_counts(messages(spark, f"{scratch}/in")), sink, "r1"), 300)
    first = counts_by_start(spark.read.parquet(f"{scratch}/out"))
    # more data arrives; the job restarts from its checkpoint (offsets + state)
    with open(f"{scratch}/in/b3.txt", "w") as f:
        f.write("\n".join([payload(41)]) + "\n")
    with open(f"{scratch}/in/b4.txt", "w") as f:
        f.write("\n".join([payload(51), payload(stamp=SENTINEL)]) + "\n")
    run_available(write_stream(event_time_counts(messages(spark, f"{scratch}/in")), sink, "r2"), 300)
    rows = spark.read.parquet(f"{scratch}/out").collect()
    assert len(rows) == len({r.window_start for r in rows})  # each window once
    assert counts_by_start(spark.read.parquet(f"{scratch}/out")) == {0: 2, 10: 1, 20: 2, 40: 1, 50: 1}
    assert set(first) <= {0, 10, 20}


def test_watermark_count_job_publishes_digits(spark, scratch):
    from panes.plans.streams import watermark_count_job
    write_batches(f"{scratch}/in", F4)
    qs = watermark_count_job(messages(spark, f"{scratch}/in"),
                             Sink("parquet", {"path": f"{scratch}/bus"}))
    run_available(qs, 300)
    out = spark.read.parquet(f"{scratch}/bus")
    assert out.columns == ["value"]  # the bare count: window bounds are not published
    assert sorted(bytes(r.value) for r in out.collect()) == sorted([b"2", b"1", b"2", b"1", b"1"])


def test_stream_complete_mode_equals_batch(spark):
    from conftest import SF_SMALL
    from panes.operators.windows import count_fixed
    from panes.plans.streams import event_messages
    counts = event_time_counts(event_messages(spark, SF_SMALL))
    q = (counts.writeStream.format("memory").queryName("complete_vs_batch")
               .outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination(300)
    stream = {(r.window_start, r.n) for r in spark.sql("SELECT * FROM complete_vs_batch").collect()}
    batch = {(r.window_start, r.n) for r in
             count_fixed(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts").collect()}
    assert stream == batch  # complete mode also holds the last, still open window


def test_passthrough_follows_python_json(spark, scratch):
    # Python accepts repeated keys and scalars; it rejects text after a value.
    write_batches(f"{scratch}/in", [[payload(1), '{"a": 1, "a": 2}', "7", "null"]])
    out = materialize(passthrough(messages(spark, f"{scratch}/in")), "dups")
    assert sorted(bytes(r.value).decode() for r in out.collect()) == sorted(
        [payload(1), '{"a": 1, "a": 2}', "7", "null"])
    write_batches(f"{scratch}/in2", [[payload(1), '[1] x']])
    with pytest.raises(Exception, match="not JSON"):
        materialize(passthrough(messages(spark, f"{scratch}/in2")), "trail")


IN_ORDER = [[payload(1), payload(12)], [payload(25), payload(27)], [payload(33), payload(41)],
            [payload(52)], [payload(stamp=SENTINEL)]]


def _sliding(spark, folder, size, period, method):
    from panes.streaming.windows import count_on_watermark
    from panes.streaming.event_time import with_event_time
    ev = with_event_time(messages(spark, folder))
    return sorted(tuple(r) for r in materialize(
        count_on_watermark(ev, size, period, method=method), f"sl_{method}").collect())


@pytest.mark.parametrize("size,period", [("20 seconds", "10 seconds"), ("25 seconds", "10 seconds")])
def test_stream_sliding_slices_equal_expand_without_late_rows(spark, scratch, size, period):
    write_batches(f"{scratch}/in", IN_ORDER)
    got = {m: _sliding(spark, f"{scratch}/in", size, period, m) for m in ("expand", "slices")}
    assert got["slices"] == got["expand"] and got["expand"]


def test_stream_sliding_lateness_is_per_window(spark, scratch):
    # :03 arrives when the watermark is :12.  It is late for [-10, 10) but
    # [0, 20) is still open: the default plan counts it there, slices do not.
    write_batches(f"{scratch}/in", F4)
    expand = {r[0]: r[2] for r in _sliding(spark, f"{scratch}/in", "20 seconds", "10 seconds", "expand")}
    slices = {r[0]: r[2] for r in _sliding(spark, f"{scratch}/in", "20 seconds", "10 seconds", "slices")}
    assert expand[BASE] == 4 and slices[BASE] == 3


def test_event_time_repeated_key_last_wins_and_offsets(spark):
    from panes.streaming.event_time import with_event_time
    from panes.functions.timestamps import instant_to_ntz
    texts = ['{"timestamp": "2020-01-01 10:00:00", "x": 1, "timestamp": "2020-01-01 10:00:05"}',
             '{"timestamp": "2020-01-01T12:00:05+02:00"}']
    df = spark.createDataFrame([(t.encode(),) for t in texts], "data binary")
    got = [r.t for r in with_event_time(df).select(instant_to_ntz("event_time").alias("t")).collect()]
    assert got == [dt.datetime(2020, 1, 1, 10, 0, 5)] * 2


def test_a_failed_branch_stops_the_others_and_is_raised(spark, scratch):
    """The second branch dies while the first one runs without end."""
    from panes.streaming.sinks import fan_out
    rate = spark.readStream.format("rate").load()
    bad = rate.select(F.raise_error(F.lit("branch failed")).cast("string").alias("value"))
    qs = fan_out({"first": (rate, Sink("noop", trigger={"processingTime": "1 second"})),
                  "second": (bad, Sink("noop", trigger={"processingTime": "1 second"}))}, f"{scratch}/chk")
    with pytest.raises(RuntimeError, match="branch failed"):
        run_available(qs, 120)
    assert not any(q.isActive for q in qs.values())


def test_event_time_refuses_what_python_refuses(spark):
    from panes.streaming.event_time import payload_time, rejected
    good = ['{"timestamp": "2020-01-01 10:00:00"}', ' {"timestamp": "20200101", "x": [1, {"y": null}]} ', '{"timestamp": "2020-01-01", "n": NaN}']
    bad = ['{"timestamp": "2020-01-01"} x', '{"timestamp": "2020-01-01"}}', '{"timestamp": "2020-01-01"}{"timestamp": "2020-01-01"}',
           '{"timestamp": 2020}', '{"timestamp": 20200101}', "{'timestamp': '2020-01-01'}", '{"timestamp": null}', "{}", "[]", "7", "", "not json",
           '{"timestamp": "2020-01-01"}, {"timestamp": "2020-01-01"}', '{"timestamp": "2020"}']
    df = spark.createDataFrame([(t.encode(),) for t in good + bad], "data binary").withColumn("publish_time", F.current_timestamp())
    got = [r.t is not None for r in df.select(payload_time(mode="permissive").alias("t")).collect()]
    assert got == [True] * len(good) + [False] * len(bad)
    assert rejected(df, "timestamp").count() == len(bad)
    for text in bad[:4]:
        with pytest.raises(Exception, match="readable 'timestamp'"):
            df.where(F.col("data") == text.encode()).select(payload_time()).collect()


def test_late_rows_of_the_whole_run(spark, scratch):
    from panes.streaming.sinks import LateRows, write_stream
    write_batches(f"{scratch}/in", F4)
    late = LateRows()
    q = write_stream(event_time_counts(messages(spark, f"{scratch}/in")), Sink("parquet", {"path": f"{scratch}/out"}), "late2")
    run_available(q, 300)
    assert late.look(q) == late.look(q) == 1


@pytest.mark.parametrize("name", ["stream_fixed_window", "stream_passthrough", "stream_arrival_fixed_window"])
def test_folder_tables_give_the_same(spark, scratch, name):
    from conftest import SF_SMALL
    from panes.plans.streams import STREAM_QUERIES
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4).write.parquet(f"{scratch}/sf/events.parquet")
    a, b = (STREAM_QUERIES[name](spark, d) for d in (SF_SMALL, f"{scratch}/sf"))
    assert a.count() > 900 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_query_that_fails_while_it_is_looked_at_is_no_success():
    """Its failure may come after one look at it and before the next."""
    from panes.streaming.sinks import run_available

    class Query:
        name, failure = "q", None

        @property
        def isActive(self):
            self.failure = OSError("the store is away")
            return False

        def exception(self):
            return self.failure

        def stop(self):
            pass

    with pytest.raises(RuntimeError, match="away"):
        run_available({"q": Query()})
