"""Processing-time triggers (T4, T5; fixtures F7 / F7b in spirit) and their batch
twins.  Timer tests wait on the sink, with a bound, instead of fixed sleeps."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from panes.operators.panes import first_pane_global, first_pane_windows
from panes.streaming.sinks import Sink, write_stream
from panes.streaming.triggers import count_after_processing_time

BASE = dt.datetime(2020, 1, 1)
SCHEMA = "publish_time timestamp, data binary"


def put(spark, folder, name, seconds):
    rows = [(BASE + dt.timedelta(seconds=s), bytearray(b"{}")) for s in seconds]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def committed(spark, path, schema):
    if not os.path.exists(os.path.join(path, "_spark_metadata")):
        return []
    return spark.read.schema(schema).parquet(path).collect()


def wait_for(cond, timeout):
    end = time.time() + timeout
    while time.time() < end:
        if cond():
            return True
        time.sleep(1)
    return False


def test_processing_time_panes_once_repeat_and_windows(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src = f"{scratch}/src"
    put(spark, src, "b0", [1, 5, 12])
    msgs = spark.readStream.schema(SCHEMA).parquet(f"{src}/b*")
    every_second = {"processingTime": "1 second"}
    outs = {k: f"{scratch}/{k}" for k in ("once", "repeat", "win")}
    plans = {
        "once": count_after_processing_time(msgs, "8 seconds"),
        "repeat": count_after_processing_time(msgs, "8 seconds", repeat=True),
        "win": count_after_processing_time(msgs, "8 seconds", window="10 seconds"),
    }
    qs = {k: write_stream(df, Sink("parquet", {"path": outs[k]}, "append", every_second), f"t_{k}")
          for k, df in plans.items()}
    try:
        put(spark, src, "b1", [7])  # before the first firing: in the first pane
        assert wait_for(lambda: committed(spark, outs["once"], plans["once"].schema) and
                        len(committed(spark, outs["win"], plans["win"].schema)) == 2, 120)
        put(spark, src, "b2", [15])  # after the firing
        assert wait_for(lambda: len(committed(spark, outs["repeat"], plans["repeat"].schema)) == 2, 90)
        time.sleep(3)
    finally:
        for q in qs.values():
            q.stop()
    for q in qs.values():
        assert q.exception() is None
    once = [r.n for r in committed(spark, outs["once"], plans["once"].schema)]
    repeat = sorted(r.n for r in committed(spark, outs["repeat"], plans["repeat"].schema))
    win = {(r.window_start - BASE).seconds: r.n for r in committed(spark, outs["win"], plans["win"].schema)}
    assert once == [4]               # :01 :05 :12 and :07; the :15 after the firing is dropped
    assert repeat == [1, 4]          # repeated: :15 opens a second pane
    assert win == {0: 3, 10: 1}      # each window fired once; :15 came after window 10 fired


def brute_first_pane(times, size_s, delay_s):
    out = {}
    for t in times:
        start = t - dt.timedelta(seconds=(t - BASE).total_seconds() % size_s)
        out.setdefault(start, []).append(t)
    res = {}
    for start, ts in out.items():
        first = min(ts)
        res[start] = sum(1 for t in ts if t < first + dt.timedelta(seconds=delay_s))
    return res


@pytest.mark.parametrize("salts", [1, 32])
def test_first_pane_windows_join_path(spark, salts):
    rnd = random.Random(7)
    times = [BASE + dt.timedelta(microseconds=rnd.randrange(0, 600_000_000)) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = {r.window_start: r.n for r in
           first_pane_windows(df, "ts", "60 seconds", "7 seconds", salts).collect()}
    assert got == brute_first_pane(times, 60, 7)


def test_first_pane_windows_long_delay_is_fixed_count(spark):
    times = [BASE + dt.timedelta(seconds=s) for s in (0, 3, 9, 12, 25)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = {r.window_start: r.n for r in first_pane_windows(df, "ts", "10 seconds", "30 seconds").collect()}
    assert got == brute_first_pane(times, 10, 30)


@pytest.mark.parametrize("pane", [lambda df: first_pane_windows(df, "ts", "60 seconds", "7 seconds"),
                                  lambda df: first_pane_windows(df, "ts", "10 seconds", "30 seconds"),
                                  lambda df: first_pane_global(df, "ts", "10 seconds")])
def test_null_arrival_fails_the_first_panes(spark, pane):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), (None,), ("2024-01-01 00:00:01",)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    with pytest.raises(Exception, match="without event time"):
        pane(df).collect()


def test_f7_first_pane_global(spark):
    times = [BASE + dt.timedelta(seconds=s) for s in (0, 3, 9, 12, 25)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    assert [r.n for r in first_pane_global(df, "ts", "10 seconds").collect()] == [3]
    # a row exactly at the firing instant misses the pane
    assert [r.n for r in first_pane_global(df, "ts", "9 seconds").collect()] == [2]
    assert first_pane_global(df.where(F.lit(False)), "ts").collect() == []


def test_open_panes_outlive_the_closed_mark(spark, scratch):
    """The mark's time to live, shorter than the delay, does not touch an open pane."""
    from panes.streaming.sinks import materialize_firings
    put(spark, f"{scratch}/src", "b0", [1, 2, 3])
    msgs = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/src/b*")
    counts = count_after_processing_time(msgs, "4 seconds", closed_ttl="1 second")
    assert [r.n for r in materialize_firings(counts, "ttl", 1).collect()] == [3]


def test_arrival_panes_check_payloads(spark, scratch):
    from panes.streaming.event_time import rejected
    from panes.streaming.sinks import materialize, materialize_firings
    rows = [(BASE, bytearray(b'{"a": 1}')), (BASE, bytearray(b"not json")), (BASE, bytearray(b"{bad")), (None, bytearray(b"{}"))]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{scratch}/src")
    msgs = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/src")
    for window in (None, "10 seconds"):
        with pytest.raises(RuntimeError, match="not JSON, or has no publish time"):
            materialize_firings(count_after_processing_time(msgs, "1 second", window), "strict", 1)
        lenient = count_after_processing_time(msgs, "1 second", window, mode="permissive")
        assert [r.n for r in materialize_firings(lenient, "lenient", 1).collect()] == [1]
    assert materialize(rejected(msgs), "rejected").count() == 3


def test_the_session_is_left_as_it_is(spark):
    from panes.streaming.triggers import STATE_PROVIDER
    msgs = spark.readStream.format("rate").load().selectExpr("cast('{}' as binary) as data", "timestamp as publish_time")
    old = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            count_after_processing_time(msgs)
        # The registered queries bring a session of their own.
        from conftest import SF_SMALL
        from panes.plans.streams import STREAM_QUERIES
        assert STREAM_QUERIES["stream_global_pane"](spark, SF_SMALL).first().n == 1000
        assert "HDFSBacked" in spark.conf.get(STATE_PROVIDER)
    finally:
        spark.conf.set(STATE_PROVIDER, old)
