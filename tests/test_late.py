"""Windows under a watermark on publish time, late rows as a side output."""

import datetime as dt
import json

import pyarrow as pa
import pytest

from panes.plans.streams import pane_session
from panes.sources.messages import normalize_messages
from panes.streaming.late import LATE, count_with_late_rows, late_rows, pane_counts, partial_rows
from panes.streaming.sinks import Sink, end_record, run_available, write_stream

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def message(event: int, publish: int | None, extra: str = ""):
    text = json.dumps({"timestamp": str((T0 + dt.timedelta(seconds=event)).replace(tzinfo=None)), "extra": extra})
    return text.encode(), None if publish is None else T0 + dt.timedelta(seconds=publish)


def send(spark, bus, messages):
    spark.createDataFrame([(bytearray(d), t) for d, t in messages], "data binary, publish_time timestamp").coalesce(1).write.mode("append").parquet(bus)


class Runs:
    """One stream over a folder of messages, started again for each batch."""

    def __init__(self, spark, scratch, **options):
        self.spark, self.bus, self.out, self.chk = pane_session(spark), f"{scratch}/bus", f"{scratch}/out", f"{scratch}/chk"
        self.options = options

    def run(self, messages=None):
        send(self.spark, self.bus, messages) if messages else end_record(self.spark).write.mode("append").parquet(self.bus)
        source = normalize_messages(self.spark.readStream.schema("data binary, publish_time timestamp").parquet(self.bus), "data", "publish_time")
        out = count_with_late_rows(source, **self.options)
        self.schema = out.schema
        run_available(write_stream(out, Sink("parquet", {"path": self.out}, checkpoint=self.chk), "late-rows-test"))
        return self

    def fired(self):
        return self.spark.read.schema(self.schema).parquet(self.out)

    def counts(self):
        return sorted((r.window_start.second + 60 * r.window_start.minute, r.n) for r in pane_counts(self.fired()).collect())

    def late(self):
        return sorted(json.loads(bytes(r.data))["timestamp"][-5:] for r in late_rows(self.fired()).collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_late_is_by_publish_time_and_nothing_is_lost(spark, scratch, salts):
    runs = Runs(spark, scratch, salts=salts)
    # Event times far ahead move no watermark; all of one batch meet the watermark before it.
    runs.run([message(1, 0), message(2, 3), message(500, 4), message(15, 9)])
    assert runs.counts() == [] and runs.late() == []
    # The watermark is 9 s: nothing is late yet, though 500 s has been seen.
    runs.run([message(3, 21), message(16, 12)])
    # Now 21 s: windows 0 and 10 have fired; 4 and 17 are late, 22 is not.
    runs.run([message(4, 30), message(17, 30), message(17, 31), message(22, 40)])
    assert runs.counts() == [(0, 3), (10, 2), (20, 1)]  # and the watermark is 40 s
    assert runs.late() == ["00:04", "00:17", "00:17"]
    runs.run()
    assert runs.counts() == [(0, 3), (10, 2), (20, 1), (500, 1)]
    assert sum(n for _, n in runs.counts()) + len(runs.late()) == 10


def test_allowed_lateness_bad_messages_and_missing_publish_times(spark, scratch):
    runs = Runs(spark, scratch, delay="20 seconds", mode="permissive")
    runs.run([message(1, 25), (b"{bad", T0), (b'{"a": 1}', T0), message(2, None)])
    runs.run([message(3, 26)])  # the watermark is 5 s: still in time
    runs.run([message(4, 40)])  # 6 s
    runs.run([message(5, 40), message(30, 40)])  # 20 s: late
    runs.run()
    assert runs.counts() == [(0, 4), (30, 1)] and runs.late() == ["00:05"]
    strict = Runs(spark, scratch + "/strict")
    with pytest.raises(RuntimeError):
        strict.run([(b"{bad", T0)])


def test_a_window_that_has_fired_leaves_no_state(spark, scratch):
    runs = Runs(spark, scratch)
    runs.run([message(s, s) for s in range(0, 100, 5)]).run([message(100, 100)])
    open_now = runs.spark.read.format("statestore").option("stateVarName", "open").load(runs.chk)
    # The watermark is 95 s (the batch with 100 s has met it): windows up to 80 have fired.
    keys = sorted((r["key"]["pane_key"] // 1_000_000 - int(T0.timestamp()), r["value"]["n"]) for r in open_now.collect())
    fired = [w for w, _ in runs.counts()]
    assert fired == [w for w in range(0, 100, 10) if w not in [k for k, _ in keys]]
    assert {w for w, _ in keys} <= {90, 100} and all(n in (1, 2) for _, n in keys)


def test_rows_are_packed_in_pieces_of_a_bounded_size(monkeypatch):
    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 5})()))
    batch = pa.RecordBatch.from_arrays([pa.array([20, 10, 20, 10, 20], pa.int64()), pa.array([b"a" * 10, None, b"c", b"d", b"e"]),
                                        pa.array([1, 2, 3, None, 5], pa.int64())], ["pane_key", "data", "publish_us"])
    empty = batch.slice(0, 0)
    for rows, size, pieces in ((4096, 1 << 20, [(10, 2), (20, 3)]), (2, 1 << 20, [(10, 2), (20, 2), (20, 1)]), (4096, 5, [(10, 2), (20, 1), (20, 2)])):
        out = [r for b in partial_rows(3, rows, size)([empty, batch]) for r in b.to_pylist()]
        assert [(r["pane_key"], r["n"]) for r in out] == pieces and {r["salt"] for r in out} == {2}
        unpacked = [x for r in out for x in pa.ipc.open_stream(r["rows"]).read_all().to_pylist()]
        assert sorted(map(str, unpacked)) == sorted(map(str, batch.select(["data", "publish_us"]).to_pylist()))


def test_windows_need_whole_milliseconds(spark):
    messages = end_record(pane_session(spark))
    with pytest.raises(ValueError, match="milliseconds"):
        count_with_late_rows(messages, "0.0001 seconds")
    assert LATE == "late"
