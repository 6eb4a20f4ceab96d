"""All branches of a fan-out from one read."""

import json

import pytest

from panes.sources.messages import normalize_messages
from panes.streaming.branches import BRANCHES, drain, fan_out_once, folder, read_folder, write_messages_once
from panes.streaming.sinks import run_available
from test_late import T0, message, send

SCHEMAS = {"counts": "window_start timestamp_ntz, window_end timestamp_ntz, n long", "records": "value binary",
           "rejects": "data binary, publish_time timestamp", "late": "window_start timestamp_ntz, data binary, publish_time timestamp"}


class Job:
    def __init__(self, spark, scratch, **options):
        self.spark, self.scratch, self.options = spark, scratch, options
        self.writers = {b: folder(f"{scratch}/{b}") for b in BRANCHES}

    def run(self, messages=(), fail=None):
        if messages:
            send(self.spark, f"{self.scratch}/bus", messages)
        writers, plans = dict(self.writers), []
        for name, write in self.writers.items():
            def spy(rows, batch_id, name=name, write=write):
                plans.append(rows._jdf.queryExecution().executedPlan().toString())
                if name == fail:
                    raise OSError("the store is away")
                write(rows, batch_id)
            writers[name] = spy
        source = normalize_messages(self.spark.readStream.schema("data binary, publish_time timestamp").parquet(f"{self.scratch}/bus"), "data", "publish_time")
        q = fan_out_once(source, writers, f"{self.scratch}/chk", **self.options)
        run_available(q)
        self.read = sum(p["numInputRows"] for p in q.recentProgress)
        return plans

    def rows(self, name):
        return read_folder(self.spark, f"{self.scratch}/{name}", SCHEMAS[name]).collect()

    def counts(self):
        return sorted((r.window_start.second + 60 * r.window_start.minute, r.n) for r in self.rows("counts"))


GOOD = [message(1, 1), message(2, 2), message(12, 3), message(31, 4)]


def test_one_read_and_one_parse_for_all_branches(spark, scratch):
    job = Job(spark, scratch)
    plans = job.run([*GOOD, (b"{bad", T0), (b"\xff", T0)])
    assert job.read == 6  # twice as many if a branch read the source by itself
    # (Nothing is late in a first batch.)
    assert len(plans) == 4 and all("InMemoryTableScan" in p or p.startswith("LocalTableScan <empty>") for p in plans)
    # Above what is kept, no branch parses again.
    assert all("from_json" not in p.split("InMemoryTableScan")[0] for p in plans)
    assert len(job.rows("records")) == 4 and len(job.rows("rejects")) == 2
    assert job.counts() == [(0, 2), (10, 1)]


@pytest.mark.parametrize("fail", BRANCHES)
def test_a_batch_stopped_between_two_writes_gives_each_row_once(spark, scratch, fail):
    job = Job(spark, scratch)
    job.run([*GOOD, (b"{bad", T0)])
    more = [message(3, 9), message(32, 9), message(55, 9), (b"{worse", T0)]
    with pytest.raises(RuntimeError, match="away"):
        job.run(more, fail=fail)
    job.run()
    assert len(job.rows("records")) == 7 and len(job.rows("rejects")) == 2
    assert [json.loads(bytes(r.data))["timestamp"][-5:] for r in job.rows("late")] == ["00:03"]
    assert job.counts() == [(0, 2), (10, 1), (30, 2)]
    for _ in range(2):  # the end of the input, twice
        drain(spark, f"{scratch}/chk", job.writers["counts"])
    assert job.counts() == [(0, 2), (10, 1), (30, 2), (50, 1)]


def test_only_the_last_two_tables_of_open_windows_are_kept(spark, scratch):
    import os

    job = Job(spark, scratch)
    for i in range(4):
        job.run([message(10 * i, i)])
    assert sorted(n for n in os.listdir(f"{scratch}/chk/panes") if not n.startswith(".")) == ["batch_id=2", "batch_id=3"]
    assert job.counts() == [(0, 1), (10, 1), (20, 1)]


def test_watermark_on_publish_time_and_delay(spark, scratch):
    job = Job(spark, scratch, basis="publish", delay="5 seconds")
    job.run([message(1, 0), message(400, 3)])  # 400 s ahead moves nothing
    job.run([message(2, 16)])
    assert job.counts() == [(0, 2)]  # 11 s
    job.run([message(3, 17), message(12, 17)])
    assert len(job.rows("late")) == 1
    drain(spark, f"{scratch}/chk", job.writers["counts"])
    assert job.counts() == [(0, 2), (10, 1), (400, 1)]


def test_options_are_checked_and_strict_mode_fails(spark, scratch):
    source = spark.readStream.schema("data binary, publish_time timestamp").parquet(scratch)
    with pytest.raises(ValueError, match="no such"):
        fan_out_once(source, {"nothing": folder(scratch)}, f"{scratch}/c")
    with pytest.raises(ValueError, match="basis"):
        fan_out_once(source, {}, f"{scratch}/c", basis="clock")
    job = Job(spark, scratch, mode="strict")
    with pytest.raises(RuntimeError):
        job.run([(b"{bad", T0)])


def test_a_message_sink_that_fails_after_the_write_and_before_the_commit(spark, scratch):
    send(spark, f"{scratch}/bus", GOOD)
    read = lambda: spark.readStream.schema("data binary, publish_time timestamp").parquet(f"{scratch}/bus").selectExpr("data as value", "publish_time")
    run_available(write_messages_once(read(), f"{scratch}/out", f"{scratch}/chk"))
    send(spark, f"{scratch}/bus", [message(40, 40), message(41, 41)])

    def written_then_lost(rows, batch_id):
        folder(f"{scratch}/out")(rows, batch_id)
        raise OSError("lost before the commit")

    with pytest.raises(RuntimeError, match="lost"):
        run_available(write_messages_once(read(), f"{scratch}/out", f"{scratch}/chk", write=written_then_lost))
    sent = lambda: sorted(json.loads(bytes(r.value))["timestamp"][-5:] for r in read_folder(spark, f"{scratch}/out", "value binary").collect())
    assert sent() == ["00:01", "00:02", "00:12", "00:31", "00:40", "00:41"]
    run_available(write_messages_once(read(), f"{scratch}/out", f"{scratch}/chk"))
    assert sent() == ["00:01", "00:02", "00:12", "00:31", "00:40", "00:41"]
