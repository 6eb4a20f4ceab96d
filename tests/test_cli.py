"""The command-line runner over file folders as the bus."""

import datetime as dt
import json

import pytest

from panes import cli
from panes.functions.timestamps import JITTER_SECONDS, JITTER_MULTIPLIER


def test_cli_batch_count_and_output(spark, scratch):
    lines = ['[1, 2, 3]', '{"a": 1}', '"xy"']
    with open(f"{scratch}/market.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    n = cli.run(["batch", "--input", f"{scratch}/market.txt", "--network", "test",
                 "--explicit-window"], spark)
    assert [r.n for r in n.collect()] == [3]
    cli.run(["batch", "--input", f"{scratch}/market.txt", "--output", f"{scratch}/out"], spark)
    assert spark.read.json(f"{scratch}/out").first().n == 3


def test_cli_publish_then_fixed_window_and_receive(spark, scratch, capfd):
    docs = [{"id": i, "name": f"item{i}"} for i in range(12)]
    with open(f"{scratch}/market.json", "w") as f:
        json.dump(docs, f)
    bus = ["--format", "parquet"]
    cli.run(["publish-stamped", "--input", f"{scratch}/market.json", "--output_topic",
             f"{scratch}/topic1", "--start", "2024-01-01 00:00:00", "--key", "id", *bus], spark)
    assert sum(x.startswith("item: ") for x in capfd.readouterr().out.splitlines()) == len(docs)
    cli.run(["publish-constant", "--output_topic", f"{scratch}/topic1", *bus], spark)
    sent = [bytes(r.value).decode() for r in spark.read.parquet(f"{scratch}/topic1").collect()]
    assert sent.count("Hello world") == 3
    stamped = [json.loads(s) for s in sent if s != "Hello world"]
    jitter = {d["id"]: d["id"] * JITTER_MULTIPLIER % JITTER_SECONDS for d in docs}
    assert sorted((d["id"], d["timestamp"]) for d in stamped) == sorted(
        (i, str(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=j))) for i, j in jitter.items())

    # Counts need event time: read only the stamped records as the input topic.
    spark.read.parquet(f"{scratch}/topic1").where("value != cast('Hello world' as binary)") \
        .write.parquet(f"{scratch}/sub1")
    cli.run(["fixed-window", "--input_topic", f"{scratch}/sub1", "--output_topic",
             f"{scratch}/topic2", "--counts", f"{scratch}/counts", "--available-now", "--checkpoint", f"{scratch}/chk", *bus], spark)
    counts = {r.window_start: r.n for r in spark.read.parquet(f"{scratch}/counts").collect()}
    # Watermark 0 on a bounded input: only windows ending by the last event time fire.
    last = max(jitter.values())
    want = sum(1 for j in jitter.values() if j < 10) if last >= 10 else None
    assert counts == ({dt.datetime(2024, 1, 1): want} if want else {})
    assert spark.read.parquet(f"{scratch}/topic2").count() == len(docs)

    cli.run(["receive", "--input_topic", f"{scratch}/topic2", "--with-data",
             "--available-now", "--checkpoint", f"{scratch}/chk", *bus], spark)


def test_cli_published_counts_are_digits(spark, scratch, capfd):
    rows = [(json.dumps({"timestamp": f"2024-01-01 00:00:{s:02d}", "i": s}).encode(),)
            for s in (1, 2, 5, 11, 13, 25)]
    spark.createDataFrame(rows, "value binary").coalesce(1).write.parquet(f"{scratch}/sub")
    for job in ("after-watermark", "default-trigger"):
        cli.run([job, "--input_topic", f"{scratch}/sub", "--output_topic", f"{scratch}/{job}",
                 "--format", "parquet", "--available-now", "--checkpoint", f"{scratch}/chk"], spark)
        got = sorted(bytes(r.value).decode() for r in spark.read.parquet(f"{scratch}/{job}").collect())
        # Windows :00 and :10 close by the last event time (:25); :20 does not.
        assert got == ["2", "3"]
        # Each count is printed once before it is published.
        printed = [x for x in capfd.readouterr().out.splitlines() if x.startswith("count: ")]
        assert sorted(x.rstrip(")").split(", ")[-1] for x in printed) == ["2", "3"]
    cli.run(["after-watermark", "--input_topic", f"{scratch}/sub", "--output_topic", f"{scratch}/quiet", "--quiet",
             "--format", "parquet", "--available-now", "--checkpoint", f"{scratch}/chk-quiet"], spark)
    assert "count: " not in capfd.readouterr().out and spark.read.parquet(f"{scratch}/quiet").count() == 2


def send(spark, folder, seconds):
    rows = [(json.dumps({"timestamp": f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"}).encode(),) for s in seconds]
    spark.createDataFrame(rows, "value binary").coalesce(1).write.mode("append").parquet(folder)


def test_a_job_started_again_goes_on(spark, scratch):
    """New events between two runs: every closed window is published exactly once."""
    args = ["after-watermark", "--input_topic", f"{scratch}/sub", "--output_topic", f"{scratch}/out", "--format", "parquet",
            "--available-now", "--checkpoint", f"{scratch}/chk"]
    published = lambda: sorted(bytes(r.value).decode() for r in spark.read.parquet(f"{scratch}/out").collect())
    send(spark, f"{scratch}/sub", [1, 2, 12])
    cli.run(args, spark)
    assert published() == ["2"]
    send(spark, f"{scratch}/sub", [13, 14, 25, 31, 42])
    cli.run(args, spark)
    assert published() == ["1", "1", "2", "3"]
    with pytest.raises(SystemExit, match="--checkpoint"):
        cli.run(args[:-2], spark)


def test_delay_and_rejects_reach_stream_jobs(spark, scratch):
    send(spark, f"{scratch}/sub", [1, 25, 70])
    spark.createDataFrame([(bytearray(b"{bad"),)], "value binary").coalesce(1).write.mode("append").parquet(f"{scratch}/sub")
    base = ["fixed-window", "--input_topic", f"{scratch}/sub", "--format", "parquet", "--available-now"]
    where = lambda n: ["--output_topic", f"{scratch}/{n}-out", "--counts", f"{scratch}/{n}", "--checkpoint", f"{scratch}/{n}-chk"]
    with pytest.raises(RuntimeError):
        cli.run([*base, *where("strict")], spark)
    cli.run([*base, *where("now"), "--mode", "permissive", "--rejects", f"{scratch}/bad"], spark)
    cli.run([*base, *where("later"), "--mode", "permissive", "--delay", "60 seconds"], spark)
    assert spark.read.parquet(f"{scratch}/now").count() == 2      # :00 and :20 close by 1:10
    assert spark.read.parquet(f"{scratch}/later").count() == 1    # only :00 closes by 0:10
    assert [bytes(r.data) for r in spark.read.parquet(f"{scratch}/bad").collect()] == [b"{bad"]
    assert spark.read.parquet(f"{scratch}/now-out").count() == 3


def test_one_read_of_the_topic(spark, scratch):
    send(spark, f"{scratch}/sub", [1, 25, 70])
    spark.createDataFrame([(bytearray(b"{bad"),)], "value binary").coalesce(1).write.mode("append").parquet(f"{scratch}/sub")
    args = ["fixed-window", "--one-read", "--input_topic", f"{scratch}/sub", "--format", "parquet", "--available-now", "--mode", "permissive",
            "--output_topic", f"{scratch}/out", "--counts", f"{scratch}/counts", "--rejects", f"{scratch}/bad", "--late", f"{scratch}/late",
            "--checkpoint", f"{scratch}/chk"]
    cli.run(args, spark)
    send(spark, f"{scratch}/sub", [26, 71, 95])
    cli.run(args, spark)
    rows = lambda n: spark.read.parquet(f"{scratch}/{n}").collect()
    assert sorted((r.window_start.minute * 60 + r.window_start.second, r.n) for r in rows("counts")) == [(0, 1), (20, 1), (70, 2)]
    assert len(rows("out")) == 6 and [bytes(r.data) for r in rows("bad")] == [b"{bad"]
    assert [json.loads(bytes(r.data))["timestamp"] for r in rows("late")] == ["2024-01-01 00:00:26"]
