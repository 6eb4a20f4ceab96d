"""Command-line runner: the reference's jobs with their options.

    python -m panes.cli batch --input market.txt [--output out/] [--explicit-window]
    python -m panes.cli fixed-window   --input_topic T1 --output_topic T2 [--counts PATH]
    python -m panes.cli sliding-window --input_topic T1 --output_topic T2 [--counts PATH]
    python -m panes.cli global-delay   --input_topic T1 --output_topic T2 [--counts PATH]
    python -m panes.cli after-watermark | default-trigger | processing-time \\
                                       --input_topic T1 --output_topic T2
    python -m panes.cli publish-constant --output_topic T1 [--payload TEXT] [--copies 3]
    python -m panes.cli publish-stamped  --input market.json --output_topic T1 [--start ISO]
    python -m panes.cli receive --input_topic T2 [--with-data]

The bus is ``--format`` (default ``kafka``; topics are Kafka topics) with
repeated ``--option key=value`` (for example
``kafka.bootstrap.servers=host:9092``).  With a file format (``parquet``,
a ``value BINARY`` column) topics are folders and arrival time is the read
time.
Counts of the fan-out jobs are printed (the reference's print tap, by the
tasks that have them) unless ``--counts`` names a folder.  Stream jobs block
until stopped, as ``wait_until_finish``; ``--available-now`` processes what is
there and ends (not for the processing-time jobs, whose timers keep a stream
running).  A stream job needs ``--checkpoint``: each branch keeps its place in
``<checkpoint>/<job>/<branch>``, and the job started again goes on from there.
``--delay`` is the allowed lateness of the event-time jobs.  ``--mode
permissive`` leaves bad messages out; ``--rejects`` keeps them in a folder.
The publishing jobs print each count before they send it, and ``publish-stamped``
each item, unless ``--quiet``.  ``fixed-window --one-read`` reads and parses the
topic once for counts, records, ``--rejects`` and ``--late`` (a folder for late
rows); its watermark follows ``--watermark`` (``event`` or ``publish`` time).
``--network`` and unknown options are accepted and ignored, as the
reference's runner options are.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.codec import decode_utf8
from .plans import pipelines, streams
from .session import build_session
from .sources.lines import constant_messages, read_documents
from .sources.messages import normalize_messages, read_messages, tap_messages
from .streaming.branches import fan_out_once, folder, printed, sent_to
from .streaming.sinks import Sink, fan_out, publish, run_available

# Subcommands and the reference job each one replaces (fixed values).
JOBS = {
    "batch": "JSON length per line, then the global count",
    "fixed-window": "count per fixed 10 s event-time window, records republished",
    "sliding-window": "count per 20 s / 10 s sliding window, records republished",
    "global-delay": "global count 10 s (processing time) after the first arrival",
    "after-watermark": "count per fixed 10 s window on the watermark, published",
    "default-trigger": "count per fixed 10 s window, default trigger, published",
    "processing-time": "count per 10 s arrival window, 30 s after its first arrival",
    "publish-constant": "publish one payload N times",
    "publish-stamped": "stamp each object of a JSON array with start + 0..19 s, publish",
    "receive": "print the publish time (and payload) of each message",
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m panes.cli", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--input", help="text file(s) (batch) or JSON-array document(s) (publish-stamped)")
    p.add_argument("--output", help="folder for the batch count")
    p.add_argument("--input_topic", "--input-topic", dest="in_topic")
    p.add_argument("--output_topic", "--output-topic", dest="out_topic")
    p.add_argument("--counts", help="folder for window counts (default: print them)")
    p.add_argument("--format", default="kafka", help="bus format (default kafka)")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="bus option, repeatable")
    p.add_argument("--explicit-window", action="store_true", help="batch: explicit global window")
    p.add_argument("--mode", default="strict", choices=("strict", "permissive"))
    p.add_argument("--payload", default="Hello world")
    p.add_argument("--copies", type=int, default=3)
    p.add_argument("--start", help="publish-stamped: start instant (default: now)")
    p.add_argument("--key", help="publish-stamped: numeric field for a repeatable jitter")
    p.add_argument("--with-data", action="store_true", help="receive: print payloads too")
    p.add_argument("--available-now", action="store_true", help="streams: process what is there, then end")
    p.add_argument("--checkpoint", help="shared folder in which a stream job keeps its place (required for them)")
    p.add_argument("--delay", default="0 seconds", help="event-time jobs: allowed lateness")
    p.add_argument("--rejects", help="folder for messages that permissive mode leaves out")
    p.add_argument("--quiet", action="store_true", help="publishing jobs: do not print what is published")
    p.add_argument("--one-read", action="store_true", help="fixed-window: all branches from one read of the topic")
    p.add_argument("--late", help="fixed-window --one-read: folder for late rows")
    p.add_argument("--watermark", default="event", choices=("event", "publish"), help="fixed-window --one-read: what the watermark follows")
    p.add_argument("--network", help="accepted and ignored (a runner option)")
    return p


def _options(pairs: list[str]) -> dict:
    out = {}
    for kv in pairs:
        k, sep, v = kv.partition("=")
        if not sep:
            raise SystemExit(f"--option needs KEY=VALUE, got {kv!r}")
        out[k] = v
    return out


def bus_source(spark: SparkSession, fmt: str, topic: str, options: dict) -> DataFrame:
    """Messages ``data, publish_time`` of a topic (kafka) or a folder (files)."""
    if fmt == "kafka":
        return read_messages(spark, "kafka", subscribe=topic, **options)
    df = spark.readStream.format(fmt).schema("value binary").options(**options).load(topic)
    return normalize_messages(df, "value", F.current_timestamp())


def bus_sink(fmt: str, topic: str, options: dict, trigger: dict) -> Sink:
    where = {"topic": topic} if fmt == "kafka" else {"path": topic}
    return Sink(fmt, {**where, **options}, trigger=trigger)


def count_sink(path: str | None, trigger: dict) -> Sink:
    """A folder, or the print tap (``Sink("noop")`` behind it: what is printed is the output)."""
    if path:
        return Sink("parquet", {"path": path}, trigger=trigger)
    return Sink("noop", trigger=trigger, tap="count: ")


def run(argv: list[str] | None = None, spark: SparkSession | None = None):
    """Run one job.  Returns the batch count DataFrame for ``batch``, else None."""
    args, _unknown = parser().parse_known_args(argv)
    spark = spark or build_session(app_name=f"panes-{args.job}")
    opts = _options(args.option)
    spark.sparkContext.setJobDescription(args.job)

    if args.job == "batch":
        n = pipelines.run_batch_file(spark, args.input, args.output, args.mode,
                                     args.explicit_window, tap=True)
        if not args.output:
            n.show()
        return n
    if args.job == "publish-constant":
        publish(constant_messages(spark, args.payload, args.copies), **_publish_to(args, opts))
        return None
    if args.job == "publish-stamped":
        docs = read_documents(spark, args.input, mode=args.mode)
        # The reference draws the jitter at random; a key makes it repeatable.
        start = args.start or str(dt.datetime.now())
        publish(pipelines.stamped_elements(docs, start, args.key, tap=None if args.quiet else "item: "), **_publish_to(args, opts))
        return None

    if not args.checkpoint:
        raise SystemExit(f"{args.job} needs --checkpoint: a folder in which it keeps its place")
    msgs = bus_source(spark, args.format, args.in_topic, opts)
    timer = {"processingTime": "1 second"}
    trigger = {"availableNow": True} if args.available_now else {}
    chk = os.path.join(args.checkpoint, args.job)
    if args.job == "receive":
        tapped = tap_messages(msgs, with_data=args.with_data)
        if args.with_data:  # printed as text; bytes that are not UTF-8 show as NULL
            tapped = tapped.withColumn("data", decode_utf8("data", "permissive"))
        run_available(fan_out({"tap": (tapped, Sink("noop", trigger=trigger, tap="received: "))}, chk), None)
        return None
    tap = None if args.quiet else "count: "
    if args.job == "fixed-window" and args.one_read:
        out = sent_to("kafka", {"topic": args.out_topic, **opts}) if args.format == "kafka" else folder(args.out_topic, args.format)
        writers = {"counts": folder(args.counts) if args.counts else printed("count: "), "records": out,
                   **({"rejects": folder(args.rejects)} if args.rejects else {}), **({"late": folder(args.late)} if args.late else {})}
        run_available(fan_out_once(msgs, writers, chk, delay=args.delay, basis=args.watermark, mode=args.mode, trigger=trigger))
        return None
    how = {"mode": args.mode, "checkpoint": chk, "rejects": Sink("parquet", {"path": args.rejects}, trigger=trigger) if args.rejects else None}
    out = bus_sink(args.format, args.out_topic, opts, trigger)
    if args.job == "fixed-window":
        qs = streams.fixed_window_job(msgs, count_sink(args.counts, trigger), out, delay=args.delay, **how)
    elif args.job == "sliding-window":
        qs = streams.sliding_window_job(msgs, count_sink(args.counts, trigger), out, delay=args.delay, **how)
    elif args.job == "global-delay":
        qs = streams.global_delay_job(msgs, count_sink(args.counts, timer), out, **how)
    elif args.job == "after-watermark":
        qs = streams.watermark_count_job(msgs, out, "after_watermark", delay=args.delay, tap=tap, **how)
    elif args.job == "default-trigger":
        qs = streams.watermark_count_job(msgs, out, "default", delay=args.delay, tap=tap, **how)
    else:  # processing-time
        qs = streams.processing_time_count_job(msgs, bus_sink(args.format, args.out_topic, opts, timer), tap=tap, **how)
    run_available(qs, None)
    return None


def _publish_to(args, opts: dict) -> dict:
    if args.format == "kafka":
        return {"format": "kafka", "topic": args.out_topic, **opts}
    return {"format": args.format, "path": args.out_topic, **opts}


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
