"""Sources, sinks and the batch pipeline over files."""

import json
import os

import pytest

from panes.plans.pipelines import batch_lengths, run_batch_file
from panes.sources.lines import constant_messages, read_documents, read_lines
from panes.sources.messages import normalize_messages, tap_messages
from panes.streaming.sinks import publish, with_types
from panes.functions.codec import encode_utf8
from pyspark.sql import functions as F


def test_batch_pipeline_over_text_file(spark, scratch):
    lines = ['[{"a": 1}, {"b": 2}]', '{"x": 1, "y": 2, "z": 3}', '"four"']
    with open(f"{scratch}/market.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    got = [r.length for r in batch_lengths(read_lines(spark, f"{scratch}/market.txt")).collect()]
    assert got == [len(json.loads(x)) for x in lines]
    n = run_batch_file(spark, f"{scratch}/market.txt", output=f"{scratch}/out")
    assert [r.n for r in n.collect()] == [3]
    assert [json.loads(l) for l in open([f"{scratch}/out/{p}" for p in __import__("os").listdir(f"{scratch}/out")
                                         if p.endswith(".json")][0])] == [{"n": 3}]


def test_batch_pipeline_strict_fails_on_bad_line(spark, scratch):
    with open(f"{scratch}/bad.txt", "w") as f:
        f.write("[1]\n5\n")
    with pytest.raises(Exception, match="no length"):
        run_batch_file(spark, f"{scratch}/bad.txt").collect()
    assert [r.n for r in run_batch_file(spark, f"{scratch}/bad.txt", mode="permissive").collect()] == [1]


def test_read_documents_json_array(spark, scratch):
    doc = [{"name": "a", "price": 1.5}, {"name": "b", "price": 2.0}]
    with open(f"{scratch}/market.json", "w") as f:
        json.dump(doc, f, indent=2)
    for schema in ("name string, price double", None):
        rows = read_documents(spark, f"{scratch}/market.json", schema)
        if schema is None:
            rows = rows.selectExpr("element:name::string as name", "element:price::double as price")
        assert [r.asDict() for r in rows.orderBy("name").collect()] == doc


def test_constant_messages(spark):
    rows = constant_messages(spark, "Hello world", 3).collect()
    assert [bytes(r.value) for r in rows] == [b"Hello world"] * 3


def test_publish_and_tap(spark, scratch):
    df = spark.range(5).select(F.current_timestamp().alias("t"),
                               F.to_json(F.struct("id")).alias("j"))
    msgs = normalize_messages(df, encode_utf8("j"), "t")
    assert msgs.columns == ["data", "publish_time"]
    publish(msgs.select(F.col("data").alias("value")), "parquet", path=f"{scratch}/bus")
    assert spark.read.parquet(f"{scratch}/bus").count() == 5
    assert tap_messages(msgs, with_data=True).columns == ["publish_time", "data"]


def test_typed_tap(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    row = with_types(df).first()
    assert (row.x_type, row.y_type) == ("int", "string")


def test_print_tap_prints_every_row_and_passes_it_on(scratch):
    """50 rows give 50 lines, in the tasks' own output; run apart, to read that output."""
    import subprocess
    import sys
    from conftest import ROOT
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from panes.session import build_session\nfrom panes.streaming.sinks import print_tap\n"
            "spark = build_session('local[2]')\n"
            "df = print_tap(spark.range(50).repartition(3), 'row: ')\n"
            "print('sum', sum(r.id for r in df.collect()))\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=ROOT)
    printed = sorted(int(x.split("(")[1].split(",")[0]) for x in (done.stdout + done.stderr).splitlines() if x.startswith("row: "))
    assert printed == list(range(50)), done.stderr[-2000:]
    assert "sum 1225" in done.stdout


def test_print_tap_lines_of_several_workers_stay_whole():
    import subprocess
    import sys
    from conftest import ROOT
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from panes.session import build_session\nfrom panes.streaming.sinks import print_tap\n"
            "spark = build_session('local[8]', extra={'spark.ui.showConsoleProgress': 'false'})\n"
            "print_tap(spark.range(8000).repartition(16), 'row: ').write.format('noop').mode('overwrite').save()\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=ROOT)
    assert sorted(x for x in done.stderr.splitlines() + done.stdout.splitlines() if "row: " in x) == sorted(f"row: ({i},)" for i in range(8000))


def test_table_stream_reads_folders_and_files(spark, scratch):
    """A table of four part files replays as its single file does."""
    from conftest import SF_SMALL
    from panes.sources.messages import table_stream
    from panes.streaming.sinks import materialize
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(4).write.parquet(f"{scratch}/sf/events.parquet")
    for folder in (SF_SMALL, f"{scratch}/sf"):
        back = materialize(table_stream(spark, folder, "events"), "replay")
        assert back.count() == events.count() and back.exceptAll(events).isEmpty()


def test_read_messages_of_another_format(spark, scratch):
    from panes.sources.messages import read_messages
    spark.createDataFrame([(1, bytearray(b"{}"))], "t long, body binary").selectExpr(
        "timestamp_seconds(t) as sent", "body").write.parquet(f"{scratch}/topic")
    for stream in (True, False):
        msgs = read_messages(spark, "parquet", f"{scratch}/topic", schema="sent timestamp, body binary", data="body",
                             publish_time="sent", stream=stream)
        assert msgs.columns == ["data", "publish_time"] and msgs.isStreaming == stream
    assert [bytes(r.data) for r in msgs.collect()] == [b"{}"]


def test_malformed_documents_fail(spark, scratch):
    with open(f"{scratch}/bad.json", "w") as f:
        f.write('[{"name": "a"}, {"name": ]')
    with pytest.raises(Exception):
        read_documents(spark, f"{scratch}/bad.json", schema="name string").collect()
    with pytest.raises(Exception):
        read_documents(spark, f"{scratch}/bad.json").collect()
    assert read_documents(spark, f"{scratch}/bad.json", schema="name string", mode="permissive").count() >= 0


def test_stamped_elements_keep_their_own_fields(spark, scratch):
    from panes.plans.pipelines import stamped_elements
    objects = [{"id": 1, "a": 1}, {"id": 2, "b": {"x": None}}, {"id": 2 ** 60, "timestamp": "old", "c": None}]
    for layout in ("whole", "lines"):
        with open(f"{scratch}/{layout}.json", "w") as f:
            f.write("[\n" + ",\n".join(map(json.dumps, objects)) + "\n]\n")
        docs = read_documents(spark, f"{scratch}/{layout}.json", layout=layout)
        got = sorted([json.loads(bytes(r.value)) for r in stamped_elements(docs, "2024-01-01 00:00:00", "id").collect()], key=lambda o: o["id"])
        assert [{k: v for k, v in o.items() if k != "timestamp"} for o in got] == [{k: v for k, v in o.items() if k != "timestamp"} for o in objects]
        assert [o["timestamp"] for o in got] == [f"2024-01-01 00:00:{o['id'] * 7919 % 20:02d}" for o in objects]


def test_write_documents_round_trip_over_many_tasks(spark, scratch):
    from panes.sources.documents import write_documents
    rows = [(i, f'line {i} "q" \\ \n é 😀', None if i % 3 else 1.5) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, s string, x double").repartition(7)
    df = df.union(df.limit(0).repartition(3))  # some tasks see no rows
    write_documents(df, f"{scratch}/docs")
    texts = [open(f"{scratch}/docs/{f}").read() for f in os.listdir(f"{scratch}/docs")
             if f.startswith("part-")]
    docs = [json.loads(t) for t in texts if t.strip()]
    assert all(isinstance(d, list) for d in docs) and len(docs) >= 2
    assert sorted((d["id"], d["s"], d.get("x")) for doc in docs for d in doc) == rows
    back = read_documents(spark, f"{scratch}/docs", schema=df.schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_write_documents_empty_input(spark, scratch):
    from panes.sources.documents import write_documents
    df = spark.createDataFrame([], "id bigint, s string")
    write_documents(df, f"{scratch}/none")
    assert read_documents(spark, f"{scratch}/none", schema=df.schema).count() == 0


def test_read_documents_by_lines_splits_one_file(spark, scratch):
    from panes.sources.documents import write_documents
    rows = [(i, f'item "{i}", [x]\n{{y}}', float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, s string, x double").coalesce(1)
    write_documents(df, f"{scratch}/docs")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        back = read_documents(spark, f"{scratch}/docs", schema=df.schema, layout="lines")
        assert back.rdd.getNumPartitions() > 4  # one file, many tasks
        assert sorted(tuple(r) for r in back.collect()) == rows
        own = read_documents(spark, f"{scratch}/docs", layout="lines")
        assert own.columns == ["element"] and own.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_read_documents_by_lines_handles_pretty_arrays(spark, scratch):
    with open(f"{scratch}/market.json", "w") as f:
        f.write('[\n  {"name": "a", "price": 1.5},\n  {"name": "b", "price": 2.0}\n]\n')
    got = read_documents(spark, f"{scratch}/market.json", schema="name string, price double", layout="lines").orderBy("name")
    assert [tuple(r) for r in got.select("name", "price").collect()] == [("a", 1.5), ("b", 2.0)]
    with open(f"{scratch}/bad.json", "w") as f:
        f.write('[\n{"name": "a"},\n{"name": \n]\n')
    with pytest.raises(Exception):
        read_documents(spark, f"{scratch}/bad.json", schema="name string", layout="lines").collect()
