from collections import Counter

from edges import edge_docs, no_docs  # noqa: F401  (fixtures)
from panes.llm import lines
from panes.session import scratch_path


def brute(rows, min_docs, min_chars):
    keyed = [(i, [(x, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))) for x in (t or "").split("\n")]) for i, t in rows]
    found = Counter(k for _, own in keyed for k in {k for _, k in own} if len(k) >= min_chars)
    out = []
    for i, own in keyed:
        kept = [x for x, k in own if not (len(k) >= min_chars and found[k] >= min_docs)]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()], key=repr)


def test_both_ways_against_brute_force(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    expected = brute(rows, 10, 1)
    assert sum(d for *_, d in expected) >= 25
    assert got(lines.drop_frequent_lines(edge_docs, 10)) == expected
    # More frequent lines than may be broadcast: joined by shuffles.
    assert got(lines.drop_frequent_lines(edge_docs, 10, most_broadcast=0)) == expected
    assert got(lines.drop_frequent_lines(edge_docs, 2, min_chars=4, batches=2)) == brute(rows, 2, 4)
    assert lines.drop_frequent_lines(no_docs).collect() == []


def test_runs_are_levelled_and_reopened(spark):
    path = scratch_path(spark, "runs-test")
    runs = lines.LineRuns(spark, path, fanout=2, buckets=4)
    batch = lambda *pairs: spark.createDataFrame([(bytes([k]), n) for k, n in pairs], "hash binary, n long")
    runs.add(batch((1, 3), (2, 12)), 10)
    assert [level for level, _ in runs.runs] == [0]
    runs.add(batch((1, 4), (2, 5), (3, 1)), 10)  # line 2 is done: its 5 are not added
    assert [level for level, _ in runs.runs] == [1]
    again = lines.LineRuns(spark, path, fanout=2, buckets=99)
    assert again.runs == runs.runs and again.buckets == 4
    again.add(batch((1, 3), (3, 1)), 10)
    assert sorted(level for level, _ in again.runs) == [0, 1]
    assert {bytes(r["hash"])[0]: r["n"] for r in again.counts().collect()} == {1: 10, 2: 12, 3: 2}


def test_no_run_is_shuffled(spark):
    runs = lines.LineRuns(spark, scratch_path(spark, "runs-plan"), fanout=9, buckets=4)
    batch = spark.createDataFrame([(b"k", 1)], "hash binary, n long")
    for _ in range(3):
        runs.add(batch, 10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    against = plan(runs._unfinished(batch, 10))
    assert against.count("SortMergeJoin") == 3 and against.count("Bucketed: true") == 3
    assert against.count("Exchange") == 1  # the batch's own
    merge = plan(runs._merged(runs.runs[:2]))
    assert "SortMergeJoin" in merge and "Exchange" not in merge


def numbers(runs):
    return {bytes(r["hash"])[0]: r["n"] for r in runs.counts().collect()}


def test_a_stop_between_writing_a_merged_run_and_deleting_the_old_ones(spark, monkeypatch):
    path = scratch_path(spark, "runs-stop")
    batch = lambda *pairs: spark.createDataFrame([(bytes([k]), n) for k, n in pairs], "hash binary, n long")
    runs = lines.LineRuns(spark, path, fanout=2, buckets=2)
    runs.add(batch((1, 3)), 100, "a")

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(lines.LineRuns, "_remove", stop)
    try:
        runs.add(batch((1, 4), (2, 1)), 100, "b")
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    again = lines.LineRuns(spark, path, fanout=2)
    assert numbers(again) == {1: 7, 2: 1} and [level for level, _ in again.runs] == [1]
    assert sorted(x for x in again.batches[again.runs[0]]) == ["a", "b"]
    # The driver didn't learn that the batch was in: it adds it again.
    again.add(batch((1, 4), (2, 1)), 100, "b")
    assert numbers(again) == {1: 7, 2: 1}
    again.add(batch((2, 5)), 100, "c")
    assert numbers(lines.LineRuns(spark, path)) == {1: 7, 2: 6}


def test_a_stop_while_a_run_is_written(spark, monkeypatch):
    path = scratch_path(spark, "runs-half")
    batch = lambda n: spark.createDataFrame([(b"k", n)], "hash binary, n long")
    runs = lines.LineRuns(spark, path, fanout=3, buckets=2)
    runs.add(batch(2), 100, "a")
    monkeypatch.setattr(lines.LineRuns, "_write_about", lambda *_: 1 / 0)  # behind the run
    try:
        runs.add(batch(5), 100, "b")
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    again = lines.LineRuns(spark, path, fanout=3)
    assert len(again.runs) == 1
    again.add(batch(5), 100, "b")
    assert {r["n"] for r in again.counts().collect()} == {7}


def test_documents_added_again_by_name(spark, edge_docs):
    path = scratch_path(spark, "runs-named")
    want = got(lines.drop_frequent_lines(edge_docs, 20, runs=lines.LineRuns(spark, path, buckets=4), name="d"))
    assert got(lines.drop_frequent_lines(edge_docs, 20, runs=lines.LineRuns(spark, path), name="d")) == want
    assert got(lines.drop_frequent_lines(edge_docs, 20, runs=lines.LineRuns(spark, path), name="e")) != want
