"""Physical plans of the registered queries: what must hold at scale.

Checked on the initial (pre-AQE) physical plan: no row-pair operators, no
Python in batch hot paths, map-side partial aggregation before every shuffle
of a count, and column pruning down to the parquet scan.
"""

import re

import pytest

from conftest import SF_SMALL
from panes.plans.queries import QUERIES

# Physical operators a registered batch query must never use.
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas",
          "FlatMapGroupsInPandas", "PythonMapInArrow")
CAPS = ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*?>)(?:\n|$)", plan_of(df))


def node_lines(plan: str) -> list[str]:
    """Operator names, top to bottom, one per plan line that starts a node."""
    out = []
    for line in plan.splitlines():
        m = re.match(r"^[\s:|+\-*!]*(?:\*\(\d+\)\s*)?([A-Z][A-Za-z]+)", line)
        if m:
            out.append(m.group(1))
    return out


#: Queries that run a user's code or print, and the range search of the prefix sums.
BY_DESIGN = {"print_tap_lengths", "user_combiner", "generated_elements", "sliding_day_count"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_batch_query_has_no_pairs_python_or_caps(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    nodes = set(node_lines(plan))
    assert not nodes & set(PAIRWISE), plan
    assert not nodes & (set() if name in BY_DESIGN else set(PYTHON)), plan
    assert not nodes & set(CAPS), plan


@pytest.mark.parametrize("name", ["fixed_window_count", "sliding_window_count",
                                  "global_pane_once", "window_pane_once"])
def test_window_counts_read_only_the_time_column(spark, name):
    schemas = read_schemas(QUERIES[name](spark, SF_SMALL))
    assert schemas and set(schemas) == {"struct<ts:timestamp_ntz>"}


@pytest.mark.parametrize("name,cols", [
    ("json_object_length", "struct<event_id:bigint,props:string>"),
    ("stamp_jitter", "struct<event_id:bigint>"),
    ("iso_parse", "struct<event_id:bigint,ts:timestamp_ntz>"),
    ("global_count", "struct<text:string>"),
])
def test_projection_pruned_to_scan(spark, name, cols):
    assert read_schemas(QUERIES[name](spark, SF_SMALL)) == [cols]


@pytest.mark.parametrize("name", ["fixed_window_count", "sliding_window_count",
                                  "global_count", "global_pane_once"])
def test_every_count_shuffle_is_preceded_by_a_partial_aggregate(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    lines = plan.splitlines()
    exchanges = [i for i, ln in enumerate(lines) if "Exchange " in ln and "RoundRobin" not in ln]
    assert exchanges, plan
    for i in exchanges:
        below = next(ln for ln in lines[i + 1:] if re.search(r"[A-Z][a-z]+[A-Z]?\w*\(", ln))
        assert "HashAggregate" in below and "partial_" in below, plan


def test_sliding_expands_aggregated_slices_not_raw_rows(spark):
    nodes = node_lines(plan_of(QUERIES["sliding_window_count"](spark, SF_SMALL)))
    i = nodes.index("Expand")
    # Expand's input is the final slice aggregate; the raw scan is below that.
    assert nodes[i + 1] == "HashAggregate"
    assert nodes.index("FileScan") > nodes.index("Exchange", i)


def test_first_pane_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["global_pane_once"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), LessThan\(ts,ScalarSubquery", plan), plan


def test_first_pane_windows_are_defined_without_running_a_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("first-pane", "no eager job")
    try:
        df = QUERIES["window_pane_part"](spark, SF_SMALL)
        before = list(tracker.getJobIdsForGroup("first-pane"))
        plan = plan_of(df)
        assert list(tracker.getJobIdsForGroup("first-pane")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Few jobs at most (the schema of the table), and no written copy in the plan.
    assert len(before) <= 1 and "Scan ExistingRDD" not in plan and "_salt" in plan


def _stream_plan(df, scratch, name, trigger=None):
    """Plan of the last micro-batch; a running trigger is stopped after one."""
    import time
    from panes.streaming.sinks import Sink, run_available, write_stream
    sink = Sink("parquet", {"path": f"{scratch}/{name}"})
    if trigger:
        sink.trigger = trigger
    q = write_stream(df, sink, name)
    if not trigger:
        run_available(q, 300)
        return q._jsq.explainInternal(False)
    try:
        end = time.time() + 300
        while not q.recentProgress and q.isActive and time.time() < end:
            time.sleep(0.5)
        assert q.recentProgress, q.exception()
        return q._jsq.explainInternal(False)
    finally:
        q.stop()


def test_stream_state_store_is_fed_partial_counts(spark, scratch):
    from panes.plans.streams import event_messages, event_time_counts
    plan = _stream_plan(event_time_counts(event_messages(spark, SF_SMALL)), scratch, "plan_wm")
    nodes = node_lines(plan)
    assert "StateStoreSave" in nodes, plan
    lines = plan.splitlines()
    ex = next(i for i, ln in enumerate(lines) if "Exchange " in ln and "RoundRobin" not in ln)
    assert "partial_count" in lines[ex + 1], plan
    assert not set(nodes) & set(PAIRWISE + PYTHON), plan


def test_processing_time_state_sees_per_task_partial_counts(spark, scratch):
    from panes.streaming.triggers import count_after_processing_time
    from panes.plans.streams import event_messages
    counts = count_after_processing_time(event_messages(spark, SF_SMALL), "1 hour", "10 seconds")
    plan = _stream_plan(counts, scratch, "plan_pt", {"processingTime": "1 second"})
    nodes = node_lines(plan)
    tws = next(i for i, n in enumerate(nodes) if n.startswith("TransformWithState"))
    below = [n for n in nodes[tws + 1:] if n not in ("Project", "Sort")]
    # The stateful operator's input is shuffled per-task partial counts, not raw rows.
    assert below[:2] == ["Exchange", "MapInArrow"], plan


def test_stream_slices_expand_only_aggregated_slices(spark, scratch):
    from panes.plans.streams import event_messages, event_time_counts
    counts = event_time_counts(event_messages(spark, SF_SMALL), "20 seconds", "10 seconds",
                               method="slices")
    nodes = node_lines(_stream_plan(counts, scratch, "plan_sl"))
    assert nodes.count("StateStoreSave") == 2
    # Expand sits above the first (slice) state store, never on raw rows.
    first_store = len(nodes) - 1 - nodes[::-1].index("StateStoreSave")
    assert "Expand" in nodes[:first_store] and "Expand" not in nodes[first_store:]
