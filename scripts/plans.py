"""Summarise the physical plans of the registered batch queries and of the
stream operators (Markdown).

Per query: shuffles (and what they carry), scanned columns, pushed filters,
whole-stage-codegen stages, and any Python or pairwise operator.  Usage:
    python scripts/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panes.plans.queries import QUERIES  # noqa: E402
from panes.session import build_session  # noqa: E402

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas")
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")


def summary(df) -> dict:
    df.collect()  # run it: AQE's final plan carries the codegen stages
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = []
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        m = re.search(r"Exchange (\w+)", ln)
        if m and "ShuffleQueryStage" not in ln:
            below = next((x for x in lines[i + 1:] if re.search(r"[A-Z]\w+[ (]", x)), "")
            if "partial_" in below:
                feed = "partial agg"
            elif "FileScan" in below or "ColumnarToRow" in below:
                feed = "scan"
            else:
                feed = re.search(r"([A-Z]\w+)", below).group(1)
            exchanges.append(f"{m.group(1)} <- {feed}")
    return {
        "shuffles": exchanges,
        "read": sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*?>)(?:\n|$)", plan))),
        "pushed": sorted(set(x for x in re.findall(r"PushedFilters: (\[[^\]]*\])", plan) if x != "[]")),
        "broadcast": "BroadcastHashJoin" in plan,
        "python": [p for p in PYTHON if p in plan],
        "pairwise": [p for p in PAIRWISE if p in plan],
        "codegen": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# PLANS\n")
    print("Physical plans of the registered batch queries, generated by "
          f"`python scripts/plans.py` on `{os.path.basename(sf_dir)}` (final adaptive "
          "plans, after running each query).\n")
    print("| query | shuffles (feeding operator) | scan columns | pushed filters | codegen stages | Python / pairwise |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        s = summary(q(spark, sf_dir))
        shuffles = "<br>".join(s["shuffles"]) or "none"
        if s["broadcast"]:
            shuffles += "<br>broadcast join"
        print(f"| `{name}` | {shuffles} | {'<br>'.join(f'`{r}`' for r in s['read'])} | "
              f"{' '.join(s['pushed']) or '-'} | {s['codegen']} | "
              f"{', '.join(s['python'] + s['pairwise']) or 'none'} |")
    stream_section(spark, sf_dir)
    spark.stop()


def stream_section(spark, sf_dir: str) -> None:
    """The micro-batch plans of the stream operators, run once with availableNow
    (processing-time ones with a 1 s trigger, stopped after their first batch)."""
    import time

    from panes.plans.streams import event_messages, event_time_counts, passthrough
    from panes.session import scratch_path
    from panes.streaming.sinks import Sink, run_available, write_stream
    from panes.streaming.triggers import count_after_processing_time

    plans = {
        "fixed 10 s (T1-T3)": (lambda m: event_time_counts(m), None),
        "sliding 20/10 s, expand": (lambda m: event_time_counts(m, "20 seconds", "10 seconds"), None),
        "sliding 20/10 s, slices": (lambda m: event_time_counts(m, "20 seconds", "10 seconds",
                                                                method="slices"), None),
        "passthrough (D1 K1)": (lambda m: passthrough(m), None),
        "processing-time windows (T5)": (lambda m: count_after_processing_time(m, "1 hour", "10 seconds"),
                                         {"processingTime": "1 second"}),
    }
    print("\n## Stream plans\n")
    print("Last micro-batch plan of each stream operator over the `events` replay.\n")
    print("| stream | shuffles (feeding operator) | state operators | Python |")
    print("| --- | --- | --- | --- |")
    for name, (build, trigger) in plans.items():
        df = build(event_messages(spark, sf_dir))
        out = scratch_path(spark, "plan-stream")
        sink = Sink("parquet", {"path": out})
        if trigger:
            sink.trigger = trigger
        q = write_stream(df, sink, out.rsplit("/", 1)[-1])
        if trigger:
            end = time.time() + 300
            while not q.recentProgress and time.time() < end:
                time.sleep(0.5)
            plan = q._jsq.explainInternal(False)
            q.stop()
        else:
            run_available(q, 600)
            plan = q._jsq.explainInternal(False)
        plan = plan.split("== Initial Plan ==")[0]
        lines = plan.splitlines()
        shuffles = []
        for i, ln in enumerate(lines):
            m = re.search(r"Exchange (\w+)", ln)
            if m and "ShuffleQueryStage" not in ln:
                ops = [re.search(r"([A-Z]\w+)", x.split("+-")[-1].replace("*(", "")) for x in lines[i + 1:]]
                below = [(o.group(1), x) for o, x in zip(ops, lines[i + 1:]) if o]
                below = [(n, x) for n, x in below if n not in ("Project", "Sort")]
                n, x = below[0] if below else ("-", "")
                feed = ("MapInArrow (per-task partial counts)" if n == "MapInArrow" else
                        "partial agg" if "partial_" in x else
                        "scan" if n in ("FileScan", "ColumnarToRow") else n)
                shuffles.append(f"{m.group(1)} <- {feed}")
        state = [op for op in ("StateStoreSave", "TransformWithStateInPySpark") if op in plan]
        n_state = sum(plan.count(op) for op in state)
        python = [p for p in PYTHON + ("TransformWithStateInPySpark",) if p in plan]
        print(f"| {name} | {'<br>'.join(shuffles) or 'none'} | "
              f"{n_state} ({', '.join(state) or '-'}) | {', '.join(python) or 'none'} |")


if __name__ == "__main__":
    main()
