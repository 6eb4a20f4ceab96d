"""Exact metrics of a run, and panes read from a checkpoint."""

import pytest
from pyspark.sql import functions as F

from panes.streaming.metrics import RunMetrics, observed
from panes.streaming.sinks import Sink, run_available, write_stream


def test_every_batch_of_a_long_run_counts(spark, scratch):
    """More micro-batches than progress reports that Spark keeps."""
    for i in range(104):
        with open(f"{scratch}/{i:03d}.txt", "w") as f:
            f.write(f"{i}\n" * (i + 1))
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(scratch)
    seen = observed(lines, "lines", n=F.count(F.lit(1)), total=F.sum(F.col("value").cast("long")))
    with RunMetrics(spark) as metrics:
        query = write_stream(seen, Sink("noop"), "metrics-test")
        with pytest.raises(ValueError, match="still running"):
            metrics.of(query)
        run_available(query)
        found = metrics.of(query)
    n = sum(i + 1 for i in range(104))
    assert len(query.recentProgress) <= 100 < found["batches"]
    assert found["lines.n"] == found["rows read"] == n and found["lines.total"] == sum(i * (i + 1) for i in range(104))


def test_a_batch_that_reports_again_replaces_its_report(spark):
    class Report:
        def __init__(self, batch, rows):
            self.progress = type("P", (), {"id": "q", "batchId": batch, "numInputRows": rows, "stateOperators": [], "observedMetrics": {}})()

    metrics = RunMetrics(spark)
    for batch, rows in ((0, 5), (1, 7), (1, 7), (2, 1)):
        metrics.onQueryProgress(Report(batch, rows))
    metrics.onQueryTerminated(type("E", (), {"id": "q"})())
    assert metrics.of(type("Q", (), {"isActive": False, "id": "q"})()) == {"rows read": 13, "rows dropped": 0, "batches": 3}
