"""Exact metrics of a whole run (K3, L1).

Spark keeps the last 100 progress reports of a query; a listener gets every one.
``RunMetrics`` adds them up while the query runs: observed metrics (``observe``),
rows read, and rows that a watermark dropped.  A batch that is run again after a
failure reports again under its number, and replaces what it reported before.
"""

from __future__ import annotations

import time
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observed(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """``df`` with aggregates observed on its way, in every batch, under ``name``."""
    return df.observe(name, *[c.alias(k) for k, c in metrics.items()])


class RunMetrics(StreamingQueryListener):
    """Adds up the reports of the queries of a session that are started inside ``with``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.batches: dict[str, dict[int, dict[str, float]]] = defaultdict(dict)
        self.ended: set[str] = set()

    def __enter__(self) -> RunMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = {"rows read": p.numInputRows, "rows dropped": sum(o.numRowsDroppedByWatermark for o in p.stateOperators)}
        for name, row in p.observedMetrics.items():
            found |= {f"{name}.{k}": v for k, v in row.asDict().items() if v is not None}
        self.batches[str(p.id)][p.batchId] = found

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def of(self, query: StreamingQuery, timeout: float = 60) -> dict[str, float]:
        """The sums over all batches of a query that has ended."""
        if query.isActive:
            raise ValueError("the query is still running")
        end = time.monotonic() + timeout
        while str(query.id) not in self.ended:  # the listener's bus is behind the query
            if time.monotonic() > end:
                raise TimeoutError("no report of the query's end")
            time.sleep(0.05)
        out: dict[str, float] = defaultdict(int)
        for found in self.batches[str(query.id)].values():
            for k, v in found.items():
                out[k] += v
        return {**out, "batches": len(self.batches[str(query.id)])}
