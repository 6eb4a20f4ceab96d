"""Sliding window counts by prefix sums (W4): the cost does not grow with size / period.

A row is in ``size / period`` windows, one after another.  So it is enough to note
where they begin and where they end: at the first window a slice's count comes in,
behind the last one it goes out.  Summed up along the windows, these changes are
the count of every window; between two changes it stays as it is.

The sum is taken in two passes over ranges of the window axis.  The ranges hold
about as many changes each (their bounds are quantiles of the changes, whatever the
times are like); the first pass adds up each range, and a range's sum before its
first change is the total of the ranges before it (a number for each range, at most
``MOST_RANGES``); the second pass sums up inside each range, all ranges at once.
"""

from __future__ import annotations

import sys
from itertools import accumulate
from math import gcd

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.timestamps import duration_us, micros_to_ntz, to_micros
from ..session import scratch_path
from .windows import COUNT, require_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Changes in a range, about; ranges at most; windows made from one row at once.
RANGE_CHANGES, MOST_RANGES, RUN_WINDOWS = 50_000, 4096, 1 << 16


def _floor_div(x, y: int):
    return ((x - F.pmod(x, F.lit(y))) / F.lit(y)).cast("long")


def window_changes(df: DataFrame, time_col: str, size_us: int, period_us: int, off_us: int) -> DataFrame:
    """k (number of a window), d: by how much the count of window k differs from that of window k - 1."""
    g = gcd(size_us, period_us)
    us = to_micros(time_col, df.schema[time_col].dataType) - F.lit(off_us)
    slices = df.select((us - F.pmod(us, F.lit(g))).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("c"))
    # The first window that ends behind the slice, and the last that has begun.
    spans = slices.select((_floor_div(F.col("at") - F.lit(size_us), period_us) + 1).alias("low"), _floor_div(F.col("at"), period_us).alias("high"), "c")
    ends = spans.where("low <= high").select(F.explode(F.array(
        F.struct(F.col("low").alias("k"), F.col("c").alias("d")), F.struct((F.col("high") + 1).alias("k"), (-F.col("c")).alias("d")))).alias("e"))
    return ends.select("e.*").groupBy("k").agg(F.sum("d").alias("d")).where("d != 0")


def _dealt(changes: DataFrame, bounds: list[int]) -> DataFrame:
    """``changes`` with the number of the range they are in."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            part = np.searchsorted(np.array(bounds, np.int64), b.column(0).to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(part)], ["k", "d", "part"])

    return changes.select("k", "d").mapInArrow(run, "k long, d long, part int")


def count_sliding_prefix(df: DataFrame, time_col: str = "ts", size: str | int = "20 seconds", period: str | int = "10 seconds",
                         offset: str | int = 0, on_null: str = "raise", count_col: str = COUNT,
                         range_changes: int = RANGE_CHANGES) -> DataFrame:
    """Rows per sliding window -> ``window_start, window_end, n``, as ``windows.count_sliding``.

    Each row is counted into one slice, a slice makes two changes, and a window that
    is not empty comes out once.  The changes are written in the shared folder, as
    three readings follow: for the bounds, for the totals, and for the counts.
    """
    size_us, period_us = duration_us(size), duration_us(period)
    if size_us <= 0 or period_us <= 0:
        raise ValueError("size and period must be positive")
    off_us = duration_us(offset) % period_us
    spark, ntz = df.sparkSession, isinstance(df.schema[time_col].dataType, TimestampNTZType)
    path = scratch_path(spark, "window-changes")
    window_changes(require_time(df.select(time_col), time_col, on_null), time_col, size_us, period_us, off_us).write.parquet(path)
    changes = spark.read.schema("k long, d long").parquet(path)
    ranges = min(MOST_RANGES, max(1, changes.count() // range_changes))
    fractions = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(changes.agg(F.percentile_approx("k", fractions, 10 * ranges)).first()[0] or [])) if fractions else []
    dealt = _dealt(changes, bounds)
    # First pass: the total and the first change of each range.
    totals = sorted(tuple(r) for r in dealt.groupBy("part").agg(F.sum("d"), F.min("k")).collect())
    before = accumulate((t for _, t, _ in totals), initial=0)
    follows = [k for *_, k in totals[1:]] + [None]
    known = spark.createDataFrame([(p, b, f) for (p, *_), b, f in zip(totals, before, follows, strict=False)], "part int, before long, follows long")
    # Second pass: inside each range.
    along = Window.partitionBy("part").orderBy("k")
    inside = dealt.select("part", "k", F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lead("k").over(along).alias("next"))
    runs = inside.join(F.broadcast(known), "part").select(
        "k", (F.col("before") + F.col("s")).alias(count_col), (F.coalesce("next", "follows") - 1).alias("last")).where(F.col(count_col) > 0)
    steps = runs.select(count_col, "last", F.explode(F.sequence("k", "last", F.lit(RUN_WINDOWS).cast("long"))).alias("k"))
    each = steps.select(count_col, F.explode(F.sequence("k", F.least("last", F.col("k") + F.lit(RUN_WINDOWS - 1)))).alias("k"))
    instant = micros_to_ntz if ntz else F.timestamp_micros
    start = F.col("k") * F.lit(period_us) + F.lit(off_us)
    return each.select(instant(start).alias("window_start"), instant(start + F.lit(size_us)).alias("window_end"), count_col)
