"""Batch twins of the processing-time triggers (T4, T5 with ``repeat=False``).

Over a table with an arrival column they answer "what did the first pane
hold?": the rows that arrived before ``first arrival + delay`` (strictly
before: a row arriving at the firing instant misses the pane).  A NULL arrival
fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import duration_us, interval_us
from .windows import COUNT, count_fixed, count_global, fixed_window, require_time


def first_pane_global(df: DataFrame, arrival_col: str, delay: str = "10 seconds") -> DataFrame:
    """T4 twin: count of rows in the global window's first pane.

    The pane's end is a scalar subquery (one value, no join); it is pushed into
    the scan, and the count runs with a partial count per task.
    """
    t = F.col(arrival_col)
    # The end as a whole is the subquery's value, so the scan gets the filter;
    # the subquery reads every arrival and so is where a NULL one is met.
    end = require_time(df.select(arrival_col), arrival_col).select(F.min(t) + interval_us(duration_us(delay))).scalar()
    return count_global(df.where(t < end))


#: Shares a window's rows are dealt into, so that a hot window is not one task's.
SALTS = 32


def first_pane_windows(df: DataFrame, arrival_col: str, size: str = "10 seconds",
                       delay: str = "30 seconds", salts: int = SALTS) -> DataFrame:
    """T5 twin: per fixed window of arrival time, rows in its first pane.

    When the delay is at least the window size every row of a window arrives
    before its pane fires, so the answer is the fixed-window count.  Otherwise
    each window's first arrival is joined back.  Windows are few beside rows:
    Spark broadcasts them if they turn out small at run time; if not, rows are
    joined by window and salt, so a window of any size spreads over ``salts``
    tasks, and their counts are added up.
    """
    size_us, delay_us = duration_us(size), duration_us(delay)
    if delay_us >= size_us:
        return count_fixed(df, arrival_col, size)
    t = F.col(arrival_col)
    keyed = require_time(df.select(arrival_col), arrival_col).select(fixed_window(t, size).start.alias("window_start"), t.alias("_t"),
                                                                     F.pmod(F.xxhash64(t), F.lit(salts)).alias("_salt"))
    firsts = keyed.groupBy("window_start").agg(F.min("_t").alias("_first"))
    firsts = firsts.select("window_start", "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt"))
    inside = keyed.join(firsts, ["window_start", "_salt"]).where(F.col("_t") < F.col("_first") + interval_us(delay_us))
    return (inside.groupBy("window_start").agg(F.count(F.lit(1)).alias(COUNT))
                  .select("window_start", (F.col("window_start") + interval_us(size_us)).alias("window_end"),
                          COUNT))
