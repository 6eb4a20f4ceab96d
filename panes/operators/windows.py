"""Window assignment and per-window counts (W1-W4, G1, G2) for batch DataFrames.

Every count is a partial + final hash aggregate: each task folds its rows into
one row per window before the shuffle, so a hot window costs one row per task,
not one task holding the window's rows.

Sliding windows are computed from *slices*: a fixed count over windows of
``gcd(size, period)`` on the raw rows, then the sliding assignment over the
(much smaller) aggregated slices.  The raw rows are hashed once instead of
``size / period`` times.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import col_of, duration_us, interval_us

COUNT = "n"


def require_time(df: DataFrame, time_col: str, on_null: str = "raise") -> DataFrame:
    """NULL event time: ``raise`` (the reference fails the pipeline) or ``drop``.

    ``F.window`` drops NULL times silently; with ``raise`` the check runs first.
    """
    if on_null == "drop":
        return df.where(F.col(time_col).isNotNull())
    if on_null != "raise":
        raise ValueError("on_null must be 'raise' or 'drop'")
    c = F.col(time_col)
    return df.withColumn(time_col, F.when(c.isNull(), F.raise_error(
        F.lit(f"record without event time in column {time_col}"))).otherwise(c))


def _window_us(t: str | Column, size_us: int, slide_us: int, off_us: int) -> Column:
    return F.window(col_of(t), f"{size_us} microseconds", f"{slide_us} microseconds",
                    f"{off_us % slide_us} microseconds")


def fixed_window(t: str | Column, size: str | int, offset: str | int = 0) -> Column:
    """Tumbling window struct ``(start, end)``, ``[start, end)``, epoch aligned."""
    size_us = duration_us(size)
    return _window_us(t, size_us, size_us, duration_us(offset))


def sliding_window(t: str | Column, size: str | int, period: str | int,
                   offset: str | int = 0) -> Column:
    """Sliding window struct; one row per window holding ``t``."""
    return _window_us(t, duration_us(size), duration_us(period), duration_us(offset))


def _flatten(agg: DataFrame, count_col: str) -> DataFrame:
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), count_col)


def count_fixed(df: DataFrame, time_col: str = "ts", size: str | int = "10 seconds",
                offset: str | int = 0, on_null: str = "raise",
                count_col: str = COUNT) -> DataFrame:
    """Rows per fixed window -> ``window_start, window_end, n`` (W3 + G1 + G2).

    Only non-empty windows appear (``without_defaults``).
    """
    df = require_time(df.select(time_col), time_col, on_null)
    agg = df.groupBy(fixed_window(time_col, size, offset).alias("window")) \
            .agg(F.count(F.lit(1)).alias(count_col))
    return _flatten(agg, count_col)


def count_sliding(df: DataFrame, time_col: str = "ts", size: str | int = "20 seconds",
                  period: str | int = "10 seconds", offset: str | int = 0,
                  on_null: str = "raise", count_col: str = COUNT,
                  method: str = "slices") -> DataFrame:
    """Rows per sliding window -> ``window_start, window_end, n`` (W4 + G1 + G2).

    Each row counts in every window that holds it (``size / period`` windows
    when the period divides the size).  Slices of width ``gcd(size, period)``
    tile every window exactly, so slice counts summed per window give the
    same numbers as assigning raw rows to windows.

    ``method="slices"`` (default) hashes each raw row once and expands only
    the aggregated slices, at the price of a second, small exchange: the
    right plan when many rows share a slice (dense event time, large data).
    ``method="expand"`` assigns raw rows to windows in one exchange: cheaper
    when slices hold about one row each (sparse event time, small data).
    ``method="prefix"`` takes two changes a slice instead of ``size / period``
    copies and sums them up along the windows (``operators.prefix``): the right
    plan when windows overlap many times (1 day every 10 s).
    """
    if method == "prefix":
        from .prefix import count_sliding_prefix

        return count_sliding_prefix(df, time_col, size, period, offset, on_null, count_col)
    if method == "expand":
        return count_sliding_expand(df, time_col, size, period, offset, on_null, count_col)
    if method != "slices":
        raise ValueError("method must be 'slices', 'expand' or 'prefix'")
    size_us, period_us = duration_us(size), duration_us(period)
    if size_us <= 0 or period_us <= 0:
        raise ValueError("size and period must be positive")
    off_us = duration_us(offset) % period_us
    g = gcd(size_us, period_us)
    df = require_time(df.select(time_col), time_col, on_null)
    slices = (df.groupBy(_window_us(time_col, g, g, off_us).alias("slice"))
                .agg(F.count(F.lit(1)).alias("_slice_n"))
                .select(F.col("slice.start").alias("_slice_start"), "_slice_n"))
    if period_us > size_us:
        return _gapped(slices, "_slice_start", F.col("_slice_n"), size_us, period_us, off_us,
                       count_col)
    # A slice lies wholly inside every window that holds its start.
    agg = (slices.groupBy(_window_us("_slice_start", size_us, period_us, off_us).alias("window"))
                 .agg(F.sum("_slice_n").cast("long").alias(count_col)))
    return _flatten(agg, count_col)


def _gapped(df: DataFrame, t: str, weight: Column, size_us: int, period_us: int, off_us: int,
            count_col: str) -> DataFrame:
    """Windows shorter than their period (gaps between windows): at most one
    window per row, the period bucket's, if the row falls in its first ``size``."""
    b = _window_us(t, period_us, period_us, off_us).start
    inside = df.select(b.alias("window_start"), F.col(t).alias("_t"), weight.alias("_w")) \
               .where(F.col("_t") < F.col("window_start") + interval_us(size_us))
    agg = inside.groupBy("window_start").agg(F.sum("_w").cast("long").alias(count_col))
    return agg.select("window_start", (F.col("window_start") + interval_us(size_us)).alias("window_end"),
                      count_col)


def count_sliding_expand(df: DataFrame, time_col: str = "ts", size: str | int = "20 seconds",
                         period: str | int = "10 seconds", offset: str | int = 0,
                         on_null: str = "raise", count_col: str = COUNT) -> DataFrame:
    """Same result as ``count_sliding`` by assigning raw rows to windows.

    Kept as the independent check of the slice method (tests) and for users who
    want the one-shuffle plan when slices would not shrink the data.
    """
    df = require_time(df.select(time_col), time_col, on_null)
    size_us, period_us = duration_us(size), duration_us(period)
    if period_us > size_us:
        return _gapped(df, time_col, F.lit(1), size_us, period_us, duration_us(offset), count_col)
    agg = df.groupBy(sliding_window(time_col, size, period, offset).alias("window")) \
            .agg(F.count(F.lit(1)).alias(count_col))
    return _flatten(agg, count_col)


def count_global(df: DataFrame, count_col: str = COUNT) -> DataFrame:
    """Count over the global window, ``without_defaults`` (W1/W2 + G1 + G2).

    One row holding the count, or no row at all on empty input (not a 0).
    """
    return df.agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 0)


def global_window(df: DataFrame) -> DataFrame:
    """Explicit global window (W2): every row is already in it; a no-op."""
    return df
