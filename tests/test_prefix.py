"""Sliding counts by prefix sums against rows assigned to windows."""

import datetime as dt
import random

import pytest

from panes.operators.prefix import count_sliding_prefix
from panes.operators.windows import count_sliding

T0 = dt.datetime(1970, 1, 1)


def rows(df):
    return sorted((r.window_start, r.window_end, r.n) for r in df.collect())


@pytest.mark.parametrize(("size", "period", "offset"), [(20, 10, 0), (25, 10, 3), (10, 10, 0), (5, 20, 7), (3600, 7, 1)])
def test_prefix_sums_give_what_copies_give(spark, size, period, offset):
    r = random.Random(size)
    # Before 1970 too, on borders, repeated, and with gaps longer than a window.
    at = [T0 + dt.timedelta(seconds=r.choice([-40_000, 0, 10, 900, 20_000]) + r.randint(0, 60), microseconds=r.choice([0, 1, 999_999])) for _ in range(300)]
    at += [T0 + dt.timedelta(seconds=20)] * 50
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(x,) for x in at], "ts timestamp_ntz").selectExpr(f"cast(ts as {kind}) as ts")
        want = rows(count_sliding(df, "ts", size, period, offset, method="expand"))
        for range_changes in (50_000, 20, 1):
            got = count_sliding_prefix(df, "ts", size, period, offset, range_changes=range_changes)
            assert rows(got) == want, (kind, range_changes)
            if kind == "timestamp":
                break


def test_no_rows_and_missing_times(spark):
    none = spark.createDataFrame([], "ts timestamp_ntz")
    assert count_sliding(none, "ts", 60, 10, method="prefix").collect() == []
    some = spark.createDataFrame([(None,), (T0,)], "ts timestamp_ntz")
    assert len(count_sliding(some, "ts", 60, 10, on_null="drop", method="prefix").collect()) == 6
    with pytest.raises(Exception, match="without event time"):
        count_sliding(some, "ts", 60, 10, method="prefix")
    with pytest.raises(ValueError, match="positive"):
        count_sliding(none, "ts", 60, 0, method="prefix")


def test_no_row_is_copied_into_its_windows(spark):
    at = [(T0 + dt.timedelta(seconds=s),) for s in range(0, 5000, 5)]
    df = spark.createDataFrame(at, "ts timestamp_ntz")
    out = count_sliding(df, "ts", "1 day", "10 seconds", method="prefix")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SinglePartition" not in plan
    assert out.count() == 8640 + 499 and max(r.n for r in out.collect()) == 1000
