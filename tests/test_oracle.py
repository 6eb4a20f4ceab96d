"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from panes.plans.oracles import ORACLE_SQL
from panes.plans.queries import QUERIES
from panes.plans.streams import STREAM_QUERIES

CORE = {**QUERIES, **STREAM_QUERIES}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def sorted_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(CORE)
    assert set(CORE) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert sorted_rows(df.columns, got) == sorted_rows(ocols, want)


@pytest.mark.parametrize("name", ["fixed_window_count", "sliding_window_count", "iso_parse",
                                  "record_to_json", "stamp_jitter", "stream_fixed_window",
                                  "stream_message_tap_data", "stream_arrival_fixed_window"])
def test_time_queries_do_not_depend_on_the_session_zone(spark, duck, name):
    """The driver's session may use any zone: zone-less times are UTC wall clock."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted_rows(df.columns, got) == sorted_rows(ocols, res.fetchall())


def test_most_objects_of_words_repeat_keys(spark):
    keys, items = (QUERIES[q](spark, SF_SMALL) for q in ("json_object_repeated_keys", "json_array_length"))
    both = keys.join(items, "doc_id").collect()
    assert sum(r.n_keys < r.n_items for r in both) > len(both) / 2
