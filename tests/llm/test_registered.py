"""The registered queries whose result SQL can state, against DuckDB; and what the other queries are held to."""

import duckdb
import pytest
from conftest import SF_SMALL
from test_oracle import TABLES, sorted_rows

from panes.llm.oracles import LLM_ORACLE_SQL
from panes.llm.queries import LLM_QUERIES

#: Queries that SQL cannot express, and the tests that hold them to brute force.
BY_TEST = {"op1_kd_shards", "op4_weak_labels", "op5_min_bin_slack", "op9_role_repair", "op10_streaming_viterbi",
           "op12_hyperdimensional"}


def test_every_operator_is_registered_and_checked():
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(LLM_ORACLE_SQL) | BY_TEST == set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = LLM_QUERIES[name](spark, SF_SMALL)
    res = duck.execute(LLM_ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, res.fetchall())


@pytest.mark.parametrize("name", ["op4_weak_labels", "op10_streaming_viterbi"])
def test_query_returns_every_document(spark, name):
    rows = LLM_QUERIES[name](spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
