"""User-defined combiners and generators."""

import json
import sys

import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from panes.operators.combine import Accumulator, combine
from panes.operators.generate import flat_map, generator, json_elements

# What a user writes reaches the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "key string, x long"


class Sum(Accumulator):
    """States that are no numbers, of bytes of their own."""

    def create(self):
        return {"n": 0, "x": 0}

    def add(self, state, batch):
        return {"n": state["n"] + batch.num_rows, "x": state["x"] + (pc.sum(batch.column("x")).as_py() or 0)}

    def merge(self, a, b):
        return {k: a[k] + b[k] for k in a}

    def extract(self, state):
        return [state["n"], state["x"]]

    def dumps(self, state):
        return json.dumps(state).encode()

    def loads(self, data):
        return json.loads(data)


@pytest.mark.parametrize(("fan", "task_keys"), [(64, 50_000), (2, 50_000), (2, 3)])
def test_a_hot_key_and_many_others(spark, fan, task_keys):
    rows = [("hot", i) for i in range(600)] + [(f"k{i % 40}", i) for i in range(300)] + [(None, 1), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    want = {}
    for k, x in rows:
        n, total = want.get(k, (0, 0))
        want[k] = (n + 1, total + (x or 0))
    got = combine(df, Sum(), "array<long>", ["key"], ["x"], name="out", fan=fan, task_keys=task_keys).collect()
    assert len(got) == len(want) and {r["key"]: tuple(r["out"]) for r in got} == want
    whole = combine(df, Sum(), "array<long>", values=["x"], fan=fan).collect()
    assert [tuple(r["result"]) for r in whole] == [(len(rows), sum(x or 0 for _, x in rows))]


def test_no_rows_with_and_without_defaults(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert combine(none, Sum(), "array<long>", ["key"]).collect() == []
    assert combine(none, Sum(), "array<long>", values=["x"]).collect() == []
    assert [r["result"] for r in combine(none, Sum(), "array<long>", values=["x"], defaults=True).collect()] == [[0, 0]]
    one = spark.createDataFrame([("a", 5)], SCHEMA)
    assert [r["result"] for r in combine(one, Sum(), "array<long>", values=["x"], defaults=True).collect()] == [[1, 5]]


def test_a_key_leaves_a_task_as_one_state(spark):
    df = spark.createDataFrame([("hot", i) for i in range(500)], SCHEMA).repartition(6)
    plan = combine(df, Sum(), "array<long>", ["key"])._jdf.queryExecution().executedPlan().toString()
    # Folded in Arrow before anything is shuffled by key.
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange hashpartitioning") < plan.rindex("MapInArrow")


def test_generators_give_none_one_or_many(spark):
    spell = generator(lambda word, n: ((c, i) for i in range(n or 0) for c in word or ""),
                      lambda a: StructType([StructField("letter", StringType()), StructField("round", LongType())]))
    df = spark.createDataFrame([(1, "ab", 2), (2, "", 3), (3, None, 1), (4, "x", 0), (5, "y", None)], "id long, word string, n int")
    got = flat_map(df, spell, "word", "n").select("id", "letter", "round").collect()
    assert sorted(map(tuple, got)) == [(1, "a", 0), (1, "a", 1), (1, "b", 0), (1, "b", 1)]
    kept = flat_map(df, spell, "word", F.col("n"), outer=True).select("id", "letter").collect()
    assert sorted({r["id"] for r in kept}) == [1, 2, 3, 4, 5] and len(kept) == 8


def test_columns_follow_the_arguments_and_bad_ones_are_refused(spark):
    lines = spark.createDataFrame([(1, '["a", 1, {"b": [2]}, null]'), (2, "[]")], "id long, value string")
    rows = flat_map(lines, json_elements, "value").collect()
    assert [(r["id"], r["pos"], r["element"]) for r in rows] == [(1, 0, "a"), (1, 1, "1"), (1, 2, '{"b": [2]}'), (1, 3, "null")]
    with pytest.raises(Exception, match="JSON array"):
        flat_map(lines, json_elements, "id").collect()
