"""User-defined combiners (U3, G1): an accumulator with create, add, merge and extract.

The accumulator's ``add`` takes a whole Arrow batch of one key at a time.  A task
folds its rows into one state a key, which leaves it as bytes; states of a key are
merged in a tree, ``fan`` at a time, so that a key that all rows have is one state a
task in the shuffle, and no task merges more than ``fan`` of them.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys a task holds before it sends their states on; states merged at once.
TASK_KEYS, FAN = 50_000, 64


class Accumulator:
    """What a user writes.  States may be anything that ``dumps`` turns into bytes."""

    def create(self):
        """The state of no rows."""
        raise NotImplementedError

    def add(self, state, batch):
        """``state`` with the rows of an Arrow batch of the value columns."""
        raise NotImplementedError

    def merge(self, a, b):
        """The state of the rows of both."""
        raise NotImplementedError

    def extract(self, state):
        """The result, of the type given to ``combine``."""
        raise NotImplementedError

    def dumps(self, state) -> bytes:
        return pickle.dumps(state)

    def loads(self, data: bytes):
        return pickle.loads(data)


class CountAndTop(Accumulator):
    """An accumulator as a user writes one: rows, rows of a value over a bound, and the largest ids."""

    def __init__(self, bound: float, top: int):
        self.bound, self.top = bound, top

    def create(self):
        return 0, 0, []

    def add(self, state, batch):
        import pyarrow.compute as pc

        n, over, ids = state
        over += pc.sum(pc.greater(batch.column("value"), self.bound)).as_py() or 0
        own = batch.column("event_id")
        largest = own.take(pc.select_k_unstable(own, self.top, [("", "descending")]))
        return n + batch.num_rows, over, sorted([*ids, *largest.to_pylist()], reverse=True)[:self.top]

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1], sorted([*a[2], *b[2]], reverse=True)[:self.top]

    def extract(self, state):
        return {"n": state[0], "over": state[1], "top": state[2]}


def _partial(accumulator: Accumulator, n_keys: int, task_keys: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        held: dict[tuple, object] = {}
        names, types = None, None

        def send():
            columns = list(zip(*held, strict=True)) if n_keys else []
            states = [accumulator.dumps(s) for s in held.values()]
            return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], pa.array(states, pa.binary())],
                                              [*names, "state"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names, types = batch.schema.names[:n_keys], [batch.column(i).type for i in range(n_keys)]
            values = batch.select(batch.schema.names[n_keys:])
            rows: dict[tuple, list[int]] = {}
            if n_keys:
                for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(n_keys)), strict=True)):
                    rows.setdefault(key, []).append(i)
            else:
                rows[()] = None
            for key, at in rows.items():
                own = values if at is None else values.take(pa.array(at))
                held[key] = accumulator.add(held[key] if key in held else accumulator.create(), own)
            if len(held) >= task_keys:
                yield send()
                held.clear()
        if held:
            yield send()

    return run


def combine(df: DataFrame, accumulator: Accumulator, result: str, keys: list[str] = (), values: list[str] | None = None,
            name: str = "result", defaults: bool = False, fan: int = FAN, task_keys: int = TASK_KEYS) -> DataFrame:
    """``keys`` and ``name``, the accumulator's result (of SQL type ``result``) for the rows of each key.

    Without ``keys`` there is one result; of no rows there is none, or with
    ``defaults`` that of a state just created.  NULL is a key like any other.
    """
    spark, keys = df.sparkSession, list(keys)
    values = [c for c in df.columns if c not in keys] if values is None else values
    rows = df.select(*keys, *values)
    schema = StructType([*[rows.schema[k] for k in keys], StructField("state", BinaryType())])
    states = rows.mapInArrow(_partial(accumulator, len(keys), task_keys), schema)
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    # As many lanes as tasks at first: a key has about one state in a lane of its own.
    states = states.withColumn("lane", F.spark_partition_id().cast("long"))
    merged_type = StructType([*schema.fields, StructField("lane", LongType())])

    def merge(group):
        import pyarrow as pa

        at = None
        for data in group.column("state").to_pylist():
            own = accumulator.loads(data)
            at = own if at is None else accumulator.merge(at, own)
        first = group.slice(0, 1)
        return pa.table([*[first.column(k) for k in keys], pa.array([accumulator.dumps(at)], pa.binary()), first.column("next")], names=[*keys, "state", "lane"])

    while True:
        lanes = -(-lanes // fan)
        grouped = states.withColumn("next", F.floor(F.col("lane") / F.lit(fan)) if lanes > 1 else F.lit(0).cast("long")).drop("lane")
        states = grouped.groupBy(*keys, "next").applyInArrow(merge, merged_type)
        if lanes == 1:
            break
    out_type = StructType.fromDDL(f"r {result}")["r"].dataType

    def extract(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(out_type)
        for batch in batches:
            found = [accumulator.extract(accumulator.loads(x)) for x in batch.column("state").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(found, kind)], [*keys, name])

    out = states.select(*keys, "state").mapInArrow(extract, StructType([*[rows.schema[k] for k in keys], StructField(name, out_type)]))
    if defaults and not keys:
        empty = spark.createDataFrame([(accumulator.extract(accumulator.create()),)], StructType([StructField(name, out_type)]))
        marked = out.withColumn("real", F.lit(1)).unionByName(empty.withColumn("real", F.lit(0)))
        # One row, or two: the one of rows comes first.
        out = marked.orderBy(F.desc("real")).limit(1).drop("real")
    return out
