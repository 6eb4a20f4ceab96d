"""Centroid clustering over an incremental distance matrix.

Vectors are integer: a component x is ``floor(scale * x)``.  For every vector the
exact integer dot products with all centroids are kept as a row of a table,
together with the vector.  When centroids move, a row's products change only by
the components in which a centroid did change: ``x . c' = x . c + sum of x_j *
(c'_j - c_j)`` over those; a centroid that stays costs nothing.  With the squared
lengths this gives the distances, and the nearest centroid is taken anew.  The
first products are such a change too, from centroids of zeros.

A round reads the table of the round before, writes the next one and adds up the
vectors of each cluster, combined in every task; the driver has a sum for each
cluster and component, and divides exactly.  Nothing is shuffled but these sums,
and a lost executor's rows are read again from the written table.

Defined results.  Kept are vectors of ``dimensions`` components, none of them null,
not finite, or so large that a squared distance would not fit 64 bits (``2**27``
after scaling).  The first centroids are the kept vectors with the smallest hex
SHA-256 of ``seed:vec_id``, in that order; of vectors with the same id the one with
the lesser components comes first, and a null id comes after all others.  With
fewer vectors than ``k`` there are fewer centroids; with none, no rows.  Ties go to
the centroid with the smaller number, a centroid without vectors stays.  Rows that
repeat count as often as they come.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, ship_package, write_table

#: Components after scaling are below this in size.
MOST = 1 << 27


def exact_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y`` of integers, exactly: in double precision as long as no sum can reach 2**53."""
    if not x.size or not y.size:
        return np.zeros((x.shape[0], y.shape[1]), np.int64)
    if int(np.abs(x).max()) * int(np.abs(y).max()) * x.shape[1] < 1 << 53:
        return np.rint(x.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
    return x @ y


def update(dots: np.ndarray, vectors: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The products of ``vectors`` with the centroids ``after``, from ``dots``, those with the centroids ``before``.

    Centroids whose changes are in the same components are updated together.
    """
    out, change = dots.copy(), after - before
    moved = np.flatnonzero(change.any(axis=1))
    by: dict[bytes, list[int]] = {}
    for c in moved.tolist():
        by.setdefault((change[c] != 0).tobytes(), []).append(c)
    for mask, own in by.items():
        parts = np.flatnonzero(np.frombuffer(mask, bool))
        out[:, own] += exact_product(vectors[:, parts], change[own][:, parts].T)
    return out


def nearest(dots: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (the first of equals), and the squared distance."""
    apart = (vectors * vectors).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None]
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(best)), best]


def _rows(column: pa.Array, width: int) -> np.ndarray:
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(data.to_pylist()), np.int64).reshape(len(data), width)


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """vec_id and vector (``dimensions`` integers of 64 bits as bytes) of the rows that are kept."""
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("vector", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            full = pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False)
            batch = batch.filter(full)
            lists = batch.column(1)
            flat = lists.flatten().cast(pa.float64())
            x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(len(lists), dimensions)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(scale * x)
                good = (np.abs(scaled) < MOST).all(axis=1)  # no comparison with nan holds
            ids, whole = batch.column(0).filter(pa.array(good)), np.where(good[:, None], scaled, 0).astype(np.int64)[good]
            yield pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in whole], pa.binary())], schema.fieldNames())

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def _advance(rows: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """vec_id, vector, dots, cluster and distance, for the centroids ``after``."""
    k, dimensions = after.shape
    schema = T.StructType([rows.schema["vec_id"], T.StructField("vector", T.BinaryType()), T.StructField("dots", T.BinaryType()),
                           T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column("vector"), dimensions)
            dots = _rows(batch.column("dots"), k) if "dots" in batch.schema.names else np.zeros((len(x), k), np.int64)
            dots = update(dots, x, before, after)
            cluster, distance = nearest(dots, x, after)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("vector"), pa.array([d.tobytes() for d in dots], pa.binary()),
                pa.array(cluster.astype(np.int32)), pa.array(distance)], schema.fieldNames())

    return rows.select(*[c for c in ("vec_id", "vector", "dots") if c in rows.columns]).mapInArrow(run, schema)


def _sums(rows: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, list[list[int]]]:
    """How many vectors each cluster has, and their sums by component: exact, whatever their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            x, cluster = _rows(batch.column("vector"), dimensions), batch.column("cluster").to_numpy()
            counts += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, x)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(counts[own]),
                                          pa.array(sums[own].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = rows.select("vector", "cluster").mapInArrow(run, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("j", "s")).groupBy("cluster", "j").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    counts, sums = np.zeros(k, object), [[0] * dimensions for _ in range(k)]
    for r in each:
        counts[r["cluster"]] = r["n"]
        sums[r["cluster"]][r["j"]] = int(r["s"])
    return counts, sums


def moved(centroids: np.ndarray, counts, sums: list[list[int]]) -> np.ndarray:
    """The floor of each cluster's mean; a cluster without vectors stays."""
    return np.array([[s // int(n) for s in own] if n else old.tolist() for old, n, own in zip(centroids, counts, sums, strict=True)], np.int64)


def cluster(vectors: DataFrame, k: int, rounds: int, seed: str, dimensions: int, scale: int = 256) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (array) for every kept row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    ship_package(spark)
    kept = write_table(integer_vectors(vectors, dimensions, scale), "integer-vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.select(F.col("vec_id").isNull().alias("no_id"), hashed.alias("hash"), "vector")
    first = sorted(((r["no_id"], r["hash"] or "", np.frombuffer(r["vector"], np.int64).tolist())
                    for r in chosen.orderBy("no_id", "hash", "vector").limit(k).collect()))
    after = np.array([x for *_, x in first], np.int64).reshape(len(first), dimensions)
    id_type = vectors.schema["vec_id"].dataType
    if not first:
        return spark.createDataFrame([], T.StructType([T.StructField("vec_id", id_type), T.StructField("cluster", T.IntegerType()), *[
            T.StructField(c, T.LongType()) for c in ("distance", "cluster_inertia", "inertia")], T.StructField("centroid", T.ArrayType(T.LongType()))]))
    rows, before = kept, np.zeros_like(after)
    for last in [False] * rounds + [True]:
        new = write_table(_advance(rows, before, after), "distance-matrix")
        drop_table(rows)
        rows, before = new, after
        if not last:
            after = moved(after, *_sums(rows, len(first), dimensions))
    # A row for each centroid: no more than k.
    inertia = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    held = {r["cluster"]: int(r["own"]) for r in inertia.collect()}
    facts = spark.createDataFrame([(c, held[c], sum(held.values()), after[c].tolist()) for c in sorted(held)],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return rows.select("vec_id", "cluster", "distance").join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
