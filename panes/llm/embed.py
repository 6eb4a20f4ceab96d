"""Near-duplicate vectors by an epsilon grid order join.

On unit vectors a cosine of at least ``c`` is a distance of at most
``eps = sqrt(2 - 2c)``.  Vectors are projected on their leading principal
directions, put into grid cells of width ``eps`` and sorted by cell
(lexicographically: the epsilon grid order of Böhm et al., SIGMOD 2001) across
the cluster.  Consecutive vectors of the sequence form blocks with a bounding
box.  Two blocks are joined only if their boxes are at most ``eps`` apart; a
projection never lengthens a distance, so a skipped pair provably has no link.
Inside a joined pair the sequence intervals are halved recursively, skipping
halves in the same way, and what is left is compared by dot products in double
precision.

Consecutive blocks form an interval, consecutive intervals a group.  A task holds
the blocks of one interval and lets the later blocks of one group that are near its
box pass by, one at a time: a block travels once for each interval that it is near
to, not once for each block, and an interval once for each group.  Which those are
is decided before any vector is shipped, from the boxes alone.  So a task compares
at most ``INTERVAL`` with ``GROUP * INTERVAL`` blocks, whatever the number of
vectors of a label, and vectors are shipped as they came, not as doubles.

Links are counted where they are found and leave the task as one count a vector
and as few links as join the components, never as all pairs.  Equal vectors are
one class from the start, with its number of copies.

The directions are fitted on a bounded sample (``FIT_VECTORS``); they decide how
much is skipped, not what is found.

Defined results.  Only vectors of equal labels and equal lengths are compared.  A
null label, and a vector that is null, empty, zero or has a null or non-finite
component, links with nothing: no links, a component of its own.  Rows that
repeat are linked copies.  A null ``vec_id`` ranks after all others; a component
without any id has a null id, its rows kept.  An empty table gives no rows.  Only
``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, hash_sample, ship_package, small_side, write_table
from .components import components
from .minhash import forest

#: Vectors the principal directions are fitted on at most.
FIT_VECTORS = 4096
#: Directions in the sort order, and in the bounding boxes.
SORT_DIMS, BOX_DIMS = 4, 8
#: Vectors of a block at most, and of a part of it that is no longer halved.
BLOCK, LEAF = 128, 64
#: Blocks of an interval, and intervals of a group at most.
INTERVAL, GROUP = 32, 8
#: Least width of the cells of the first direction in which boxes meet.
LEAST_WIDTH = 1 / 64
#: Added to eps so that rounding never skips a pair.
SLACK = 1e-9


def unit_rows(x: np.ndarray) -> np.ndarray:
    """The rows of ``x`` (finite, none of them zero) at length one."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) + 0.0  # + 0.0: no negative zeros


def _raw_type(vectors: DataFrame) -> type:
    """The type a component is kept and shipped in."""
    return np.float32 if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else np.float64


def _vector_rows(vectors: DataFrame, kind: type) -> DataFrame:
    """vec_id, digest of the unit vector (null if it links with nothing), place and raw components of every row."""
    schema = T.StructType([T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("digest", T.BinaryType()),
                           T.StructField("place", T.StringType()), T.StructField("raw", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            digests, places, raws = [], [], []
            for vector, label in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                digest = place = raw = None
                if label is not None and vector.is_valid and len(vector) and not vector.values.null_count:
                    x = vector.values.to_numpy(zero_copy_only=False).astype(kind)
                    scale = np.abs(x).max()
                    if np.isfinite(scale) and scale > 0:
                        place, raw = f"{len(x)}:{label}", x.tobytes()
                        digest = xxhash.xxh3_128_digest(place.encode() + b"|" + unit_rows(x[None]).tobytes())
                digests.append(digest)
                places.append(place)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(places, pa.string()),
                                              pa.array(raws, pa.binary())], schema.fieldNames())

    return vectors.select("vec_id", "embedding", "label").mapInArrow(run, schema)


def directions(units: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each length of vectors, its leading principal directions as columns."""
    out = {}
    for size in {len(u) for u in units}:
        own = np.stack([u for u in units if len(u) == size])
        _, vectors = np.linalg.eigh(own.T @ own)
        out[size] = np.ascontiguousarray(vectors[:, ::-1][:, :BOX_DIMS])
    return out


def project(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates along the directions; along the first axes for a length that was not fitted."""
    n, size = units.shape
    out = np.zeros((n, BOX_DIMS))
    along = axes.get(size, np.eye(size)[:, :BOX_DIMS])
    out[:, :along.shape[1]] = units @ along
    return out


def gap(a_low: np.ndarray, a_high: np.ndarray, b_low: np.ndarray, b_high: np.ndarray) -> float:
    """The distance of two boxes."""
    apart = np.maximum(0, np.maximum(a_low - b_high, b_low - a_high))
    return float(np.sqrt((apart * apart).sum()))


def join_intervals(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, least: float, eps: float,
                   i: int = 0, j: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of rows of ``a`` and ``b`` with a dot product of at least ``least``."""
    if gap(pa_.min(axis=0), pa_.max(axis=0), pb.min(axis=0), pb.max(axis=0)) > eps:
        return
    if len(a) <= LEAF and len(b) <= LEAF:
        x, y = np.nonzero(a @ b.T >= least)
        if len(x):
            yield x + i, y + j
        return
    halves = lambda n: ((0, n // 2), (n // 2, n)) if n > LEAF else ((0, n),)
    for s, t in halves(len(a)):
        for u, v in halves(len(b)):
            yield from join_intervals(a[s:t], b[u:v], pa_[s:t], pb[u:v], least, eps, i + s, j + u)


def _blocks(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, kind: type) -> DataFrame:
    """Blocks of the sequence: place, interval and group, box, the interval's box at its first block, and the vectors.

    Blocks, intervals and groups are numbered along the sequence.
    """
    grid = [f"c{i}" for i in range(SORT_DIMS)]
    held = ["node", "place", "copies", "raw"]
    cell_schema = "node long, place string, copies long, raw binary, " + ", ".join(f"{c} long" for c in grid)
    width = max(eps, LEAST_WIDTH)
    block_size, interval_size, group_size = BLOCK, INTERVAL, GROUP

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raws = [np.frombuffer(u.as_buffer(), kind) for u in batch.column("raw")]
            at = np.concatenate([project(unit_rows(u[None]), axes) for u in raws])[:, :SORT_DIMS]
            at = np.floor(at / eps).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in held], *[pa.array(at[:, i]) for i in range(SORT_DIMS)]],
                                             [*held, *grid])

    names = ["place", "block", "interval", "group", "first", "last", "low", "high", "head", "i_first", "i_last", "i_low", "i_high",
             "nodes", "copies", "raws"]
    doubles = pa.list_(pa.float64())
    kinds = [pa.string(), *[pa.int64()] * 5, doubles, doubles, pa.bool_(), pa.int64(), pa.int64(), doubles, doubles, *[pa.binary()] * 3]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start = TaskContext.get().partitionId() << 32
        block = interval = start
        group, in_group, last_place = start, 0, None
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nonlocal block, interval, group, in_group, last_place
            place = rows[0][1]
            if in_group == group_size or (last_place is not None and place != last_place):
                group, in_group = group + 1, 0
            last_place = place
            nodes, _, copies, raws = zip(*rows, strict=True)
            nodes, copies = np.array(nodes, np.int64), np.array(copies, np.int64)
            raw = np.frombuffer(b"".join(raws), kind).reshape(len(rows), -1)
            at = project(unit_rows(raw), axes)
            cell = lambda x: int(np.floor(x / width))
            i_low, i_high = at.min(axis=0), at.max(axis=0)
            out = []
            for i in range(0, len(rows), block_size):
                own = slice(i, i + block_size)
                low, high = at[own].min(axis=0), at[own].max(axis=0)
                out.append([place, block, interval, group, cell(low[0]), cell(high[0]), low.tolist(), high.tolist(), i == 0,
                            cell(i_low[0]), cell(i_high[0]), i_low.tolist(), i_high.tolist(),
                            nodes[own].tobytes(), copies[own].tobytes(), raw[own].tobytes()])
                block += 1
            interval, in_group = interval + 1, in_group + 1
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in held), strict=True):
                if rows and (rows[0][1] != row[1] or len(rows) >= interval_size * block_size):
                    yield packed()
                rows.append(row)
        if rows:
            yield packed()

    order = ["place", *grid, "node"]
    ordered = classes.select(*held).mapInArrow(cells, cell_schema)
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select(*held)
    return ordered.mapInArrow(pack, "place string, block long, interval long, group long, first long, last long, low array<double>, "
                                    "high array<double>, head boolean, i_first long, i_last long, i_low array<double>, "
                                    "i_high array<double>, nodes binary, copies binary, raws binary")


def _near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """Intervals (a) and later blocks (block, of group g) whose boxes are at most ``eps`` apart."""
    # Boxes of one place meet in a cell of the first direction, or in neighbouring ones; a pair counts in the first such cell.
    a = blocks.filter("head").select("place", F.col("interval").alias("a"), "i_first", "i_low", "i_high",
                                     F.explode(F.sequence(F.col("i_first") - 1, F.col("i_last") + 1)).alias("cell"))
    b = blocks.select("place", "interval", "block", F.col("group").alias("g"), "first", "low", "high",
                      F.explode(F.sequence("first", "last")).alias("cell"))
    apart = F.zip_with(F.zip_with("i_low", "high", lambda x, y: x - y), F.zip_with("low", "i_high", lambda x, y: x - y),
                       lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2))
    near = F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)) <= eps
    once = F.col("cell") == F.greatest(F.col("i_first") - 1, F.col("first"))
    return a.join(b, ["place", "cell"]).filter(F.col("a") < F.col("interval")).filter(once & near).select("a", "g", "block")


def _join(blocks: DataFrame, near: DataFrame, least: float, eps: float, axes: dict[int, np.ndarray], kind: type) -> DataFrame:
    """Rows (u, null, number of vectors linked with u) and links (u, v, null) that join the components.

    ``near`` is a written table.  A tile is an interval with the blocks of one group:
    first come the blocks it holds (``passing`` is false), then those that pass by.
    """
    payload = ["block", "low", "high", "nodes", "copies", "raws"]
    heads = blocks.filter("head").select(F.col("interval").alias("a"), F.col("group").alias("g"))
    tiles = write_table(near.select("a", "g").unionByName(heads).distinct(), "vector-tiles")
    holding = blocks.join(small_side(tiles), F.col("interval") == F.col("a")).select(
        "a", "g", F.lit(False).alias("passing"), (F.col("group") == F.col("g")).alias("own"), *payload)
    passing = blocks.join(small_side(near), "block").select("a", "g", F.lit(True).alias("passing"), F.lit(False).alias("own"), *payload)
    dealt = holding.unionByName(passing).repartition("a", "g").sortWithinPartitions("a", "g", "passing", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def result(counts: list[tuple[np.ndarray, np.ndarray]], links: list[tuple[int, int]]) -> pa.RecordBatch:
            some = [(nodes[n > 0], n[n > 0]) for nodes, n in counts]
            u = np.concatenate([*[x for x, _ in some], np.array([x for x, _ in links], np.int64)])
            n = np.concatenate([np.zeros(0, np.int64), *[x for _, x in some]])
            return pa.RecordBatch.from_arrays([
                pa.array(u, pa.int64()), pa.array([None] * len(n) + [y for _, y in links], pa.int64()),
                pa.array([*n.tolist(), *[None] * len(links)], pa.int64())], ["u", "v", "n"])

        def against(new: dict, others: list[dict]) -> list[tuple[int, int]]:
            """Count the links between a block and others; as few of them as join the same components."""
            pairs = []
            for o in others:
                same = o is new
                found = list(join_intervals(o["units"], new["units"], o["at"], new["at"], least, eps))
                if not found:
                    continue
                i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                if same:
                    i, j = i[i < j], j[i < j]
                o["found"] += np.bincount(i, new["copies"][j], len(o["nodes"])).astype(np.int64)
                new["found"] += np.bincount(j, o["copies"][i], len(new["nodes"])).astype(np.int64)
                pairs.append(np.stack([o["nodes"][i], new["nodes"][j]], axis=1))
            return forest(np.concatenate(pairs)) if pairs else []

        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n] for c in batch.schema.names}
                if key != (row["a"].as_py(), row["g"].as_py()):
                    if held:
                        yield result([(o["nodes"], o["found"]) for o in held], [])
                    key, held = (row["a"].as_py(), row["g"].as_py()), []
                nodes, copies = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("nodes", "copies"))
                units = unit_rows(np.frombuffer(row["raws"].as_buffer(), kind).reshape(len(nodes), -1))
                new = {"nodes": nodes, "copies": copies, "units": units, "at": project(units, axes), "found": np.zeros(len(nodes), np.int64)}
                passing = row["passing"].as_py()
                if not passing:
                    held.append(new)
                links = against(new, held) if passing or row["own"].as_py() else []
                if links or passing and new["found"].any():
                    yield result([(nodes, new["found"])] if passing else [], links)
        if held:
            yield result([(o["nodes"], o["found"]) for o in held], [])

    return dealt.mapInArrow(run, "u long, v long, n long")


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label)."""
    ship_package(vectors.sparkSession)
    eps = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
    kind = _raw_type(vectors)
    rows = write_table(_vector_rows(vectors, kind), "vectors")
    classes = write_table(rows.filter("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("place").alias("place"), F.first("raw").alias("raw")
    ).withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sample = hash_sample(classes, ["digest"], FIT_VECTORS, classes.count()).select("raw").limit(FIT_VECTORS).collect()
    axes = directions([unit_rows(np.frombuffer(r["raw"], kind)[None])[0] for r in sample]) if sample else {}
    blocks = write_table(_blocks(classes, axes, eps, kind), "vector-blocks")
    near = write_table(_near_blocks(blocks, eps), "near-blocks")
    found = write_table(_join(blocks, near, least, eps, axes, kind), "vector-links")
    drop_table(blocks)
    parts = write_table(components(found.filter("v is not null").select("u", "v")), "components")
    counts = found.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    ids = parts.join(classes.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    # Written first: a component of any size is one key of the join.
    ids = write_table(ids, "component-ids")
    linked = parts.join(small_side(ids), "component").select("node", "component_id", F.lit(True).alias("linked"))
    by_class = classes.select("node", "digest", "first_id", "copies").join(counts, "node", "left").join(linked, "node", "left").select(
        "digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    by_class = write_table(by_class, "vector-components")
    out = rows.select("vec_id", "digest").join(small_side(by_class), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
