"""Shards by a k-d tree over document metadata, split at weighted medians.

Each node of the tree is split along the metadata dimension in which its rows
spread widest, at the point that divides its bytes in proportion to the shards
on either side, until a leaf holds the target bytes.

A dimension is a 62-bit key: the value's place in the dimension's range (20
bits), then a hash of the row, so that rows with one value (a hot source, a null
column) still have a median among them.  The median is found by histograms: all
nodes of a level at once, a count and a weight per bin, then again within the
bin that holds it, until the bin holds one row or one key.  A level takes a few
passes over a narrow written table (id, size, keys); texts are read once.  The
driver sees only bins: at most ``BINS`` a pass, or ``LEAST`` for each node.

Defined results.  Null text has no bytes; every row weighs one byte more than
its text, so empty texts are spread too.  Null metadata is a value of its own.
Rows that repeat are placed one by one.  An empty table gives no rows.  Only the
named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

#: Bins of all nodes' histograms in one pass, and the least a node has.
BINS, LEAST = 1 << 16, 16
PLACE_BITS, TIE_BITS = 20, 42
#: Rows of a written file that are numbered together.
BLOCK_BITS = 16


@dataclass
class Node:
    """A node with its shards ``first .. first + shards - 1``."""

    number: int
    first: int
    shards: int
    dim: int = -1
    at: int = 0  # rows with a smaller key go left
    low: int = 0
    high: int = 1 << (PLACE_BITS + TIE_BITS)
    below: int = 0  # weight of the node's rows under ``low``
    target: float = 0.0


def _keys(rows: DataFrame, dims: list[str]) -> DataFrame:
    """A key column k0, k1, ... for each dimension."""
    number = {n for n, t in rows.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")}
    bounds = rows.agg(*[f(F.col(d).cast("double")).alias(f"{n}_{d}") for d in dims if d in number
                        for n, f in (("low", F.min), ("high", F.max))]).first() if number & set(dims) else None

    def place(d: str) -> Column:
        if d not in number:
            return F.pmod(F.xxhash64(F.col(d)), F.lit(1 << PLACE_BITS))
        low, high = bounds[f"low_{d}"], bounds[f"high_{d}"]
        if low is None or not high - low > 0 or high - low == float("inf"):
            return F.lit(0).cast("long")
        share = (F.col(d).cast("double") - F.lit(low)) / F.lit(high - low)
        whole = F.least(F.greatest(F.floor(share * ((1 << PLACE_BITS) - 1)), F.lit(0)), F.lit((1 << PLACE_BITS) - 1))
        return F.coalesce(whole, F.lit(0)).cast("long")

    tie = F.pmod(F.xxhash64("rid"), F.lit(1 << TIE_BITS))
    return rows.select(*[c for c in rows.columns if c not in dims],
                       *[(place(d) * F.lit(1 << TIE_BITS) + tie).alias(f"k{i}") for i, d in enumerate(dims)])


def _level(rows: DataFrame, nodes: list[Node], n_dims: int) -> None:
    """Choose ``dim`` and ``at`` of each node; ``rows`` has node, size, k0, k1, ..."""
    spark = rows.sparkSession
    spread = [f(F.shiftright(F.col(f"k{i}"), TIE_BITS)).alias(f"{n}{i}") for i in range(n_dims) for n, f in (("a", F.min), ("z", F.max))]
    seen = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("w"), *spread).collect()}
    nodes = [n for n in nodes if n.number in seen]
    for n in nodes:
        r = seen[n.number]
        n.dim = max(range(n_dims), key=lambda i: r[f"z{i}"] - r[f"a{i}"])
        n.low, n.high = r[f"a{n.dim}"] << TIE_BITS, (r[f"z{n.dim}"] + 1) << TIE_BITS
        n.target = r["w"] * (n.shards // 2) / n.shards
    open_nodes = nodes
    while open_nodes:
        bins = max(LEAST, BINS // len(open_nodes))
        step = {n.number: max(1, -(-(n.high - n.low) // bins)) for n in open_nodes}
        look = spark.createDataFrame([(n.number, n.dim, n.low, n.high, step[n.number]) for n in open_nodes],
                                     "node long, dim int, low long, high long, step long")
        key = reduce(lambda e, i: e.when(F.col("dim") == i, F.col(f"k{i}")), range(n_dims), F.when(F.lit(False), F.lit(None)))
        inside = rows.join(F.broadcast(look), "node").withColumn("key", key).filter("key >= low and key < high")
        found = inside.groupBy("node", F.expr("(key - low) div step").alias("bin")).agg(
            F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).collect()
        by: dict[int, list] = {}
        for r in found:
            by.setdefault(r["node"], []).append((r["bin"], r["w"], r["n"]))
        again = []
        for n in open_nodes:
            width = step[n.number]
            for b, w, count in sorted(by[n.number]):
                if n.below + w >= n.target:
                    break
                n.below += w
            low = n.low + b * width
            if count == 1 or width == 1:  # one row, or rows that nothing tells apart
                nearer = abs(n.below + w - n.target) < abs(n.below - n.target)
                n.at = low + width if nearer else low
            else:
                n.low, n.high = low, min(low + width, n.high)
                again.append(n)
        open_nodes = again


def kd_shards(docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in its shard).

    ``docs``: doc_id, text and the columns ``dims``.  Either the number of
    shards is given, or the bytes that a shard should reach.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    meta = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("rid"), *[F.col(d).alias(f"dim_{d}") for d in dims])
    meta = write_table(meta, "shard-meta")
    if shards is None:
        total = meta.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows = _keys(meta, [f"dim_{d}" for d in dims]).withColumn("node", F.lit(1).cast("long"))
    nodes, leaves, depth = [Node(1, 0, shards)], {}, 0
    spark = docs.sparkSession
    while nodes:
        leaves |= {n.number: n.first for n in nodes if n.shards == 1}
        nodes = [n for n in nodes if n.shards > 1]
        if not nodes:
            break
        _level(rows, nodes, len(dims))
        split = spark.createDataFrame([(n.number, n.dim, n.at) for n in nodes], "node long, dim int, at long")
        key = reduce(lambda e, i: e.when(F.col("dim") == i, F.col(f"k{i}")), range(len(dims)), F.when(F.lit(False), F.lit(None)))
        side = F.when(F.col("dim") < 0, 0).when(key < F.col("at"), 0).otherwise(1)
        rows = rows.join(F.broadcast(split), "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + side)).drop("dim", "at")
        nodes = [Node(2 * n.number + s, n.first + s * (n.shards // 2), n.shards // 2 if s == 0 else n.shards - n.shards // 2)
                 for n in nodes for s in (0, 1)]
        depth += 1
        if depth % 4 == 0 and any(n.shards > 1 for n in nodes):
            rows = write_table(rows, "shard-level")
    leaf = spark.createDataFrame(list(leaves.items()), "node long, shard int")
    placed = rows.join(F.broadcast(leaf), "node").select(
        "doc_id", "size", "text_crc32", "rid", "shard", F.shiftright("rid", BLOCK_BITS).alias("block"))
    # Slots: rows are numbered within blocks, blocks by running counts of their rows.
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "block", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    numbered = placed.withColumn("at", F.row_number().over(Window.partitionBy("shard", "block").orderBy("rid")) - 1)
    return numbered.join(before, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at")).cast("long").alias("slot"))
