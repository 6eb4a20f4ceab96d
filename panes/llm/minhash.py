"""Near-duplicate documents by HyperMinHash sketches.

A document's distinct shingles are hashed once.  The first bits of a hash choose
a bucket; a bucket keeps its smallest hash, compressed into a register of 16
bits: the count of leading zeros and the first mantissa bits (Yu and Weber,
"HyperMinHash", 2017).  Empty buckets of short documents borrow from buckets
drawn by a fixed random sequence (Shrivastava, "Optimal Densification", 2017),
so that registers agree with the probability of the Jaccard similarity whatever
the size.  Runs of registers are banded; documents that share a band are
candidates; the share of equal registers, corrected for the chance that
different minima compress alike, drops the clearly dissimilar; the rest is
confirmed on full sets.

Copies and hubs.  Documents with equal sets are one class from the start, kept
as a row with its smallest id.  Within a band's bucket no pairs are listed:
every class is compared with the bucket's hub, its least member.  A bucket whose
other members are all linked with one hub needs no more comparisons.  Of the
rest, the members (without the hub, which has met them all) that hang together
by such buckets are compared in blocks, a block with a block, skipping blocks
whose set sizes rule a link out: this is exact, works on any number of members,
and emits no more links than join components.

Probability of missing a link at a similarity of exactly 0.8, bands and estimate
together: below 3e-6 for any size.  With all buckets full, no band of 32 of 4
registers is shared with ``(1 - 0.8**4) ** 32``, 5e-8, and the estimate's cut of 5
standard errors takes 6e-7.  Short sets have few full buckets, and the others
repeat them: computed over how many are full and how many of these differ, the
bands miss 1.5e-6 for 5 against 4 shingles and less than 1e-6 for unions of 10 to
200.  The standard error counts only registers that are independent, so the cut
takes less than 1e-10 there; the least sets (up to 6 shingles) are never cut.

Defined results.  Words are runs of anything but space and U+0009 to U+000D,
A-Z lower-cased.  A text with fewer words than a shingle is one shingle; null
text and text without words have the empty set, which is linked with nothing:
the row is its own component.  A component's id is its smallest ``doc_id``; null
ids rank after all others, and a component without any id has a null id, its
rows kept.  Rows that repeat are copies.  An empty table gives no rows.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, fresh_name, ship_package, small_side, write_table
from .components import components
from .words import coded, slices, split_words

BANDS, ROWS = 32, 4
BUCKET_BITS = 7  # BANDS * ROWS buckets
MANTISSA = 10
#: Candidates whose estimate is so many standard errors below the threshold are not confirmed.
SIGMAS = 5
#: Members and shingles of a block of the second round.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 400_000


# --- sets and sketches ------------------------------------------------------


def _mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (public constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts as 64-bit hashes, ascending in each text,
    and the bounds of each text's own: text ``i`` has ``hashes[bounds[i]:bounds[i + 1]]``."""
    import xxhash

    n = len(texts)
    owner, words = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    codes, distinct = coded(words)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in distinct), np.uint64, len(distinct))[codes]
    counts = np.bincount(owner, minlength=n)
    begins = np.cumsum(counts) - counts
    factor = np.uint64(0x9E3779B97F4A7C15)

    def rolled(at: np.ndarray, length: int) -> np.ndarray:
        h = np.full(len(at), length, np.uint64)
        for j in range(length):
            h = _mix(h * factor + hashed[at + j])
        return h

    at = np.arange(max(0, len(hashed) - width + 1))
    at = at[owner[at] == owner[at + width - 1]] if len(at) else at
    docs, shingles = [owner[at]], [rolled(at, width)]
    for length in range(1, width):  # fewer words than a shingle: the whole sequence
        short = np.flatnonzero(counts == length)
        docs.append(short)
        shingles.append(rolled(begins[short], length))
    doc, shingle = np.concatenate(docs), np.concatenate(shingles)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    doc, shingle = doc[new], shingle[new]
    return shingle, np.searchsorted(doc, np.arange(n + 1))


def _draws(buckets: int, tries: int = 512) -> np.ndarray:
    """For each try and empty bucket, the bucket to borrow from."""
    grid = np.arange(tries, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(buckets, dtype=np.uint64)[None] + np.uint64(1)
    return (_mix(grid) % np.uint64(buckets)).astype(np.int64)


def sketches(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of registers for each set; all 0 for an empty one."""
    n, k = len(bounds) - 1, 1 << BUCKET_BITS
    doc = np.repeat(np.arange(n), np.diff(bounds))
    cell = doc * k + (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # ascending in each set: the first is a bucket's smallest
    rest = (shingles[first] << np.uint64(BUCKET_BITS)) & ~np.uint64(0x7FF)  # 53 bits: exact as a double
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.where(rest > 0, 64 - exponent, 63)
    mantissa = np.where(rest > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    registers, full = np.zeros(n * k, np.uint16), np.zeros(n * k, bool)
    registers[cell[first]] = (zeros << MANTISSA | mantissa).astype(np.uint16)
    full[cell[first]] = True
    registers, full = registers.reshape(n, k), full.reshape(n, k)
    row, bucket = np.nonzero(~full & full.any(axis=1)[:, None])
    dense = registers.copy()
    for draw in _draws(k):
        if not len(row):
            break
        source = draw[bucket]
        hit = full[row, source]
        dense[row[hit], bucket[hit]] = registers[row[hit], source[hit]]
        row, bucket = row[~hit], bucket[~hit]
    for r, b in zip(row, bucket, strict=True):  # hardly ever: the next full bucket
        dense[r, b] = registers[r, (b + np.argmax(np.roll(full[r], -b))) % k]
    return dense


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of disjoint sets of ``n`` and ``m`` shingles are equal."""
    edges = 2.0 ** -np.arange(0, 58)
    share = lambda size: np.diff(-((1 - edges[None]) ** np.maximum(size / (1 << BUCKET_BITS), 1)[:, None]), axis=1)
    return np.abs((share(n) * share(m)).sum(axis=1)) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two arrays of registers, corrected for chance."""
    chance = chance_equal(n, m)
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def independent(size: np.ndarray) -> np.ndarray:
    """How many independent registers the sketch of a set of ``size`` shingles is worth:
    the expected full buckets, less for the empty ones that repeat some of them more than others."""
    k = 1 << BUCKET_BITS
    full = k * (1 - (1 - 1 / k) ** np.asarray(size, np.float64))
    copies = (k - full) / full
    return k**2 / (full * ((1 + copies) ** 2 + copies * (1 - 1 / full)))


def least_estimate(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The estimate below which sets of ``n`` and ``m`` shingles are not confirmed."""
    s = percent / 100
    return s - SIGMAS * (s * (1 - s) / independent(np.minimum(n, m))) ** 0.5


# --- the operator -----------------------------------------------------------


def _sketch_rows(docs: DataFrame, width: int) -> DataFrame:
    """The columns of ``docs`` with n_shingles, digest and registers in the place of ``text``."""
    own = [f.name for f in docs.schema if f.name != "text"]
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in own], T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("registers", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                shingles, bounds = shingle_sets(part.column("text"), width)
                digests = [xxhash.xxh3_128_digest(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                registers = sketches(shingles, bounds)
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in own], pa.array(np.diff(bounds), pa.int64()), pa.array(digests, pa.binary()),
                    pa.array([r.tobytes() for r in registers], pa.binary())], schema.fieldNames())

    return docs.select(*own, "text").mapInArrow(run, schema)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sketches and sizes do not rule a link out, with their digests and first ids."""
    side = lambda c: classes.select(F.col("node").alias(c), *[F.col(x).alias(f"{y}_{c}") for x, y in (
        ("n_shingles", "n"), ("registers", "r"), ("digest", "digest"), ("first_id", "first"))])
    both = pairs.join(side("v"), "v").join(side("u"), "u").filter(
        100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    kept = ["u", "v", "digest_u", "first_u", "digest_v", "first_v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), np.uint16).reshape(b.num_rows, -1) for x in ("r_u", "r_v"))
                n, m = (b.column(x).to_numpy() for x in ("n_u", "n_v"))
                yield b.select(kept).filter(pa.array(estimate(a, c, n, m) >= least_estimate(n, m, percent)))

    return both.select(*kept, "n_u", "n_v", "r_u", "r_v").mapInArrow(run, T.StructType([both.schema[c] for c in kept]))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, shingles (ascending 64-bit hashes) of the classes ``wanted`` (node, digest, first_id)."""
    need = small_side(wanted.select("node", F.col("digest").alias("want"), F.col("first_id")))
    rows = docs.select("doc_id", "text").join(need, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "want", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                shingles, bounds = shingle_sets(part.column(2), width)
                nodes, out = [], []
                # An id may repeat with other texts: the digest tells which one is meant.
                for node, want, a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    if xxhash.xxh3_128_digest(shingles[a:b]) == want:
                        nodes.append(node)
                        out.append(shingles[a:b].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.binary())], ["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s_{c}"))
    both = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "s_u", "s_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for s, t in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def shared_counts(a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray, columns: int = 4096) -> np.ndarray:
    """How many shingles each set of one block shares with each of another."""
    common = np.intersect1d(np.unique(a), np.unique(b), assume_unique=True)
    out = np.zeros((len(a_bounds) - 1, len(b_bounds) - 1), np.float32)

    def places(flat: np.ndarray, bounds: np.ndarray):
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        hit = common[at] == flat
        return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[hit], at[hit]

    if len(common):
        (ra, ca), (rb, cb) = places(a, a_bounds), places(b, b_bounds)
        for low in range(0, len(common), columns):
            dense = []
            for r, c, n in ((ra, ca, len(a_bounds) - 1), (rb, cb, len(b_bounds) - 1)):
                inside = (c >= low) & (c < low + columns)
                m = np.zeros((n, columns), np.float32)
                m[r[inside], c[inside] - low] = 1
                dense.append(m)
            out += dense[0] @ dense[1].T
    return np.rint(out).astype(np.int64)


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs, as few as keep the same nodes connected."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for u, v in pairs.tolist():
        a, b = root(u), root(v)
        if a != b:
            parent[b] = a
            kept.append((u, v))
    return kept


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Members of one cluster and of near set sizes, dealt by hash into rows of about ``BLOCK_ROWS``.

    ``members``: cluster, label, n_shingles, node, shingles.  Sets whose sizes are
    not in neighbouring classes cannot be linked.
    """
    step = math.log(100 / percent) if percent < 100 else 1e-9
    grown = members.withColumn("size", F.floor(F.log("n_shingles") / step))
    held = grown.groupBy("cluster", "size").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    # As many blocks as keep either their rows or their shingles in bounds.
    held = held.select("cluster", "size", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("total") / BLOCK_SHINGLES)).alias("blocks"))
    held = small_side(write_table(held, "block-numbers"))
    dealt = grown.join(held, ["cluster", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # By block: else the join's partitions would do, and all blocks of a cluster lie in one task.
    dealt = dealt.repartition("cluster", "size", "block")
    return dealt.groupBy("cluster", "size", "block").agg(
        F.min("label").alias("l_min"), F.max("label").alias("l_max"), F.collect_list(F.struct("label", "shingles")).alias("rows")).select(
        "cluster", "size", "l_min", "l_max", F.col("rows.label").alias("labels"), F.col("rows.shingles").alias("sets")).withColumn(
        "block", F.monotonically_increasing_id())


def _block_links(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between labels, found by comparing blocks of a cluster."""
    meta = blocks.select("cluster", "block", "size", "l_min", "l_max")
    a, b = meta.toDF("cluster", "a", "a_size", "al", "ah"), meta.toDF("cluster", "b", "b_size", "bl", "bh")
    pairs = a.join(b, "cluster").filter("a <= b and abs(a_size - b_size) <= 1").filter(
        ~((F.col("al") == F.col("ah")) & (F.col("bl") == F.col("bh")) & (F.col("al") == F.col("bl")))).select("a", "b")
    side = lambda c: blocks.select(F.col("block").alias(c), F.col("labels").alias(f"labels_{c}"), F.col("sets").alias(f"sets_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").drop("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a pair of blocks at a time
                row = batch.slice(i, 1).to_pylist()[0]
                labels, sets, bounds = {}, {}, {}
                for c in "ab":
                    labels[c] = np.array(row[f"labels_{c}"], np.int64)
                    sets[c] = np.frombuffer(b"".join(row[f"sets_{c}"]), np.uint64)
                    bounds[c] = np.concatenate(([0], np.cumsum([len(s) // 8 for s in row[f"sets_{c}"]])))
                shared = shared_counts(sets["a"], bounds["a"], sets["b"], bounds["b"])
                union = np.diff(bounds["a"])[:, None] + np.diff(bounds["b"])[None] - shared
                x, y = np.nonzero((100 * shared >= percent * union) & (labels["a"][:, None] != labels["b"][None]))
                found = forest(np.unique(np.stack([labels["a"][x], labels["b"][y]], axis=1), axis=0))
                u, v = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketched rows, their classes (digest, first_id, node) and the
    components (node, component) of the classes that are linked with others."""
    ship_package(docs.sparkSession)
    rows = write_table(_sketch_rows(docs, width), "sketches")
    classes = write_table(rows.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    ).withColumn("node", F.monotonically_increasing_id()), "classes")

    # Members of the bands' buckets that more than one class is in; the least is the hub.
    width_bytes = 2 * ROWS
    keys = [F.xxhash64(F.lit(b), F.substring("registers", 1 + b * width_bytes, width_bytes)) for b in range(BANDS)]
    banded = classes.select("node", F.explode(F.array(*keys)).alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")).filter("size > 1")
    # Written first, here and below: a bucket that many classes are in is one key of a
    # join that Spark can only split if no aggregate or other join is in its stage.
    sizes = write_table(sizes, "band-sizes")
    members = write_table(banded.join(small_side(sizes), "key").filter("node != hub"), "band-members")
    pairs = members.select(F.col("hub").alias("u"), F.col("node").alias("v")).repartition("v").distinct()
    likely = write_table(_likely(pairs, classes, percent), "likely-pairs")
    sides = [likely.select(F.col(c).alias("node"), F.col(f"digest_{c}").alias("digest"), F.col(f"first_{c}").alias("first_id")) for c in "uv"]
    sets = write_table(_sets(docs, write_table(sides[0].unionByName(sides[1]).distinct(), "used"), width), "shingle-sets")
    links = write_table(_confirmed(likely.select("u", "v"), sets, percent), "links")
    drop_table(sets)
    drop_table(likely)

    # Classes linked with the same hub are in one component: the least such hub is
    # their label.  Buckets whose members have several labels need comparing.
    labels = links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("label"))
    labelled = members.filter("size > 2").select("key", "node").join(small_side(write_table(labels, "hub-labels")), "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    labelled = write_table(labelled, "labelled-members")
    several = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least != most")
    several = write_table(several.select("key", "least"), "mixed-bands")
    loose = write_table(labelled.join(small_side(several), "key").select("node", "label", "least").distinct(), "loose-members")
    if not loose.isEmpty():
        # Labels that hang together by such buckets are one cluster.
        clusters = components(loose.select(F.col("least").alias("u"), F.col("label").alias("v")))
        left = loose.select("node", "label").distinct().join(
            clusters.select(F.col("node").alias("label"), F.col("component").alias("cluster")), "label")
        left = write_table(left.join(classes.select("node", "digest", "first_id", "n_shingles"), "node"), "loose-classes")
        left_sets = _sets(docs, left.select("node", "digest", "first_id"), width)
        loose_sets = write_table(left.select("node", "cluster", "label", "n_shingles").join(left_sets, "node"), "loose-sets")
        blocks = write_table(_blocks(loose_sets, percent), "blocks")
        links = links.unionByName(write_table(_block_links(blocks, percent), "block-links"))
        drop_table(loose_sets)
        drop_table(blocks)
    return rows, classes, write_table(components(links), "components")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked if their sets of ``width``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100.
    """
    rows, classes, final = _linked(docs.select("doc_id", "text"), width, percent)
    # Classes to documents.
    first = final.join(classes.select("node", "first_id"), "node")
    ids = write_table(first.groupBy("component").agg(F.min("first_id").alias("component_id")), "first-ids")
    joined = write_table(final.join(small_side(ids), "component").select("node", "component_id"), "component-ids")
    linked = joined.withColumn("linked", F.lit(True))
    by_class = classes.select("node", "digest", "first_id").join(small_side(linked), "node", "left").select(
        "digest", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"),
        F.lit(True).alias("has_words"))
    out = rows.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
    component = F.when(F.col("has_words"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with exactly one row of each component left; all columns as they were.

    It is the row with the smallest ``doc_id`` (null last), then the smallest set
    digest and text hash; of rows that repeat both id and text, any one.  Rows
    are told apart by id and text, so an id that is null or repeats with another
    text takes no other row with it.
    """
    text_hash = F.unhex(F.md5("text"))
    rows, classes, final = _linked(docs.select("doc_id", "text", text_hash.alias("print")), width, percent)
    own = classes.select("node", "digest").join(small_side(final), "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    members = write_table(rows.filter("n_shingles > 0").select("doc_id", "print", "digest").join(own, "digest"), "near-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "print"))
    groups = write_table(members.groupBy("component").agg(first.alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "component", F.col("f.doc_id").alias("keep_id"), F.col("f.print").alias("keep_print")), "near-groups")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("print") == F.col("keep_print"))
    marks = members.join(small_side(groups), "component").groupBy("doc_id", "print", stays.alias("stays")).agg(
        F.count(F.lit(1)).alias("same")).filter("not stays or same > 1").select("doc_id", "print", "stays")
    i, p, w = (fresh_name(docs, x) for x in ("id", "print", "stays"))
    marks = write_table(marks.toDF(i, p, w), "near-duplicates")
    t = fresh_name(docs, "text_hash")
    left = docs.withColumn(t, text_hash).join(small_side(marks), F.col("doc_id").eqNullSafe(F.col(i)) & F.col(t).eqNullSafe(F.col(p)), "left")
    out = left.filter(F.col(w).isNull())
    if not marks.filter(F.col(w)).isEmpty():  # rows that repeat the one that stays
        out = out.unionByName(left.filter(F.col(w)).dropDuplicates(["doc_id", t]))
    return out.select(docs.columns)
