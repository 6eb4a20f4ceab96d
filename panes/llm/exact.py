"""Exact dedup against a persistent digest index, with DataFrame operations only.

The index is a table of digests, bucketed and sorted by digest.  A batch is
reduced to one row per digest (partial aggregation before the shuffle, so a
text copied a billion times moves as one row per task), sort-merge anti-joined
with the index, and what is new is appended.  The index side of the join is
read in its buckets: it is never shuffled again.

A table is taken in by several batches of ascending ``doc_id`` ranges, so that the
first batch that has a text also has its smallest id: which row stays is read from
the index.

Defined results.  Null text counts as empty text, and an empty text is a text
like any other.  Of equal texts the row with the smallest ``doc_id`` stays; a
null ``doc_id`` ranks after all others, so a row without id stays only where no
copy has one.  Rows that repeat the kept ``doc_id`` are the same document:
``duplicates`` marks each as kept, ``drop_duplicates`` leaves exactly one of
them.  A text that an earlier batch has put into the index is a duplicate
whatever its ``doc_id``.  An empty table gives an empty result.  Other columns
are neither read nor renamed.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panes.session import scratch_path

from .common import fresh_name, list_paths, small_side, write_table

#: White space that counts as one space: U+0020 and U+0009 to U+000D (fixed value).
SPACES = r"[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256))


class DigestIndex:
    """Digests seen so far, in ``<path>/digests-<buckets>``: (digest, keep_id).

    The folder is the index: a later session opens it again by its path, and a
    batch that is added twice (say, after a lost driver) adds nothing the second
    time.  ``buckets`` is fixed when the index is created; choose it so that a
    bucket of digests (32 bytes and an id a row) sorts in an executor's memory.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, id_type: str = "bigint"):
        old = [n for n in list_paths(spark, path) if n.startswith("digests-")]
        self.spark = spark
        self.buckets = int(old[0].partition("-")[2]) if old else buckets
        self.path = os.path.join(path, f"digests-{self.buckets}")
        self.name = "panes_digests_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame) -> None:
        """Append the digests of ``groups`` (digest, keep_id; a row each) that are not there yet."""
        new = groups.select("digest", "keep_id").join(self.table().hint("merge"), "digest", "left_anti")
        # One task writes one bucket: as many files a batch as buckets.
        (new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


#: Batches a table is taken in by.
BATCHES = 4


def _bounds(rows: DataFrame, batches: int) -> list:
    """The last ids of all batches but the last: ranges of ``doc_id`` that hold about as many rows each."""
    if batches < 2 or not isinstance(rows.schema["doc_id"].dataType, T.NumericType):
        return []
    found = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(found or []))


def _grouped(prints: DataFrame, bounds: list) -> DataFrame:
    """batch, digest, keep_id (the smallest id, null last), same (rows with that id) and n (rows) of each batch's
    texts, written.  Rows without id are in the last batch."""
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("doc_id") <= F.lit(bound).cast(prints.schema["doc_id"].dataType), 0).otherwise(1)
    by_id = prints.withColumn("batch", batch).groupBy("batch", "digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n"))
    groups = by_id.groupBy("batch", "digest").agg(first.alias("f"), F.sum("n").alias("n"))
    return write_table(groups.select("batch", "digest", F.col("f.doc_id").alias("keep_id"), F.col("f.n").alias("same"), "n"),
                       "digest-groups", partition_by=["batch"])


def _take_in(groups: DataFrame, bounds: list, index: DigestIndex) -> None:
    for batch in range(len(bounds) + 1):
        index.add(groups.filter(F.col("batch") == batch))


def _new_index(docs: DataFrame) -> DigestIndex:
    """An index for one table, with as many buckets as a shuffle has partitions: one task writes one bucket."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, scratch_path(spark, "digest-index"), buckets, id_type=dict(docs.dtypes)["doc_id"])


def duplicates(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Returns doc_id, digest (binary), keep_id, group_size (rows of this table with
    the text) and kept.  With ``index``, digests of earlier tables count, and this
    one is added to it; without, a new index serves this table.
    """
    index = index or _new_index(docs)
    prints = write_table(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "fingerprints")
    bounds = _bounds(prints, batches)
    groups = _grouped(prints, bounds)
    _take_in(groups, bounds, index)
    sizes = groups.groupBy("digest").agg(F.sum("n").alias("group_size"))
    # Written first: then both sides of the next join are plain shuffles, and Spark
    # splits a text that a third of all rows may have.
    stays = write_table(sizes.join(index.table().hint("merge"), "digest"), "digest-keepers")
    rows = prints.join(stays, "digest")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return rows.select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns as they were."""
    index = index or _new_index(docs)
    prints = write_table(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "fingerprints")
    bounds = _bounds(prints, batches)
    groups = _grouped(prints, bounds)
    old = write_table(groups.join(index.table().hint("merge"), "digest", "left_semi").select("digest").distinct(), "digests-known")
    _take_in(groups, bounds, index)
    sizes = groups.groupBy("digest").agg(F.sum("n").alias("group_size"))
    every = sizes.join(old.withColumn("known", F.lit(True)), "digest", "left").filter("group_size > 1 or known")
    # The row that stays is the one that the index has taken; its batch tells how many rows repeat it.
    taken = every.join(index.table().hint("merge"), "digest").select("digest", "keep_id", F.coalesce("known", F.lit(False)).alias("known"))
    own = groups.select(F.col("digest").alias("d"), F.col("keep_id").alias("k"), "same")
    known = taken.join(own, (F.col("digest") == F.col("d")) & F.col("keep_id").eqNullSafe(F.col("k")), "left").select(
        "digest", "keep_id", F.coalesce("same", F.lit(0)).alias("same"), "known")
    d, k, s, w = (fresh_name(docs, x) for x in ("digest", "keep_id", "same", "known"))
    marks = write_table(known.toDF(d, k, s, w), "digest-marks")
    rows = docs.withColumn(d, text_digest(F.col("text"))).join(small_side(marks), d, "left")
    rows = rows.filter(F.col(w).isNull() | (~F.col(w) & F.col("doc_id").eqNullSafe(F.col(k))))
    alone = F.coalesce(F.col(s), F.lit(1)) == 1
    once = rows.filter(alone).unionByName(rows.filter(~alone).dropDuplicates([d]))
    return once.select(docs.columns)
