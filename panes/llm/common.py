"""Helpers shared by the operators: written tables, sized broadcasts, shipping.

Every intermediate result that is read more than once is written as Parquet in
the shared folder (``spark.checkpoint.dir``) and read back: it cuts lineage, is
column-pruned on reading, and survives the loss of executors.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panes.session import scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` in the shared folder and return it read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _WRITTEN.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def drop_table(df: DataFrame) -> None:
    """Remove a table made by ``write_table`` that nothing reads any more."""
    path = getattr(df, "_scratch", None)
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def list_paths(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


@atexit.register
def _clear() -> None:
    """Scratch tables last as long as the driver's process."""
    for spark, path in _WRITTEN:
        try:
            if spark.sparkContext._jsc is not None:
                delete_path(spark, path)
        except Exception:  # the JVM may be gone already
            return


#: Rows of fixed width (ids, digests, counts) a broadcast may hold: below 100 MB.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``max_rows``.

    ``df`` must be cheap to read twice (a written table) and have rows of a
    bounded width.  Beyond the bound the join shuffles both sides.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hash_sample(df: DataFrame, keys: list[str], most: int, rows: int) -> DataFrame:
    """Nearly ``most`` of ``rows`` rows, chosen by a hash of ``keys``; put a limit of ``most`` behind it.

    Not an ordering: that would send ``most`` rows of every task to the driver.
    It aims six standard deviations below ``most``, so that with different keys the
    limit cuts nothing (one case in a billion) and the sample does not depend on
    how the rows are dealt over files.
    """
    aim = max(1.0, most - 6 * most**0.5)
    if rows > aim:
        df = df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int(aim / rows * (1 << 40)))
    return df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_panes_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="panes-ship-"), "panes_package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join("panes", os.path.relpath(full, root)))
    sc.addPyFile(out)
    sc._panes_shipped = True


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = "_" + name
    return name
