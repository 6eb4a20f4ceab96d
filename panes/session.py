"""Session settings and the shared folder used for checkpoints and outputs.

The library never assumes a machine-local folder on a cluster: everything that
must outlive a task (streaming checkpoints, materialised outputs, lineage cuts)
goes under ``spark.checkpoint.dir``.  Only a local master (unit tests, a laptop)
may leave that setting out: then a folder is made under the system temp folder.
Scratch output is removed by ``clear_scratch``, and at the latest when the
driver's process ends.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pipeline relies on.  Applied by ``build_session``.  Library
# functions leave a session they are handed as it is; those that need the RocksDB
# state store (``transformWithState``) refuse a session without it.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpointed lineage cuts from the shared folder once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "panes",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made if a local master names none.

    Other masters must name it: a driver's temp folder does not reach executors.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        # local, local[8], ...; but local-cluster has executors of its own.
        if sc.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="panes-chk-")
        _SCRATCH.append((spark, d))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SCRATCH: list[tuple[SparkSession, str]] = []
_REGISTERED: list[bool] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder, removed at the end."""
    root = ensure_checkpoint_dir(spark)
    if not _REGISTERED:
        # After the JVM has started, so that this runs before it is told to end.
        atexit.register(clear_scratch)
        _REGISTERED.append(True)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append((spark, path))
    return path


def clear_scratch(under: str | None = None) -> None:
    """Remove the scratch folders of this process (those named ``under...``): call it
    when no DataFrame that reads them is needed any more."""
    keep = []
    for spark, path in reversed(_SCRATCH):
        if under is not None and not os.path.basename(path).startswith(under):
            keep.append((spark, path))
            continue
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended: its folders stay for whoever owns the store
            continue
    _SCRATCH[:] = reversed(keep)
