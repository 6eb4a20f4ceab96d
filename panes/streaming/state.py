"""What a pane query holds, read from its checkpoint (A1, T4, T5).

The state data source reads a checkpoint as a table, of now or of an earlier batch;
the query need not run, and is not disturbed if it does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import micros_to_ntz


def _variable(spark: SparkSession, checkpoint: str, name: str, batch_id: int | None) -> DataFrame:
    reader = spark.read.format("statestore").option("stateVarName", name)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def open_panes(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """pane_start and n (rows so far) of each pane that has not fired after a batch (default: the last)."""
    table = _variable(spark, checkpoint, "pane", batch_id)
    return table.select(micros_to_ntz("key.pane_key").alias("pane_start"), F.col("value.n").alias("n"))


def fired_panes(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """pane_start of each pane that has fired and drops what still arrives for it."""
    table = _variable(spark, checkpoint, "closed", batch_id).where("value.closed")
    return table.select(micros_to_ntz("key.pane_key").alias("pane_start"))
