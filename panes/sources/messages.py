"""Message sources (S2, S4): any Spark source normalised to the message shape
``data BINARY, publish_time TIMESTAMP``.

In production the format is a message bus (``kafka`` maps ``value`` and
``timestamp``); in tests a folder of parquet/text files plays the bus.  The
reader's checkpointed offsets take the place of per-message acknowledgement.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.codec import encode_utf8, to_json_record
from ..functions.timestamps import to_instant

MESSAGE_COLUMNS = ("data", "publish_time")

# Column names of the bus sources Spark ships (fixed values).
_BUS_PAYLOAD = {"kafka": ("value", "timestamp")}


def normalize_messages(df: DataFrame, data: str | Column = "value",
                       publish_time: str | Column = "timestamp") -> DataFrame:
    """Project any frame to ``data BINARY, publish_time TIMESTAMP``."""
    d = F.col(data) if isinstance(data, str) else data
    t = F.col(publish_time) if isinstance(publish_time, str) else publish_time
    return df.select(d.cast("binary").alias("data"), t.alias("publish_time"))


def read_messages(spark: SparkSession, format: str, path: str | None = None,
                  schema: StructType | None = None, data: str = "value",
                  publish_time: str = "timestamp", stream: bool = True,
                  **options) -> DataFrame:
    """Read a subscription / topic / folder as messages.

    ``data`` and ``publish_time`` name the payload and time columns of the
    underlying source (defaults fit ``kafka``).
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if format in _BUS_PAYLOAD:
        data, publish_time = _BUS_PAYLOAD[format]
    return normalize_messages(df, data, publish_time)


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """One parquet table of an sf folder as a file stream (a replayed bus).

    The table may be one file or a folder of part files.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).options(**options)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        return reader.parquet(path)
    # A stream reads folders: the one the file is in, and of it this file alone.
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def messages_from_records(df: DataFrame, record: Column, publish_time: str | Column) -> DataFrame:
    """Publish records: JSON text of ``record`` as UTF-8 bytes, with the time
    column (TIMESTAMP or TIMESTAMP_NTZ read as UTC) as publish time."""
    t = F.col(publish_time) if isinstance(publish_time, str) else publish_time
    t_type = df.select(t).schema.fields[0].dataType
    return df.select(encode_utf8(to_json_record(record)).alias("data"),
                     to_instant(t, t_type).alias("publish_time"))


def tap_messages(messages: DataFrame, with_data: bool = False) -> DataFrame:
    """What a subscriber callback prints (S4): the publish time, and the payload."""
    cols = ["publish_time"] + (["data"] if with_data else [])
    return messages.select(*cols)
