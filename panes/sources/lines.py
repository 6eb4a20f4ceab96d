"""Line and document sources.

Batch and streaming forms share one output shape: a ``value STRING`` column,
one row per line (S1) or per array element (S3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import json_array_text
from .ranges import array_elements


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               **options) -> DataFrame:
    """Text files, one row per line (``ReadFromText``): ``value STRING``.

    Splittable: Spark cuts large files into ``maxPartitionBytes`` splits.
    ``stream=True`` watches a folder and reads new files per micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


# Array punctuation around one element of a one-element-per-line document.
_ELEMENT_LEAD = r"^[\s\[,]+"
_ELEMENT_TRAIL = r"[\s\],]+$"


def read_documents(spark: SparkSession, path: str, schema=None, stream: bool = False,
                   layout: str = "whole", mode: str = "strict", range_bytes: int | None = None, **options) -> DataFrame:
    """JSON documents holding one array of objects (S3): one row per element.

    With ``schema`` the rows have its columns; without, one column ``element``
    (VARIANT) that holds each object with its own fields.

    ``layout="whole"`` reads any formatting: each file is parsed whole by one
    task (a JSON array does not split), so parallelism comes from the number
    of files.  ``layout="lines"`` is for documents with one element per line
    (``[{...}`` / ``,{...}`` / ``]``, as ``sources.documents.write_documents``
    writes them): the text reader splits even one huge file into
    ``maxPartitionBytes`` tasks, and each line is parsed on its own.
    ``layout="ranges"`` reads any formatting and still cuts one huge file into
    ranges of ``range_bytes`` (default: the split size), at the price of reading
    it twice (``sources.ranges``); batch only.
    Strict mode fails on a malformed document or element.
    """
    opts = {"mode": "FAILFAST" if mode == "strict" else "PERMISSIVE"}
    if layout == "whole":
        reader = spark.readStream if stream else spark.read
        reader = reader.option("multiLine", True).options(**{**opts, **options})
        if schema is not None:
            return reader.schema(schema).json(path)
        whole = reader.option("singleVariantColumn", "document").json(path)
        return whole.lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).select(F.col("value").alias("element"))
    if layout == "ranges":
        if stream:
            raise ValueError("layout 'ranges' reads its input twice: not for a stream")
        return _parsed(array_elements(spark, path, range_bytes, mode, **options), schema, mode, opts)
    if layout != "lines":
        raise ValueError("layout must be 'whole', 'lines' or 'ranges'")
    element = F.regexp_replace(F.regexp_replace("value", _ELEMENT_LEAD, ""), _ELEMENT_TRAIL, "")
    elements = read_lines(spark, path, stream, **options).select(element.alias("element")) \
        .where(F.length("element") > 0)
    return _parsed(elements, schema, mode, opts)


def _parsed(elements: DataFrame, schema, mode: str, opts: dict) -> DataFrame:
    if schema is None:
        parsed = F.parse_json("element") if mode == "strict" else F.try_parse_json("element")
        return elements.select(parsed.alias("element"))
    return elements.select(F.from_json("element", schema, opts).alias("_e")).select("_e.*")


def constant_messages(spark: SparkSession, payload: str, copies: int,
                      partitions: int | None = None) -> DataFrame:
    """``copies`` messages with the same UTF-8 payload (S5): ``value BINARY``.

    Generated by ``range`` on the executors, nothing built on the driver.
    """
    return (spark.range(0, copies, 1, partitions)
                 .select(F.encode(F.lit(payload), "UTF-8").alias("value")))


def word_array_lines(df: DataFrame, key: str, text: str | Column,
                     sep: str = " ") -> DataFrame:
    """JSON-lines stand-in built from a table: per row, the JSON array of the
    whole text split on ``sep`` -> ``key, value``.
    """
    t = F.col(text) if isinstance(text, str) else text
    return df.select(key, json_array_text(F.split(t, sep, -1)).alias("value"))
