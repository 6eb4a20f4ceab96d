"""The reference's pipelines, re-expressed as DataFrame functions.

Batch pipelines return DataFrames; streaming pipelines return started
``StreamingQuery`` objects (see ``panes.streaming``).  Options of the
reference's command line become keyword arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import encode_utf8, json_length, to_json_record
from ..functions.timestamps import format_iso, stamp
from ..operators.windows import COUNT, global_window
from ..sources.lines import read_lines
from ..streaming.sinks import print_tap, with_types


def batch_lengths(lines: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    """Lines -> JSON parse -> length per line (the per-line branch)."""
    return lines.withColumn("length", json_length(value_col, mode))


def batch_count(lines: DataFrame, mode: str = "strict", explicit_window: bool = False,
                value_col: str = "value") -> DataFrame:
    """Lines -> parse -> length -> count over the global window, without defaults.

    The count is over the *length values* (``count(length)`` skips NULLs), so
    each line must parse: strict mode fails on a bad line, permissive mode
    leaves it out.  Counting the column, rather than filtering on it, keeps
    the per-line JSON work in one projection (shared subexpressions, after any
    repartition) instead of a predicate Catalyst would push into the scan.
    """
    lengths = batch_lengths(lines, mode, value_col)
    if explicit_window:
        lengths = global_window(lengths)
    return (lengths.agg(F.count("length").alias(COUNT))
                   .where(F.col(COUNT) > 0))


def run_batch_file(spark: SparkSession, input: str, output: str | None = None,
                   mode: str = "strict", explicit_window: bool = False, tap: bool = False) -> DataFrame:
    """The batch length-and-count job over text files, with its options.

    Returns the count; writes it as JSON lines under ``output`` when given.
    ``tap``: every line's length, and its type, is printed on its way.
    """
    spark.sparkContext.setJobDescription("lines, JSON length, global count")
    lines = read_lines(spark, input)
    if tap:
        lengths = print_tap(with_types(batch_lengths(lines, mode).select("length")), "length: ")
        if explicit_window:
            lengths = global_window(lengths)
        n = lengths.agg(F.count("length").alias(COUNT)).where(F.col(COUNT) > 0)
    else:
        n = batch_count(lines, mode, explicit_window)
    if output:
        n.write.mode("overwrite").json(output)
    return n


def stamped_messages(records: DataFrame, base: str, key, spread: int = 20,
                     field: str = "timestamp") -> DataFrame:
    """The sample publisher's job, minus its pacing (P10 P11 P12 P4 P6): set or
    overwrite each record's ``timestamp`` with ``base`` + 0..spread-1 s (a
    repeatable draw from ``key``), serialise the record, encode it.

    Output ``value BINARY``, ready for ``streaming.sinks.publish`` (K2).
    """
    t = format_iso(stamp(base, key, spread))
    rec = F.struct(*[F.col(c) for c in records.columns if c != field], t.alias(field))
    return records.select(encode_utf8(to_json_record(rec)).alias("value"))


def stamped_elements(elements: DataFrame, base: str, key=None, spread: int = 20,
                     field: str = "timestamp", tap: str | None = None) -> DataFrame:
    """The same for objects of a JSON document (column ``element``, VARIANT): each
    keeps its own fields, and gets or overwrites ``timestamp``.

    ``key`` names the field the jitter is drawn from; without it, it is random.
    ``tap``: each stamped item is printed, after this label, before it is encoded (K3).
    """
    drawn = F.try_variant_get("element", f"$.{key}", "long") if key else F.floor(F.rand() * spread)
    t = format_iso(stamp(base, drawn, spread))
    own = F.from_json(F.to_json("element"), "map<string,variant>")
    rec = F.map_concat(F.map_filter(own, lambda k, v: k != field), F.create_map(F.lit(field), t.cast("variant")))
    items = elements.select(F.to_json(rec).alias("item"))
    items = items if tap is None else print_tap(items, tap)
    return items.select(encode_utf8("item").alias("value"))
