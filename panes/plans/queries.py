"""Registered queries: one per operator of the inventory, each over the given
tables (or data Spark derives from them).  Oracles live in ``oracles.py``.

A query is ``(spark, sf_dir) -> DataFrame``.  Computed columns carry the same
names in the Spark plan and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.timestamps import format_iso, parse_iso, stamp
from ..operators import windows
from ..operators.combine import CountAndTop, combine
from ..operators.generate import flat_map, json_elements
from ..operators.panes import first_pane_global, first_pane_windows
from ..session import scratch_path
from ..sources.documents import write_documents
from ..sources.lines import read_documents, read_lines, word_array_lines
from ..sources.tables import table
from ..streaming.sinks import print_tap, publish, with_types
from .pipelines import batch_count, batch_lengths, run_batch_file, stamped_messages

Query = Callable[[SparkSession, str], DataFrame]

# Window parameters of the reference pipelines (fixed values).
FIXED_SIZE = "10 seconds"
SLIDING_SIZE = "20 seconds"
SLIDING_PERIOD = "10 seconds"

# Start instant of the stamping job (a parameter of the publisher; fixed here
# so the query is repeatable).
STAMP_BASE = "2024-01-01 00:00:00"


def fixed_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per fixed 10 s event-time window."""
    return windows.count_fixed(table(spark, sf_dir, "events"), "ts", FIXED_SIZE)


def sliding_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per sliding 20 s / 10 s event-time window."""
    return windows.count_sliding(table(spark, sf_dir, "events"), "ts",
                                 SLIDING_SIZE, SLIDING_PERIOD)


def sliding_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per sliding window of a day, one every 10 s: each event is in
    8640 windows, and is copied into none (prefix sums)."""
    return windows.count_sliding(table(spark, sf_dir, "events"), "ts", "1 day", SLIDING_PERIOD, method="prefix")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines derived from ``documents``: the word array of each whole text."""
    return word_array_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


def json_array_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each JSON line holding an array (its elements)."""
    return document_lines(spark, sf_dir).select(
        "doc_id", codec.json_length("value").alias("n_items"))


def json_object_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each JSON object payload (its distinct keys)."""
    return table(spark, sf_dir, "events").select(
        "event_id", codec.json_length("props").alias("n_keys"))


def json_object_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of a JSON object whose keys are the words of a whole text, each
    as often as the text has it (a repeated key counts once)."""
    pairs = F.transform(F.split("text", " ", -1), lambda w: F.concat(codec.json_string_text(w), F.lit(":1")))
    value = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    return table(spark, sf_dir, "documents").select("doc_id", value.alias("value")).select(
        "doc_id", codec.json_length("value").alias("n_keys"))


def json_string_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of a JSON string (code points), over whole texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", codec.json_length(codec.json_string_text("text")).alias("text_len"))


def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a JSON-lines input counted over the implicit global window."""
    return batch_count(document_lines(spark, sf_dir), explicit_window=False)


def global_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count with an explicit global window."""
    return batch_count(document_lines(spark, sf_dir), explicit_window=True)


def event_record(ev: DataFrame):
    """An ``events`` row as the JSON object a publisher sends; the event time
    travels as the ``timestamp`` text field."""
    return F.struct(F.col("event_id"), format_iso("ts").alias("timestamp"), F.col("user_id"),
                    F.col("event_type"), F.col("value"), F.parse_json("props").alias("props"))


def record_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record serialised to JSON text."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", codec.to_json_record(event_record(ev)).alias("payload"))


def utf8_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 bytes of whole multilingual texts (byte counts)."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(codec.encode_utf8("text")).cast("long").alias("n_bytes"))


def utf8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode then strictly decode gives the text back."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", codec.decode_utf8(codec.encode_utf8("text")).alias("text"))


def iso_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 then P8: datetime to ISO text, and the text parsed back."""
    ev = table(spark, sf_dir, "events").select("event_id", format_iso("ts").alias("ts_text"))
    return ev.select("event_id", "ts_text", parse_iso("ts_text").alias("ts"))


def stamp_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite each record's ``timestamp`` with start + 0..19 s."""
    return table(spark, sf_dir, "events").select(
        "event_id", stamp(STAMP_BASE, "event_id").alias("timestamp"))


def publish_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with all their columns, stamped with start +
    jitter over the ``timestamp`` they have, serialised, encoded and published
    once (to a folder under the shared checkpoint folder); read back as text."""
    ev = table(spark, sf_dir, "events")
    ev = ev.select(format_iso("ts").alias("timestamp"), "event_id", "user_id", "event_type", "value",
                   F.parse_json("props").alias("props"))
    bus = scratch_path(spark, "publish_stamped")
    publish(stamped_messages(ev, STAMP_BASE, "event_id"), "parquet", path=bus)
    return spark.read.parquet(bus).select(codec.decode_utf8("value").alias("payload"))


def typed_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the batch pipeline's per-line tap, each length next to its type."""
    lengths = batch_lengths(document_lines(spark, sf_dir)).select("doc_id", "length")
    return with_types(lengths)


def print_tap_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the per-line lengths through the print tap, which prints every element
    where it is and passes it on unchanged."""
    return print_tap(batch_lengths(document_lines(spark, sf_dir)).select("doc_id", "length"), "length: ")


def _json_lines_file(spark: SparkSession, sf_dir: str) -> str:
    """A JSON-lines text input derived from ``documents`` (one word array per
    line), written under the shared checkpoint folder."""
    path = scratch_path(spark, "json-lines")
    publish(document_lines(spark, sf_dir).select("value"), "text", path=path)
    return path


def text_file_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's per-line branch over a text file."""
    lines = read_lines(spark, _json_lines_file(spark, sf_dir))
    return batch_lengths(lines).select("length")


def text_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job (read, parse, len, count) over a
    text file, as called with its ``--input`` option."""
    return run_batch_file(spark, _json_lines_file(spark, sf_dir))


def document_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: whole JSON-array documents read back, one row per element.  The
    documents are written from ``conversations``, one array per task."""
    conv = table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "conversation-documents")
    write_documents(conv, path)
    return read_documents(spark, path, schema=conv.schema)


def document_elements_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, splittable: the same documents read line by line, so one large
    document is parsed by many tasks instead of one."""
    conv = table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "conversation-documents")
    write_documents(conv, path)
    return read_documents(spark, path, schema=conv.schema, layout="lines")


def document_elements_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, any layout: pretty-printed documents, whose strings hold brackets, commas,
    quotes and backslashes, each cut into at least eight ranges."""
    conv = table(spark, sf_dir, "conversations").withColumn("text", F.concat(F.lit('[{"'), "text", F.lit('\\\\"}],\\')))
    path = scratch_path(spark, "pretty-documents")
    write_documents(conv, path, pretty=True)
    # Ranges of an eighth of the shortest document.
    shortest = spark.read.format("binaryFile").load(path).select("length").agg(F.min("length")).first()[0] or 8
    return read_documents(spark, path, schema=conv.schema, layout="ranges", range_bytes=max(1, shortest // 8))


def user_combiner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's accumulator over ``events``, for each type and, as one key that
    all rows have, for the whole table."""
    ev = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    kind = "struct<n: long, over: long, top: array<long>>"
    each = combine(ev, CountAndTop(100.0, 3), kind, ["event_type"])
    whole = combine(ev.select("event_id", "value"), CountAndTop(100.0, 3), kind)
    return each.unionByName(whole.withColumn("event_type", F.lit("all"))).select(
        "event_type", "result.n", "result.over", F.array_join("result.top", ",").alias("top"))


def generated_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elements of each JSON array line as rows, by a table function."""
    return flat_map(document_lines(spark, sf_dir), json_elements, "value").select("doc_id", "pos", "element")


def quote_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote normaliser over whole conversation texts."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", codec.normalize_quotes("text").alias("text_norm"))


# Processing-time delays of the reference (fixed values).
GLOBAL_PANE_DELAY = "10 seconds"
WINDOW_PANE_DELAY = "30 seconds"


def global_pane_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 batch twin: the global window's first pane, 10 s after the first arrival."""
    return first_pane_global(table(spark, sf_dir, "events"), "ts", GLOBAL_PANE_DELAY)


def window_pane_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 batch twin: each 10 s arrival window's first pane, fired 30 s after
    its first arrival."""
    return first_pane_windows(table(spark, sf_dir, "events"), "ts", FIXED_SIZE, WINDOW_PANE_DELAY)


def window_pane_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 batch twin with a delay below the window: 1 h windows, fired 30 min after
    their first arrival, hold the rows that arrived by then."""
    return first_pane_windows(table(spark, sf_dir, "events"), "ts", "1 hour", "30 minutes")


QUERIES: dict[str, Query] = {
    "fixed_window_count": fixed_window_count,
    "sliding_window_count": sliding_window_count,
    "sliding_day_count": sliding_day_count,
    "json_array_length": json_array_length,
    "json_object_length": json_object_length,
    "json_object_repeated_keys": json_object_repeated_keys,
    "json_string_length": json_string_length,
    "global_count": global_count,
    "global_window_count": global_window_count,
    "record_to_json": record_to_json,
    "utf8_encode": utf8_encode,
    "utf8_round_trip": utf8_round_trip,
    "iso_parse": iso_parse,
    "stamp_jitter": stamp_jitter,
    "quote_normalize": quote_normalize,
    "publish_stamped": publish_stamped,
    "typed_tap": typed_tap,
    "text_file_lengths": text_file_lengths,
    "text_file_count": text_file_count,
    "document_elements": document_elements,
    "document_elements_lines": document_elements_lines,
    "document_elements_ranges": document_elements_ranges,
    "user_combiner": user_combiner,
    "generated_elements": generated_elements,
    "global_pane_once": global_pane_once,
    "window_pane_once": window_pane_once,
    "window_pane_part": window_pane_part,
    "print_tap_lengths": print_tap_lengths,
}
