"""Event time and lateness (E1, E2, L1) for message streams.

Spark's watermark is ``max(event time seen) - delay``; rows older than the
previous micro-batch's watermark are dropped as late, and a window is final
once the watermark passes its end.  The reference never sets an allowed
lateness, so the default delay is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from ..functions.codec import decode_utf8, json_valid
from ..functions.timestamps import duration_str, parse_iso, to_instant

EVENT_TIME = "event_time"

#: Stands after the payload in the frame that tells whether it is one object.
_END = "__end_of_payload__"


def payload_time(data: str | Column = "data", field: str = "timestamp", mode: str = "strict") -> Column:
    """The instant a message's JSON text field names.

    The payload is parsed once, with a schema of that one field, as the first
    element of an array whose second is an end mark: text after the object, or
    a second object, leaves the array malformed or without the mark.  Strict
    mode raises on bad UTF-8, malformed JSON, or a field that is missing, not a
    text or not a time; permissive mode gives NULL.
    """
    text = decode_utf8(data, mode)
    schema = ArrayType(StructType([StructField(field, StringType()), StructField(_END, IntegerType())]))
    frame = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{_END}":1}}]')), schema,
                        {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    whole = (F.size(frame) == 2) & (F.element_at(frame, -1)[_END] == 1) & F.element_at(frame, 1)[_END].isNull()
    value = F.element_at(frame, 1)[field]
    # Digits alone may be a number in the payload, which is no text.
    number = value.rlike(r"^\d+$") & (F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{field}", "variant")) != "STRING")
    stamp = F.when(whole & ~F.coalesce(number, F.lit(False)), parse_iso(value, "permissive"))
    if mode == "strict":
        stamp = F.coalesce(stamp, F.raise_error(F.concat(
            F.lit(f"message without a readable '{field}' field: "), F.coalesce(F.substring(text, 1, 200), F.lit("NULL")))))
    return to_instant(stamp, TimestampNTZType())


def with_event_time(messages: DataFrame, field: str = "timestamp", delay: str = "0 seconds",
                    mode: str = "strict", data_col: str = "data",
                    out: str = EVENT_TIME) -> DataFrame:
    """Assign event time from a JSON text field of each message (E1 + P7-P9).

    Strict mode fails on a message without a readable time; permissive mode
    drops those rows (they never reach a window; ``rejected`` has them).
    """
    df = messages.withColumn(out, payload_time(data_col, field, mode)).withWatermark(out, duration_str(delay))
    if mode != "strict":
        # Above the watermark node: Catalyst does not push a filter on the
        # event-time column through it, so the parse is not repeated in a scan.
        df = df.where(F.col(out).isNotNull())
    return df


def arrival_time(mode: str = "strict", data_col: str = "data", time_col: str = "publish_time") -> Column:
    """The publish time of a message whose payload is JSON.

    Nothing of the payload is used, but it is decoded and parsed.  Strict mode
    raises on a payload that is not JSON and on a missing time; permissive mode
    gives NULL.
    """
    good = F.when(json_valid(decode_utf8(data_col, mode)), F.col(time_col))
    if mode == "strict":
        good = F.coalesce(good, F.raise_error(F.lit("message payload is not JSON, or has no publish time")))
    return good


def with_arrival_time(messages: DataFrame, delay: str = "0 seconds", mode: str = "strict",
                      out: str = EVENT_TIME) -> DataFrame:
    """No assignment step: the publish time is the event time."""
    df = messages.withColumn(out, arrival_time(mode)).withWatermark(out, duration_str(delay))
    return df if mode == "strict" else df.where(F.col(out).isNotNull())


def rejected(messages: DataFrame, field: str | None = None) -> DataFrame:
    """The messages that permissive mode leaves out, as they came: those whose
    payload is not JSON or that have no time (``field``: in the payload)."""
    time = payload_time("data", field, "permissive") if field else arrival_time("permissive")
    return messages.where(time.isNull()).select("data", "publish_time")
