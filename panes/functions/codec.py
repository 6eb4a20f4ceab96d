"""Payload codecs as column expressions.

Every function is a built-in Spark expression (JVM side, whole-stage codegen);
no Python runs per row.  ``mode="strict"`` fails the job on a bad record, as
the reference pipeline does; ``mode="permissive"`` yields NULL so the caller
can route the row to a rejects output (see ``split_rejects``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timestamps import col_of

MODES = ("strict", "permissive")

# JSON insignificant whitespace, and the characters the quote
# normaliser strips from both ends of its input.
JSON_WHITESPACE = " \t\n\r"
QUOTE_STRIP_CHARS = "'<>() "


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _or_raise(value: Column, message: str) -> Column:
    """``value``, or fail the query where it is NULL.  ``coalesce`` keeps the
    value's expression once in the plan (a ``CASE`` over ``isnull(value)``
    would compute it twice)."""
    return F.coalesce(value, F.raise_error(F.lit(message)))


def decode_utf8(c: str | Column, mode: str = "strict") -> Column:
    """Bytes to text (P1).  Strict raises on malformed UTF-8, permissive gives NULL."""
    _check_mode(mode)
    c = col_of(c)
    if mode == "strict":
        return F.decode(c, "UTF-8")
    return F.try_validate_utf8(c.cast("string"))


def encode_utf8(c: str | Column) -> Column:
    """Text to bytes."""
    return F.encode(col_of(c), "UTF-8")


def parse(c: str | Column, mode: str = "strict", schema=None) -> Column:
    """JSON text to a value (P2): VARIANT by default, or typed by ``schema``.

    With a schema, strict mode raises on malformed records (FAILFAST) and
    permissive mode yields NULL fields.
    """
    _check_mode(mode)
    c = col_of(c)
    if schema is not None:
        opts = {"mode": "FAILFAST" if mode == "strict" else "PERMISSIVE"}
        return F.from_json(c, schema, opts)
    return F.parse_json(c) if mode == "strict" else F.try_parse_json(c)


#: Stands after a text in the frame that tells whether the text is one value.
_END = "__end_of_value__"

#: Python takes what Spark's JSON readers take by default, but for this.
_PYTHON_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def _framed(c: Column) -> Column:
    """The text as an array of two: itself and the end mark.

    Spark's JSON readers stop after the first complete value.  Inside an array
    they cannot: a second value, an extra closer or any trailing text makes the
    array malformed or gives it another size or another last element.
    """
    return F.from_json(F.concat(F.lit("["), c, F.lit(f',"{_END}"]')), "array<string>", _PYTHON_JSON)


def _is_one_value(frame: Column) -> Column:
    return F.coalesce((F.size(frame) == 2) & (F.element_at(frame, -1) == _END), F.lit(False))


def json_length(c: str | Column, mode: str = "strict") -> Column:
    """Length of a JSON text as Python's ``len(json.loads(x))`` (P2 + P3).

    array -> elements; object -> distinct keys (a repeated key counts once);
    string -> code points.  Numbers, booleans, null, malformed or empty text
    have no length: strict mode raises, permissive mode gives NULL.

    The first non-blank character picks the branch.  ``NaN`` and ``Infinity``
    are values, as in Python; the fast readers of arrays and objects do not take
    them, so the general one stands behind each.
    """
    _check_mode(mode)
    c = col_of(c)
    frame = _framed(c)
    head = F.substring(F.ltrim(F.substring(c, 1, 64), F.lit(JSON_WHITESPACE)), 1, 1)
    first = F.when(head == "", F.substring(F.ltrim(c, F.lit(JSON_WHITESPACE)), 1, 1)).otherwise(head)
    items = F.coalesce(F.json_array_length(c), F.size(F.from_json(c, "array<string>", _PYTHON_JSON)))
    keys = F.coalesce(F.json_object_keys(c), F.map_keys(F.from_json(c, "map<string,string>", _PYTHON_JSON)))
    n = (F.when(~_is_one_value(frame), None)
          .when(first == "[", items)
          .when(first == "{", F.array_size(F.array_distinct(keys)))
          .when(first == '"', F.length(F.element_at(frame, 1)))
          .cast("long"))
    if mode == "permissive":
        return n
    return _or_raise(n, "JSON value has no length (not an array, object or string)")


def json_valid(c: str | Column) -> Column:
    """Whether a text is one JSON value as Python's ``json.loads`` accepts it
    (P2 as a check): TRUE or FALSE, never NULL."""
    return _is_one_value(_framed(col_of(c)))


def json_array_text(c: str | Column) -> Column:
    """A JSON array text from an array column."""
    return F.to_json(col_of(c))


def json_string_text(c: str | Column) -> Column:
    """A JSON string literal (quoted, escaped) from a text column."""
    arr = F.to_json(F.array(col_of(c)))  # ["..."] -> "..."
    return F.substring(arr, F.lit(2), F.length(arr) - F.lit(2))


def to_json_record(c: str | Column, null_fields: bool = True) -> Column:
    """A record (struct, map, array or VARIANT) to JSON text.

    ``null_fields=True`` keeps NULL struct fields, as ``json.dumps`` keeps ``None``.
    """
    return F.to_json(col_of(c), {"ignoreNullFields": "false" if null_fields else "true"})


def encode_count(n: str | Column) -> Column:
    """An integer count as the UTF-8 bytes of its decimal digits (P5 + P6)."""
    return encode_utf8(col_of(n).cast("long").cast("string"))


def normalize_quotes(c: str | Column) -> Column:
    """Strip ``'<>() `` from both ends, then turn ``'`` into ``"``."""
    return F.replace(F.btrim(col_of(c), F.lit(QUOTE_STRIP_CHARS)), F.lit("'"), F.lit('"'))


def split_rejects(df: DataFrame, checked: str) -> tuple[DataFrame, DataFrame]:
    """Split on a permissive result column: (rows where it is set, rows where NULL)."""
    return df.where(F.col(checked).isNotNull()), df.where(F.col(checked).isNull())
