"""Time columns: ISO parsing, epoch conversion and repeatable jitter.

All conversions here are independent of ``spark.sql.session.timeZone`` for
TIMESTAMP_NTZ input: they work on calendar fields, never on the session zone,
so a query gives the same answer in any session.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

US_PER_SECOND = 1_000_000
US_PER_DAY = 86_400 * US_PER_SECOND

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": US_PER_SECOND,
    "minute": 60 * US_PER_SECOND, "hour": 3_600 * US_PER_SECOND, "day": US_PER_DAY,
}


def duration_us(d: str | int | float) -> int:
    """'10 seconds' / '1 day' / 10 (seconds) -> microseconds."""
    if isinstance(d, (int, float)):
        return int(round(d * US_PER_SECOND))
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+?)s?\s*", d)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot read duration {d!r}")
    return int(round(float(m.group(1)) * _UNITS[m.group(2).lower()]))


def duration_str(d: str | int | float) -> str:
    """Normalise a duration to the '<n> microseconds' form Spark accepts."""
    return f"{duration_us(d)} microseconds"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, zone-free."""
    c = col_of(c)
    return (F.unix_date(F.to_date(c)).cast("long") * F.lit(US_PER_DAY)
            + F.hour(c).cast("long") * F.lit(3_600 * US_PER_SECOND)
            + F.minute(c).cast("long") * F.lit(60 * US_PER_SECOND)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(US_PER_SECOND)).cast("long"))


def micros_to_ntz(us: str | Column) -> Column:
    """Inverse of ``ntz_to_micros``: a TIMESTAMP_NTZ wall clock in UTC terms."""
    us = col_of(us)
    rem = F.pmod(us, F.lit(US_PER_DAY))
    days = ((us - rem) / F.lit(US_PER_DAY)).cast("int")
    secs = (rem / F.lit(US_PER_SECOND)).cast("decimal(18,6)")
    return (F.date_from_unix_date(days).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs))


def interval_us(us: int) -> Column:
    """A day-time interval of ``us`` microseconds (adds zone-free to NTZ)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              F.lit(f"{us // US_PER_SECOND}.{us % US_PER_SECOND:06d}").cast("decimal(18,6)"))


def to_micros(c: str | Column, dtype: DataType) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(dtype, TimestampNTZType):
        return ntz_to_micros(c)
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col_of(c))
    raise TypeError(f"not a timestamp type: {dtype}")


def to_instant(c: str | Column, dtype: DataType) -> Column:
    """TIMESTAMP (an instant) from TIMESTAMP or TIMESTAMP_NTZ, reading NTZ as UTC.

    Structured Streaming's watermark needs TIMESTAMP; ``cast`` would read the
    wall clock in the session zone, this does not.
    """
    if isinstance(dtype, TimestampType):
        return col_of(c)
    return F.timestamp_micros(to_micros(c, dtype))


def instant_to_ntz(c: str | Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ UTC wall clock, zone-free."""
    return micros_to_ntz(F.unix_micros(col_of(c)))


def _ntz(c: Column) -> Column:
    return F.try_to_timestamp_ntz(c) if hasattr(F, "try_to_timestamp_ntz") else c.try_cast("timestamp_ntz")


#: ISO-8601 date and time as Python's ``datetime.fromisoformat`` reads them: extended
#: or basic date; any one character; extended or basic time of hours, minutes and
#: seconds with a fraction; Z or an offset.
_DATE = r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2}))"
_CLOCK = r"(?:(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?|(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)"
_OFFSET = r"(?:(Z)|([+-])(\d{2})(?::?([0-5]\d)(?::?([0-5]\d)(?:[.,](\d+))?)?)?)"
ISO = f"(?s)^{_DATE}(?:.{_CLOCK}{_OFFSET}?)?\\z"


def _plain(c: Column) -> Column:
    """Whether the text has one of the usual shapes, by O(1) tests (no regex per
    row): a date, or a date and time with up to 6 digits of fraction and no zone.
    The cast checks the digits in between."""
    digit = lambda k: F.substring(c, k, 1).between("0", "9")
    n = F.length(c)
    clock = (F.substring(c, 14, 1) == ":") & (F.substring(c, 17, 1) == ":") & (
        (n == 19) | (n.between(21, 26) & (F.substring(c, 20, 1) == ".")))
    return digit(1) & digit(-1) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-") & ((n == 10) | clock)


def _general(c: Column) -> Column:
    """Any ISO text, taken apart by the pattern and put together again in UTC:
    no zone database and no session zone are involved."""
    def part(*groups: int, default: str = "") -> Column:
        found = [F.regexp_extract(c, ISO, g) for g in groups]
        return F.coalesce(*[F.when(f != "", f) for f in found], F.lit(default))

    micros = lambda *g: F.rpad(F.substring(part(*g, default="0"), 1, 6), 6, "0")
    local = _ntz(F.concat(part(1, 4), F.lit("-"), part(2, 5), F.lit("-"), part(3, 6), F.lit(" "), part(7, 11, default="00"), F.lit(":"),
                          part(8, 12, default="00"), F.lit(":"), part(9, 13, default="00"), F.lit("."), micros(10, 14)))
    whole = part(17, default="0").cast("int") * 3600 + part(18, default="0").cast("int") * 60 + part(19, default="0").cast("int")
    seconds = whole.cast("decimal(18,6)") + (micros(20).cast("decimal(18,6)") / 1_000_000).cast("decimal(18,6)")
    signed = F.when(part(16) == "-", -seconds).otherwise(seconds).cast("decimal(18,6)")
    # An offset is less than a day.
    return F.when(c.rlike(ISO) & (whole < 86_400), local - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), signed))


def parse_iso(c: str | Column, mode: str = "strict") -> Column:
    """ISO-8601 text to TIMESTAMP_NTZ, the UTC wall clock (P8), as Python's
    ``datetime.fromisoformat`` reads it (without week dates; a fraction beyond 6
    digits is cut off).  ``strict`` raises on bad text, ``permissive`` gives NULL.

    Zone-less text is read as UTC wall clock, whatever the session zone.  Text
    with an offset or ``Z`` is the instant it names (as Python's
    ``fromisoformat(...).timestamp()``), converted to UTC wall clock.
    """
    c = col_of(c)
    # The pattern is only tried where the usual shapes fail.
    parsed = F.coalesce(F.when(_plain(c), _ntz(c)), _general(c))
    if mode == "permissive":
        return parsed
    # coalesce keeps the parse once in the plan; NULL text stays NULL.
    return F.coalesce(parsed, F.when(c.isNotNull(), F.raise_error(
        F.concat(F.lit("not an ISO timestamp: "), c))))


def format_iso(c: str | Column) -> Column:
    """TIMESTAMP_NTZ to text as Python ``str(datetime)`` writes it (P12):
    ``YYYY-MM-DD HH:MM:SS`` plus ``.ffffff`` (six digits) when the fraction is
    not zero.  Built on the zone-free NTZ cast, whose fraction drops trailing
    zeros; they are padded back here.
    """
    s = col_of(c).cast("string")
    dot = F.instr(s, ".")
    return F.when(dot == 0, s).otherwise(
        F.concat(F.substring(s, F.lit(1), dot), F.rpad(F.substring_index(s, ".", -1), 6, "0")))


# Fixed values of the sample publisher: event times are the start instant plus
# a whole number of seconds in [0, JITTER_SECONDS).
JITTER_SECONDS = 20
# Multiplier of the repeatable stand-in for the publisher's random draw.
JITTER_MULTIPLIER = 7919


def jitter_seconds(key: str | Column, spread: int = JITTER_SECONDS) -> Column:
    """Repeatable whole-second jitter in [0, spread) derived from a key.

    The key is reduced first, so that no key overflows.
    """
    return F.pmod(F.pmod(col_of(key).cast("long"), F.lit(spread)) * F.lit(JITTER_MULTIPLIER), F.lit(spread))


def stamp(base: str | Column, key: str | Column, spread: int = JITTER_SECONDS) -> Column:
    """Start instant + jitter, as TIMESTAMP_NTZ (P10 + P11)."""
    base = F.lit(base).cast("timestamp_ntz") if isinstance(base, str) else base
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     jitter_seconds(key, spread).cast("decimal(18,6)"))
