"""Timestamp parsing and formatting. Epoch values are UTC seconds; no session time zone leaks in."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_ZONE = r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?"
_TIME = r"(?:[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?|[0-9]{4}(?:[0-9]{2}(?:[.,][0-9]+)?)?)"
_ISO = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})(?:[^0-9]" + _TIME + _ZONE + r")?\z"
_WEEK = r"^[0-9]{4}-?W[0-9]{2}(?:-?[1-7])?\z"

# Rewrites any accepted ISO form into the one form the timestamp cast reads, in order.
_NORMAL = [
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
    (r"^(.{10})\z", "$1T00:00:00Z"),
    (r"^(.{10}).([0-9]{2})([0-9]{2})([0-9]{2})", "$1T$2:$3:$4"),
    (r"^(.{10}).([0-9]{2})([0-9]{2})(?![0-9])", "$1T$2:$3:00"),
    (r"^(.{10}).([0-9]{2})(?![0-9:])", "$1T$2:00:00"),
    (r"^(.{10}).([0-9]{2}:[0-9]{2})(?![0-9:])", "$1T$2:00"),
    (r"^(.{10})[^T]", "$1T"),
    (r",", "."),
    (r"(T[0-9:.]+)\z", "$1Z"),
]

# Fixed value: accepted layouts of a date argument.
DATE_ARGUMENT_PATTERNS = [
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(Z|[+-][0-9]{2}:?[0-9]{2})$",
]

# Other spellings accepted by the lenient parser without leaving the JVM. A weekday is dropped
# first; texts without a zone are read as UTC.
_WEEKDAY = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? +"
ZONED_FORMATS = ["d MMM yyyy HH:mm:ss Z"]
PLAIN_FORMATS = [
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
]


def _finite_number(value: Column) -> Column:
    number = F.when(value.rlike(_NUMBER), F.trim(value).try_cast("double"))
    # Infinity times zero is not a number.
    return F.nanvl(number + number * 0.0, F.lit(None).cast("double"))


def _iso_micros(value: Column) -> Column:
    """Epoch microseconds of an ISO-8601 text (calendar or week date), null for anything else."""
    text = F.when(value.rlike(_ISO), value)
    for pattern, replacement in _NORMAL:
        text = F.regexp_replace(text, pattern, replacement)
    calendar = F.unix_micros(text.try_cast("timestamp"))
    digits = F.regexp_replace(F.when(value.rlike(_WEEK), value), "[-W]", "")
    first = F.concat(F.substring(digits, 1, 4), F.lit("-01-04")).try_cast("date")
    monday = F.unix_date(F.trunc(first, "week"))
    week = F.substring(digits, 5, 2).try_cast("int")
    day = F.coalesce(F.substring(digits, 7, 1).try_cast("int"), F.lit(1))
    in_year = (monday + (week - 1) * 7 + day - 1).cast("long") * 86_400_000_000
    return F.coalesce(calendar, F.when(week.between(1, 53), in_year))


def _iso_epoch(value: Column) -> Column:
    return _iso_micros(value).cast("double") / F.lit(1000000.0)


def micros_text(micros: Column) -> Column:
    """Epoch microseconds to seconds as text, ``1676196636.0`` style."""
    seconds = (micros.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast(
        "decimal(22,6)"
    )
    return F.regexp_replace(F.regexp_replace(seconds.cast("string"), "0+$", ""), r"\.$", ".0")


def parse_timestamp(value: Column) -> Column:
    """Strict: a finite epoch number or ISO-8601 text to epoch seconds, else null."""
    return F.when(value.rlike(_NUMBER), _finite_number(value)).otherwise(_iso_epoch(value))


def parse_date_lenient(value: Column) -> Column:
    """Lenient: numeric text is seconds, then ISO, then common written forms. Epoch seconds."""
    plain = F.regexp_replace(value, _WEEKDAY, "")
    utc = F.concat(plain, F.lit(" Z"))
    written = F.coalesce(
        *[F.try_to_timestamp(plain, F.lit(f)) for f in ZONED_FORMATS],
        *[F.try_to_timestamp(utc, F.lit(f"{f} XXX")) for f in PLAIN_FORMATS],
    )
    return F.coalesce(
        _finite_number(value),
        _iso_epoch(value),
        F.unix_micros(written).cast("double") / F.lit(1000000.0),
    )


def parse_date_millis(value: Column) -> Column:
    """Lenient parse of an integer column: integers are milliseconds."""
    return value.cast("double") / F.lit(1000.0)


@F.pandas_udf(T.DoubleType())
def _free_form(values: pd.Series) -> pd.Series:
    from dateutil import parser

    def one(text):
        if text is None:
            return None
        try:
            parsed = parser.parse(text)
        except (ValueError, OverflowError):
            return None
        stamp = pd.Timestamp(parsed)
        return (stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp).timestamp()

    return values.map(one, na_action="ignore").astype("float64")


def parse_date_free_form(value: Column) -> Column:
    """As :func:`parse_date_lenient`, with a Python parser for what no JVM format reads.

    Only the unread residue carries text into Python; all other rows pass a null.
    """
    native = parse_date_lenient(value)
    return F.coalesce(native, _free_form(F.when(native.isNull(), value)))


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double in plain notation, ``1676196636.0`` style.

    Covers the magnitudes that occur in dates and vectors; outside 1e-4..1e16 the exponent form
    ``1e-05`` is used.
    """
    raw = value.cast("string")
    mantissa = F.regexp_extract(raw, r"^(-?[0-9.]+)E(-?[0-9]+)$", 1)
    exponent = F.regexp_extract(raw, r"^(-?[0-9.]+)E(-?[0-9]+)$", 2)
    exp = F.when(exponent != "", exponent.cast("int"))
    plain = F.regexp_replace(
        F.regexp_replace(raw.try_cast("decimal(38,21)").cast("string"), r"0+$", ""), r"\.$", ".0"
    )
    scientific = F.concat(
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"),
    )
    return (
        F.when(exp.isNull(), raw).when((exp >= -4) & (exp < 16), plain).otherwise(scientific)
    )


def iso_to_epoch_string(value: Column) -> Column:
    """ISO text to epoch seconds as text."""
    return micros_text(_iso_micros(value))


def epoch_string(ts: Column) -> Column:
    """Timestamp column to epoch seconds as text."""
    return micros_text(F.unix_micros(ts))


def epoch_to_timestamp(epoch: Column) -> Column:
    return F.timestamp_micros(F.round(epoch * 1000000).cast("long"))


def format_rfc3339(epoch: Column) -> Column:
    """Epoch seconds to ``2023-11-14T22:13:20.000000Z``, in UTC whatever the session zone is."""
    micros = F.round(epoch * 1000000).cast("long")
    moment = F.timestamp_micros(micros).cast("timestamp")
    zone_free = moment.cast("timestamp_ntz")
    wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zone_free).cast("string")
    fraction = F.rpad(F.substring(wall, 21, 6), 6, "0")
    return F.concat(
        F.substring(wall, 1, 10), F.lit("T"), F.substring(wall, 12, 8), F.lit("."), fraction,
        F.lit("Z"),
    )


def ensure_isoformat(value: Column, strict: bool = True) -> Column:
    """Any readable date text to ISO text without zone; unreadable text fails the job, or is null
    if not ``strict``."""
    epoch = parse_date_lenient(value)
    text = F.regexp_replace(F.substring(format_rfc3339(epoch), 1, 26), r"\.000000$", "")
    if not strict:
        return text
    problem = F.raise_error(F.concat(F.lit("not a date: "), value))
    return F.when(value.isNull() | epoch.isNotNull(), text).otherwise(problem)


def is_date_argument(value: Column) -> Column:
    """True when the text has one of the accepted layouts and names a real moment."""
    layout = F.lit(False)
    for pattern in DATE_ARGUMENT_PATTERNS:
        layout = layout | value.rlike(pattern)
    date = F.regexp_extract(value, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", 1).try_cast("date")
    clock = F.regexp_extract(value, r"[T+]([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})", 0)
    pieces = F.split(F.substring(clock, 2, 8), ":")
    clock_ok = (clock == "") | (
        (F.get(pieces, F.lit(0)).try_cast("int") < 24)
        & (F.get(pieces, F.lit(1)).try_cast("int") < 60)
        & (F.get(pieces, F.lit(2)).try_cast("int") < 62)
    )
    return F.coalesce(layout & date.isNotNull() & clock_ok, F.lit(False))
