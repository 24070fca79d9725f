"""Column functions: casts, clocks, identifiers and display formats. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickloom.schemas import TOPIC_PREFIX


def once(value: Column) -> Column:
    """A column for ``select`` that is computed exactly once per row.

    The optimizer copies an expression into every filter and projection above that mentions it, which would parse a
    JSON text several times. It does not reach through a generator, and a one-element array gives one row for each.
    """
    return F.explode(F.array(value))


def event_time_from_millis(ms: Column) -> Column:
    """Epoch milliseconds to an instant, milliseconds kept and no detour through a zoned string."""
    return F.timestamp_millis(ms)


# a date, a time of day and Z or an offset: without any of them a cast would fill in today, midnight or its own zone
_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def millis_from_rfc3339(text: Column) -> Column:
    """RFC 3339 text to epoch milliseconds; NULL when it is not all there, so the caller can set the row aside."""
    return F.unix_millis(F.when(text.rlike(_RFC3339), F.try_to_timestamp(text)))


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_long(text: Column) -> Column:
    return text.try_cast("bigint")


def prefixed_trade_id(source: Column, native_id: Column) -> Column:
    """``source:id``; NULL when the venue sent no id (plain concatenation, so that NULL is not skipped)."""
    return F.concat(source, F.lit(":"), native_id.cast("string"))


def topic_of(symbol: Column) -> Column:
    return F.concat(F.lit(TOPIC_PREFIX), F.lower(symbol))


def _floored(ts: Column, micros: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(micros).cast("decimal(20,0)")).cast("long")


def snapshot_hour(ts: Column) -> Column:
    """Start of the hour in UTC, whatever the session's zone."""
    return F.timestamp_micros(_floored(ts, 3_600_000_000) * 3_600_000_000)


def utc_date(ts: Column) -> Column:
    """Date of an instant in UTC, whatever the session's zone."""
    return F.date_from_unix_date(_floored(ts, 86_400_000_000).cast("int"))


def in_zone(ts: Column, zone: str) -> Column:
    """Wall-clock time of an instant in a display zone, as a timestamp without zone, whatever the session's zone."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def price_text(price: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(price, 4))


def percent_text(pct: Column) -> Column:
    return F.concat(F.call_function("format_number", pct, F.lit("+0.00;-0.00")), F.lit("%"))


def bps_text(bps: Column) -> Column:
    return F.concat(F.call_function("format_number", bps, F.lit("+0;-0")), F.lit("bps"))


def one_decimal_text(value: Column) -> Column:
    return F.call_function("format_number", value, F.lit("0.0"))
