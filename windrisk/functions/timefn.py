"""Timestamp parsing, point times, calendars and number clean-up."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 with minute or second precision, fraction and offset optional.
ISO_PATTERN = "yyyy-MM-dd['T'][' ']HH:mm[:ss][.SSSSSS][.SSS]XXX"
# Fixed value: the output form.
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_iso(text: Column) -> Column:
    """UTC instant, or NULL when the text is no timestamp. No offset means UTC."""
    trimmed = F.trim(text)
    zoned = F.when(trimmed.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), trimmed).otherwise(F.concat(trimmed, F.lit("Z")))
    return F.try_to_timestamp(zoned, F.lit(ISO_PATTERN))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUT)


def resolution_minutes(text: Column) -> Column:
    """Length of one point: 15 or 30 minutes when named so, else an hour."""
    upper = F.upper(text)
    return (F.when(upper.contains("PT15M"), F.lit(15))
            .when(upper.contains("PT30M"), F.lit(30))
            .otherwise(F.lit(60)))


def point_time(start: Column, position: Column, minutes: Column) -> Column:
    """Start of the `position`-th point (1-based)."""
    return F.timestamp_micros(F.unix_micros(start) + (position.cast("bigint") - 1) * minutes * 60_000_000)


def not_nan(value: Column) -> Column:
    """NaN becomes NULL, so that every aggregate skips missing measures alike."""
    return F.when(~F.isnan(value), value)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(3.6e9)


def hour_of(ts: Column) -> Column:
    """Start of the clock hour, in the type of `ts`."""
    return F.window(ts, "1 hour")["start"]
