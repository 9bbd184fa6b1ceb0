"""Time conversions that do not depend on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the wire format of event_time; one to six fraction digits and the Z are required.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_iso(text: Column) -> Column:
    """``2024-01-15T14:23:01.000Z`` to an instant; fails on any other shape.

    The literal ``Z`` of the pattern carries no zone, so a second one is appended and read as the
    offset. Otherwise the text would be taken in the session's zone.
    """
    return F.to_timestamp(F.concat(text, F.lit("Z")), ISO_PATTERN + "X")


def _div(number: Column, by: int) -> Column:
    """Whole-number division, towards zero."""
    return F.call_function("div", number, F.lit(by))


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def iso_text(ts: Column) -> Column:
    """The wire format with milliseconds, in UTC."""
    ms = epoch_ms(ts)
    of_day = F.pmod(ms, F.lit(86_400_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), _div(ms - of_day, 86_400_000).cast("int"))
    return F.concat(
        day.cast("string"),
        F.lit("T"),
        _digits(_div(of_day, 3_600_000), 2),
        F.lit(":"),
        _digits(_div(of_day, 60_000) % 60, 2),
        F.lit(":"),
        _digits(_div(of_day, 1000) % 60, 2),
        F.lit("."),
        _digits(of_day % 1000, 3),
        F.lit("Z"),
    )


def epoch_ms(ts: Column) -> Column:
    """Whole milliseconds since the epoch; finer digits are cut off."""
    return _div(F.unix_micros(ts), 1000)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def window_label(window_start: Column) -> Column:
    """``HH:mm`` of a window start, in UTC whatever the session zone."""
    second_of_day = F.pmod(F.unix_seconds(window_start), F.lit(86_400))
    hour, minute = _div(second_of_day, 3600), _div(second_of_day, 60) % 60
    return F.concat(_digits(hour, 2), F.lit(":"), _digits(minute, 2))
