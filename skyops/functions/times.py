"""Time parsing and arithmetic that give the same result in every session time zone.

Wall-clock values are ``TIMESTAMP_NTZ``. Text is parsed as a UTC instant first and then shifted to the wall clock by
counting microseconds from the epoch, so no value ever passes through the session zone and its daylight-saving gaps. For
the same reason differences are taken by subtracting wall clocks: ``timestampdiff`` would cast both to instants first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text format (minutes, offset as Z or +hh) and the width of a request window.
OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mmX"
WINDOW_HOURS = 4


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def utc_wall_clock(instant: Column) -> Column:
    """UTC wall clock of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def utc_time(raw: Column) -> Column:
    """``2024-03-10T02:30Z`` to UTC wall clock; anything else is NULL, never an error."""
    return utc_wall_clock(F.try_to_timestamp(raw, F.lit(OFFSET_PATTERN)))


def local_time(raw: Column) -> Column:
    """``2024-03-10T02:30`` to wall clock; text that already has a zone, seconds or junk is NULL."""
    return utc_time(F.concat(raw, F.lit("Z")))


def flight_date(local: Column, utc: Column) -> Column:
    return F.coalesce(F.to_date(local), F.to_date(utc))


def delay_minutes(scheduled: Column, actual: Column) -> Column:
    """Whole minutes from scheduled to actual, cut toward zero; negative when early."""
    gap = actual - scheduled
    # Every field of an interval has the interval's sign, so this sum is already cut toward zero.
    whole = [F.extract(F.lit(field), gap) * minutes for field, minutes in (("DAY", 1440), ("HOUR", 60), ("MINUTE", 1))]
    return (whole[0] + whole[1] + whole[2]).cast("int")


def window_floor(wall_clock: Column, offset_hours: Column | int = 0) -> Column:
    """Start of the 4-hour window holding ``wall_clock``, moved back by ``offset_hours`` (negative: forward)."""
    into_window = F.make_dt_interval(
        F.lit(0), F.hour(wall_clock) % WINDOW_HOURS, F.minute(wall_clock), F.extract(F.lit("SECOND"), wall_clock)
    )
    offset = F.lit(offset_hours) if isinstance(offset_hours, int) else offset_hours
    return F.timestamp_add("HOUR", -offset, wall_clock - into_window)


def window_label(window_start: Column) -> Column:
    """``yyyy-MM-ddTHH:mm`` text of a wall clock."""
    return F.translate(F.substring(window_start.cast("string"), 1, 16), " ", "T")
