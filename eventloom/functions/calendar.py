"""Strict date and time parsing, and the interval an event occupies.

Intervals are microseconds since the epoch held in BIGINT columns: comparisons,
equi-join cells and window ranges on them stay inside generated code and do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import DAY_MICROS, EVENT_MINUTES, MINUTE_MICROS
from .text import filled

DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIME_SHAPE = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]$"


def strict_date(col: Column) -> Column:
    """DATE for ``YYYY-M-D`` text, else NULL (never an error)."""
    return F.when(col.rlike(DATE_SHAPE), col.try_cast("date"))


def lenient_date(col: Column) -> Column:
    """DATE from the first ten characters, for rows that carry a time in the date column."""
    return strict_date(F.substring(col, 1, 10))


def minute_of_day(col: Column) -> Column:
    """Minutes since midnight for ``H:M`` text, else NULL."""
    hours = F.split_part(col, F.lit(":"), F.lit(1)).try_cast("int")
    minutes = F.split_part(col, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(col.rlike(TIME_SHAPE), hours * 60 + minutes)


def clock(minutes: Column) -> Column:
    """``HH:MM`` text of a minute of the day."""
    hour = F.lpad(F.floor(minutes / 60).cast("string"), 2, "0")
    return F.concat(hour, F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))


def untimed(time: Column) -> Column:
    return ~filled(time)


def start_us(date: Column, time: Column) -> Column:
    day = F.unix_date(strict_date(date)).cast("bigint") * DAY_MICROS
    timed = day + minute_of_day(time).cast("bigint") * MINUTE_MICROS
    return F.when(untimed(time), day).otherwise(timed)


def end_us(start: Column, time: Column) -> Column:
    """One hour after a timed start; 23:59:59.999999 of the day for an untimed event."""
    return start + F.when(untimed(time), F.lit(DAY_MICROS - 1)).otherwise(F.lit(EVENT_MINUTES * MINUTE_MICROS))


def as_timestamp(us: Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ of epoch microseconds."""
    seconds = (us.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )


def split_iso(col: Column) -> tuple[Column, Column]:
    """(date, time) of ``YYYY-MM-DD[THH:MM…]``; both NULL when the text does not hold a valid date."""
    parts = F.size(F.split(col, "T"))
    day = F.split_part(col, F.lit("T"), F.lit(1))
    good = F.coalesce(filled(col) & (parts <= 2) & strict_date(day).isNotNull(), F.lit(False))
    date = F.when(good, day)
    time = F.when(good & (parts == 2), F.substring(F.split_part(col, F.lit("T"), F.lit(2)), 1, 5))
    return date, time
