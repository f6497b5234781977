"""Field cleaning. Each function returns ``Cleaned`` columns: value, error and warning text (NULL when none)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .calendar import clock, minute_of_day, strict_date
from .text import collapse, collapse_long, filled, strip, unicode_pattern

def no_text() -> Column:
    return F.lit(None).cast("string")


class Cleaned(NamedTuple):
    value: Column
    error: Column
    warning: Column


def _too_long(col: Column, limit: int, field: str) -> Column:
    return F.when(F.length(col) > limit, F.lit(f"{field} exceeds {limit} characters, truncating"))


def clean_title(col: Column) -> Cleaned:
    """Length is tested and cut before white space is collapsed."""
    text = strip(col)
    long_enough = F.length(text) >= vocab.TITLE_MIN
    error = F.when(~filled(col), F.lit("Title is required")).when(
        ~long_enough, F.concat(F.lit("Title too short: '"), text, F.lit("'"))
    )
    return Cleaned(
        F.when(filled(col) & long_enough, collapse(F.substring(text, 1, vocab.TITLE_MAX))),
        error,
        _too_long(text, vocab.TITLE_MAX, "Title"),
    )


def clean_date(col: Column) -> Cleaned:
    """Canonical ``YYYY-MM-DD``; three other layouts are converted with a warning."""
    text = strip(col)
    canonical = strict_date(text)
    day, warning = canonical, no_text()
    for shape, pattern, name in reversed(vocab.DATE_LAYOUTS):
        parsed = F.when(text.rlike(shape), F.try_to_date(text, pattern))
        warning = F.when(parsed.isNotNull(), F.lit(f"Date converted from {name} to YYYY-MM-DD")).otherwise(warning)
        day = F.coalesce(day, parsed)
    # The costly test comes first: the planner computes it once for value and error.
    invalid = F.concat(F.lit("Invalid date format: '"), col, F.lit("'"))
    error = F.when(day.isNull(), F.when(filled(col), invalid).otherwise(F.lit("Date is required")))
    return Cleaned(day.cast("string"), error, F.when(canonical.isNull(), warning))


def _twelve_hour_minutes(text: Column) -> Column:
    """Minutes since midnight of ``2:30 PM``, ``2:30PM`` or ``2 PM``."""
    shape = unicode_pattern(r"(?i)^(1[0-2]|0?[1-9])(?::([0-5]?[0-9])\s*|\s+)([ap])m$")
    hour = F.regexp_extract(text, shape, 1).try_cast("int")
    minute = F.coalesce(F.regexp_extract(text, shape, 2).try_cast("int"), F.lit(0))
    afternoon = F.lower(F.regexp_extract(text, shape, 3)) == "p"
    return F.when(text.rlike(shape), (hour % 12 + F.when(afternoon, 12).otherwise(0)) * 60 + minute)


def clean_time(col: Column) -> Cleaned:
    """``HH:MM`` or NULL; a bad time is a warning, never an error."""
    text = strip(col)
    direct, converted = minute_of_day(text), _twelve_hour_minutes(text)
    warning = (
        F.when(~filled(col) | direct.isNotNull(), no_text())
        .when(converted.isNotNull(), F.lit("Time converted from 12-hour to 24-hour format"))
        .otherwise(F.concat(F.lit("Invalid time format: '"), col, F.lit("', skipping")))
    )
    return Cleaned(F.when(filled(col), clock(F.coalesce(direct, converted))), no_text(), warning)


def _clean_optional(text: Column, limit: int, field: str) -> Cleaned:
    """``text``: stripped, its white space collapsed."""
    return Cleaned(F.nullif(F.substring(text, 1, limit), F.lit("")), no_text(), _too_long(text, limit, field))


def clean_location(col: Column) -> Cleaned:
    return _clean_optional(collapse(strip(col)), vocab.LOCATION_MAX, "Location")


def clean_description(col: Column) -> Cleaned:
    return _clean_optional(collapse_long(strip(col)), vocab.DESCRIPTION_MAX, "Description")


def clean_link(col: Column) -> Cleaned:
    text = strip(col)
    good = F.coalesce(text.rlike("(?iu)" + unicode_pattern(vocab.URL_PATTERN)), F.lit(False))
    invalid = F.concat(F.lit("Invalid URL format: '"), text, F.lit("'"))
    error = F.when(~good, F.when(filled(col), invalid).otherwise(F.lit("Link is required")))
    return Cleaned(F.when(good, text), error, no_text())


CLEANERS = {
    "title": clean_title,
    "date": clean_date,
    "link": clean_link,
    "time": clean_time,
    "location": clean_location,
    "description": clean_description,
}
REQUIRED_FIELDS = ["title", "date", "link"]
