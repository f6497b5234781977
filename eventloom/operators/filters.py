"""Row filters and listings over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import strict_date
from ..functions.text import abridge, contains_ci


def upcoming(events: DataFrame, as_of: str) -> DataFrame:
    """Dates are compared as text, which equals date order for canonical dates."""
    return events.filter(F.col("date") >= as_of)


def past_rows(events: DataFrame, cutoff: str) -> DataFrame:
    return events.filter(F.col("date") < cutoff)


def past(events: DataFrame, cutoff: str) -> DataFrame:
    return past_rows(events, cutoff).select("title", "date", "time")


def keep_future(rows: DataFrame, as_of: str) -> DataFrame:
    """Drops rows without a valid date or dated before ``as_of``."""
    return rows.filter(strict_date(F.col("date")) >= F.lit(as_of).cast("date"))


def date_range(
    events: DataFrame, as_of: str, date_from: str | None = None, date_to: str | None = None, mode: str = "export"
) -> DataFrame:
    """Inclusive range. In a ``listing`` the lower bound replaces ``as_of``; in an ``export`` both apply."""
    if mode not in ("listing", "export"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "export" or not date_from:
        events = upcoming(events, as_of)
    if date_from:
        events = events.filter(F.col("date") >= date_from)
    if date_to:
        events = events.filter(F.col("date") <= date_to)
    return events


def text_filters(events: DataFrame, event_type: str | None = None, location: str | None = None) -> DataFrame:
    if event_type:
        events = events.filter(contains_ci(F.col("event_type"), event_type))
    if location:
        events = events.filter(contains_ci(F.col("location"), location))
    return events


def ids_in(events: DataFrame, ids: list[int]) -> DataFrame:
    return events.filter(F.col("id").isin(*ids))


def by_id(events: DataFrame, event_id: int) -> DataFrame:
    return events.filter(F.col("id") == event_id)


def with_content(events: DataFrame, content: DataFrame, *columns: str) -> DataFrame:
    """Left join of the enhanced-content columns, one row per event."""
    picked = content.select(F.col("event_id").alias("id"), *columns)
    return events.join(picked, "id", "left")


def first_rows(events: DataFrame, as_of: str, limit: int) -> DataFrame:
    """The next ``limit`` events by date and id."""
    return upcoming(events, as_of).orderBy("date", "id").limit(limit)


def list_events(
    events: DataFrame,
    content: DataFrame,
    as_of: str,
    limit: int | None = 10,
    event_type: str | None = None,
    location: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """Listing by date: id, title, date, type, score. ``limit=None`` lists all.

    ``content`` is a stored table, or computed for the events of ``first_rows`` alone.
    """
    if location:
        events = text_filters(events, location=location)
    rows = date_range(events, as_of, date_from, date_to, "listing").select("id", "title", "date")
    if limit and not event_type:
        # The content cannot change which rows are listed.
        rows = rows.orderBy("date", "id").limit(limit)
    rows = text_filters(with_content(rows, content, "event_type", "seo_score"), event_type)
    rows = rows.withColumn("seo_score", F.coalesce("seo_score", F.lit(0))).orderBy("date", "id")
    return rows.limit(limit) if limit else rows


def list_display(listing: DataFrame) -> DataFrame:
    """Type cut to 15 characters, 'None' when missing."""
    kind: Column = F.substring(F.coalesce("event_type", F.lit("None")), 1, 15)
    return listing.withColumn("event_type", kind)


def view_next(events: DataFrame, as_of: str, limit: int = 10) -> DataFrame:
    rows = upcoming(events, as_of).orderBy("date", "time", "id").limit(limit)
    return rows.select("title", "date", "time", "location", abridge(F.col("description")).alias("description"), "link")
