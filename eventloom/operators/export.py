"""Export frames: CSV layout and calendar entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import as_timestamp, strict_date
from ..functions.text import filled
from .enhance import enhance, tag_text
from .filters import date_range, text_filters, with_content
from .intervals import with_interval

# Headers of the exported columns, in order (fixed values).
BASIC_HEADERS = {
    "id": "ID",
    "title": "Title",
    "date": "Date",
    "time": "Time",
    "location": "Location",
    "description": "Description",
    "link": "Link",
}
ENHANCED_HEADERS = {
    **BASIC_HEADERS,
    "event_type": "Event Type",
    "seo_score": "SEO Score",
    "enhanced_description": "Enhanced Description",
    "tags": "Tags",
}


def export_rows(
    events: DataFrame,
    as_of: str,
    content: DataFrame | None = None,
    tags: DataFrame | None = None,
    event_type: str | None = None,
    location: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    include_enhanced: bool = True,
) -> DataFrame:
    """Upcoming events in export order. The type filter applies with or without the enhanced columns."""
    rows = text_filters(date_range(events, as_of, date_from, date_to), location=location)
    if include_enhanced:
        rows = with_content(rows, content, "event_type", "seo_score", "enhanced_description")
        rows = text_filters(rows, event_type)
        rows = rows.join(tag_text(tags).withColumnRenamed("event_id", "id"), "id", "left")
        columns = list(ENHANCED_HEADERS)
    else:
        if event_type:
            rows = text_filters(with_content(rows, content, "event_type"), event_type)
        columns = list(BASIC_HEADERS)
    return rows.select(*columns).orderBy("date", "time", "id")


def enhanced_export_rows(
    events: DataFrame,
    as_of: str,
    event_type: str | None = None,
    location: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """``export_rows`` where no content is stored: the filtered events are enhanced once, and content and tags come from the same row.

    Rows are sorted before they are enhanced, which leaves their order, so the sort's sample does not enhance them too.
    """
    rows = text_filters(date_range(events, as_of, date_from, date_to), location=location).orderBy("date", "time", "id")
    full = text_filters(enhance(rows, keep=tuple(BASIC_HEADERS), one_pass=True), event_type)
    tags = F.when(F.size("tags") > 0, F.array_join(F.array_sort("tags"), ", "))
    return full.withColumn("tags", tags).select(*ENHANCED_HEADERS)


def with_headers(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(ENHANCED_HEADERS[c]) for c in rows.columns])


def vevents(
    events: DataFrame,
    content: DataFrame,
    as_of: str,
    event_ids: list[int] | None = None,
    event_type: str | None = None,
    location: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    uid_domain: str = "campus.example.edu",
) -> DataFrame:
    """Calendar entry fields per upcoming event; rows whose date or time does not parse are left out.

    ``dtstart``/``dtend`` are iCalendar text: a date for all-day entries (end = next day), else date and time (+1 h).
    """
    rows = date_range(events, as_of, date_from, date_to)
    if event_ids:
        rows = rows.filter(F.col("id").isin(*event_ids))
    rows = text_filters(with_content(text_filters(rows, location=location), content, "event_type"), event_type)
    parsed = with_interval(rows).filter("start_us IS NOT NULL")
    day = strict_date(F.col("date"))
    stamp = "yyyyMMdd'T'HHmmss"

    def moment(us: str) -> Column:
        return F.date_format(as_timestamp(F.col(us)), stamp)

    typed = filled(F.col("event_type"))
    description = F.when(typed, F.concat(F.lit("["), F.col("event_type"), F.lit("]\n\n"), F.col("description"))).otherwise(
        F.col("description")
    )
    return parsed.select(
        "id",
        F.concat(F.lit("event-"), F.col("id").cast("string"), F.lit(f"@{uid_domain}")).alias("uid"),
        F.col("title").alias("summary"),
        F.when(F.col("all_day"), F.date_format(day, "yyyyMMdd")).otherwise(moment("start_us")).alias("dtstart"),
        F.when(F.col("all_day"), F.date_format(F.date_add(day, 1), "yyyyMMdd")).otherwise(moment("end_us")).alias("dtend"),
        "all_day",
        F.when(filled(F.col("description")), description).alias("description"),
        F.when(filled(F.col("location")), F.col("location")).alias("location"),
        F.when(filled(F.col("link")), F.col("link")).alias("url"),
        F.when(typed, F.col("event_type")).alias("categories"),
        "date",
        "time",
    )


def escaped(text: Column) -> Column:
    """iCalendar TEXT escaping: backslash, semicolon, comma, line break."""
    return F.regexp_replace(F.regexp_replace(text, r"([\;,])", r"\\$1"), "\r\n|\n|\r", r"\\n")


def vevent_text(entries: DataFrame, stamp: Column) -> DataFrame:
    """(id, date, time, body): the complete VEVENT block of each entry, lines joined by CRLF."""
    now = F.date_format(stamp, "yyyyMMdd'T'HHmmss")
    kind = F.when(F.col("all_day"), F.lit(";VALUE=DATE")).otherwise(F.lit(""))

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}:"), value))

    lines = [
        F.lit("BEGIN:VEVENT"),
        line("SUMMARY", escaped(F.col("summary"))),
        F.concat(F.lit("DTSTART"), kind, F.lit(":"), F.col("dtstart")),
        F.concat(F.lit("DTEND"), kind, F.lit(":"), F.col("dtend")),
        line("DTSTAMP", now),
        line("UID", F.col("uid")),
        line("CATEGORIES", escaped(F.col("categories"))),
        line("CREATED", now),
        line("DESCRIPTION", escaped(F.col("description"))),
        line("LAST-MODIFIED", now),
        line("LOCATION", escaped(F.col("location"))),
        F.lit("SEQUENCE:0"),
        F.lit("STATUS:CONFIRMED"),
        F.lit("TRANSP:OPAQUE"),
        line("URL", F.col("url")),
        F.when(F.col("all_day"), F.lit("X-MICROSOFT-CDO-ALLDAYEVENT:TRUE")),
        F.lit("END:VEVENT"),
    ]
    return entries.select("id", "date", "time", F.concat_ws("\r\n", *lines).alias("body"))
