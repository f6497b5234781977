"""One scheduling recommendation per upcoming event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import minute_of_day
from ..functions.labels import building_by_comma, building_by_comma_or_dash, venue_key
from ..functions.text import filled, title_words
from ..operators.filters import upcoming
from ..operators.intervals import overlap_degrees, with_interval
from ..operators.pairing import spread_left_join
from ..operators.slots import building_booking_counts, free_slots, stored_booking_counts, venue_booking_counts
from ..vocab import NO_VENUE_ACTION, PEAK_ACTION, PEAK_DETAILS


def is_peak(time: Column) -> Column:
    """Timed, and starting from 10:00 up to 13:59; FALSE for text that is no time."""
    return F.coalesce(minute_of_day(time).between(600, 839), F.lit(False))


def peak_hour_advice(events: DataFrame, as_of: str) -> DataFrame:
    """Upcoming events in peak hours with the fixed advice."""
    return (
        upcoming(events, as_of)
        .filter(is_peak(F.col("time")))
        .select("id", F.lit(PEAK_ACTION).alias("recommended_action"), F.lit(PEAK_DETAILS).alias("details"))
    )


def _mark(events: DataFrame, key: str, across_midnight: bool, flag: str) -> DataFrame:
    """Adds ``flag``: the event overlaps another one of its key. Joins the busy minutes, not pairs."""
    clashing = (
        overlap_degrees(events.filter(F.col(key).isNotNull()), [key], across_midnight)
        .filter("others > 0")
        .select(key, "day", "minute", "all_day", F.lit(True).alias(flag))
    )
    return events.join(clashing, [key, "day", "minute", "all_day"], "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )


def recommendations(events: DataFrame, as_of: str, stamp: Column | None = None) -> DataFrame:
    """Venue clash (high) before building clash (medium) before peak hour (low); else none.

    Free slots leave the event's own booking out: busy counts per place and date are made once for all
    events, and each event subtracts what it adds to them itself.
    """
    location, low = F.col("location"), F.lower("location")
    base = with_interval(
        upcoming(events, as_of).select("id", "title", "date", "time", "location")
    ).withColumns(
        {
            "venue": F.when(filled(location), venue_key(location)),
            "block": F.when(location.ilike("Bldg%"), building_by_comma(location)),
            "building": building_by_comma_or_dash(location),
        }
    )
    marked = _mark(_mark(base, "venue", True, "at_venue"), "block", False, "in_building")
    marked = marked.withColumn(
        "asks",
        F.when(F.col("at_venue"), F.concat(F.lit("venue:"), low)).when(
            F.col("in_building"), F.concat(F.lit("building:"), F.lower("building"))
        ),
    )
    counts = stored_booking_counts(base)
    by_venue = venue_booking_counts(counts).withColumn("asks", F.concat(F.lit("venue:"), "venue")).drop("venue")
    by_building = (
        building_booking_counts(counts)
        .withColumn("asks", F.concat(F.lit("building:"), "building"))
        .drop("building")
    )
    advised = spread_left_join(marked, by_venue.unionByName(by_building), ["asks", "date"])

    counts_itself = """start_us IS NOT NULL AND (at_venue OR (NOT all_day AND (
        startswith(lower(location), lower(building) || ',') OR startswith(lower(location), lower(building) || ' '))))"""
    advised = advised.withColumns(
        {
            "free": free_slots(counts_itself),
            "others": F.expr(f"coalesce(bookings, 0) - IF({counts_itself}, 1, 0)"),
        }
    )

    best = F.try_element_at("free", F.lit(1))
    venue_slot = F.col("at_venue") & best.isNotNull()
    building_slot = ~F.col("at_venue") & F.col("in_building") & (F.col("others") > 0) & best.isNotNull()
    clash = F.col("at_venue") | F.col("in_building")
    peak = ~clash & is_peak(F.col("time"))
    double_booked = F.concat(F.lit("Venue '"), location, F.lit("' is double-booked"))
    return advised.select(
        F.col("id").alias("event_id"),
        clash.alias("has_conflicts"),
        F.when(F.col("at_venue"), F.lit("venue_double_booking"))
        .when(F.col("in_building"), F.lit("building_conflict"))
        .alias("conflict_type"),
        F.when(F.col("at_venue"), F.lit("high"))
        .when(F.col("in_building"), F.lit("medium"))
        .when(peak, F.lit("low"))
        .otherwise(F.lit("none"))
        .alias("severity"),
        F.when(venue_slot, F.concat(F.lit("Move to "), best))
        .when(F.col("at_venue"), F.lit(NO_VENUE_ACTION))
        .when(building_slot, F.concat(F.lit("Consider moving to "), best))
        .when(peak, F.lit(PEAK_ACTION))
        .alias("recommended_action"),
        F.when(venue_slot | building_slot, F.slice("free", 1, 3))
        .otherwise(F.array().cast("array<string>"))
        .alias("alternative_times"),
        F.when(venue_slot, F.concat(double_booked, F.lit(". Recommend rescheduling to "), best, F.lit(".")))
        .when(F.col("at_venue"), F.concat(double_booked, F.lit(" with no available slots on this date.")))
        .when(
            building_slot,
            F.concat(
                F.lit("Multiple events scheduled in "),
                F.col("building"),
                F.lit(". Consider spacing out events."),
            ),
        )
        .when(peak, F.lit(PEAK_DETAILS))
        .alias("details"),
        (stamp if stamp is not None else F.current_timestamp()).alias("generated_at"),
    )


def severity_counts(recs: DataFrame) -> DataFrame:
    def count_of(severity: str) -> Column:
        return F.count_if(F.col("severity") == severity).alias(f"{severity}_severity")

    return recs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("has_conflicts").alias("with_conflicts"),
        count_of("high"),
        count_of("medium"),
        count_of("low"),
    )


def with_recommendation(events: DataFrame, recs: DataFrame) -> DataFrame:
    """Events with their stored recommendation, display defaults filled in."""
    joined = events.join(recs.withColumnRenamed("event_id", "id"), "id", "left")
    missing = F.lit("Not specified")
    return joined.select(
        "id",
        "title",
        "date",
        F.when(filled(F.col("time")), F.col("time")).otherwise(missing).alias("time"),
        F.when(filled(F.col("location")), F.col("location")).otherwise(missing).alias("location"),
        F.upper("severity").alias("severity"),
        title_words(F.col("conflict_type")).alias("conflict_type"),
        "recommended_action",
        F.array_join("alternative_times", ", ").alias("alternative_times"),
        "details",
    )
