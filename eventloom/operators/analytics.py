"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import lenient_date
from ..functions.labels import building_label, location_class, names_a_building
from .filters import upcoming, with_content


def n_rows() -> Column:
    return F.count(F.lit(1))


def top_locations(events: DataFrame, limit: int = 5) -> DataFrame:
    counts = events.filter("location IS NOT NULL").groupBy("location").agg(n_rows().alias("count"))
    return counts.orderBy(F.desc("count"), "location").limit(limit)


def weekday_distribution(events: DataFrame) -> DataFrame:
    """Sunday first; rows without a valid date form a NULL bucket."""
    day = lenient_date(F.col("date"))
    counts = events.groupBy((F.dayofweek(day) - 1).alias("day_number"), F.date_format(day, "EEEE").alias("day_of_week"))
    return counts.agg(n_rows().alias("count")).orderBy(F.asc_nulls_first("day_number")).select("day_of_week", "count")


def month_distribution(events: DataFrame, year: int) -> DataFrame:
    day = lenient_date(F.col("date"))
    in_year = events.filter(F.col("date").startswith(str(year)) & day.isNotNull())
    counts = in_year.groupBy(F.month(day).alias("month_number"), F.date_format(day, "MMMM").alias("month"))
    return counts.agg(n_rows().alias("count")).orderBy("month_number").select("month", "count")


def time_specification(events: DataFrame) -> DataFrame:
    status = F.when(F.col("time").isNull(), F.lit("No specific time")).otherwise(F.lit("Has specific time"))
    return events.groupBy(status.alias("time_status")).agg(n_rows().alias("count"))


def share_of_total(counts: DataFrame) -> DataFrame:
    """Adds ``percentage`` of the summed counts, one decimal."""
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.withColumn("percentage", F.bround(F.col("count") / total * 100, 1))


def events_by_building(events: DataFrame) -> DataFrame:
    located = events.filter(F.col("location").isNotNull() & names_a_building(F.col("location")))
    counts = located.groupBy(building_label(F.col("location")).alias("building")).agg(n_rows().alias("count"))
    return counts.orderBy(F.desc("count"), "building")


def events_by_location_class(events: DataFrame, limit: int = 5) -> DataFrame:
    located = events.filter("location IS NOT NULL AND location != ''")
    counts = located.groupBy(location_class(F.col("location")).alias("location_type")).agg(n_rows().alias("count"))
    return counts.orderBy(F.desc("count"), "location_type").limit(limit)


def building_counts(events: DataFrame) -> DataFrame:
    """Events by building, or by location class when no building is named at all."""
    by_building = events_by_building(events)
    named = events.filter(F.col("location").isNotNull() & names_a_building(F.col("location")))
    fallback = events_by_location_class(events).filter(~named.select(F.lit(1)).exists())
    return by_building.unionByName(fallback.withColumnRenamed("location_type", "building"))


def type_distribution(content: DataFrame) -> DataFrame:
    counts = content.filter("event_type IS NOT NULL").groupBy("event_type").agg(n_rows().alias("count"))
    return counts.orderBy(F.desc("count"), "event_type")


def seo_summary(content: DataFrame) -> DataFrame:
    return content.filter("seo_score IS NOT NULL").agg(
        F.avg("seo_score").alias("avg_score"),
        F.min("seo_score").alias("min_score"),
        F.max("seo_score").alias("max_score"),
    )


def totals(events: DataFrame, as_of: str) -> DataFrame:
    return events.agg(n_rows().alias("total_events"), F.count_if(F.col("date") >= as_of).alias("upcoming_events"))


def building_utilisation(counts: DataFrame) -> DataFrame:
    """Share of the busiest building (one decimal, half-even) and the peak times it implies."""
    most = counts.agg(F.max("count").alias("m")).scalar()
    peaks = F.when(
        F.col("count") >= most * 0.7,
        F.array_compact(
            F.array(F.lit("Morning"), F.when(F.col("count") >= most * 0.8, F.lit("Afternoon")))
        ),
    ).otherwise(F.array(F.lit("Variable")))
    share = F.bround(F.col("count") / most * 100, 1)
    return counts.select("building", "count", peaks.alias("peak_times"), share.alias("utilization"))


def frequent_types(content: DataFrame) -> DataFrame:
    top = type_distribution(content).limit(3).filter("count > 1")
    sentence = F.concat(
        F.col("event_type"), F.lit(" events occur most frequently ("), F.col("count").cast("string"), F.lit(" events)")
    )
    return top.select(sentence.alias("pattern"))


def insights(events: DataFrame, content: DataFrame) -> DataFrame:
    """Up to three sentences: busiest building, commonest type, score range. Empty input gives no rows."""
    building = building_counts(events).orderBy(F.desc("count"), "building").limit(1)
    kind = type_distribution(content).limit(1)
    score = seo_summary(content).filter("avg_score IS NOT NULL")
    lines = [
        building.select(
            F.lit(1).alias("line"),
            F.format_string("%s is the most utilized building with %d events", "building", "count").alias("insight"),
        ),
        kind.select(
            F.lit(2).alias("line"),
            F.format_string("Most common event type is %s with %d events", "event_type", "count").alias("insight"),
        ),
        score.select(
            F.lit(3).alias("line"),
            F.format_string(
                "Average SEO score is %.1f, ranging from %.1f to %.1f",
                "avg_score",
                F.col("min_score").cast("double"),
                F.col("max_score").cast("double"),
            ).alias("insight"),
        ),
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def upcoming_by_type(events: DataFrame, content: DataFrame, as_of: str) -> DataFrame:
    rows = with_content(upcoming(events, as_of).select("id"), content, "event_type")
    counts = rows.filter("event_type IS NOT NULL").groupBy("event_type").agg(n_rows().alias("count"))
    return counts.orderBy(F.desc("count"), "event_type")


def upcoming_by_month(events: DataFrame, as_of: str) -> DataFrame:
    month = F.date_format(lenient_date(F.col("date")), "yyyy-MM")
    return upcoming(events, as_of).groupBy(month.alias("month")).agg(n_rows().alias("count")).orderBy("month")


def duplicate_groups(events: DataFrame) -> DataFrame:
    """(title, date) that occur more than once; time is not looked at."""
    return events.groupBy("title", "date").agg(n_rows().alias("count")).filter("count > 1")


def recurring_titles(events: DataFrame, as_of: str) -> DataFrame:
    counts = upcoming(events, as_of).groupBy("title").agg(n_rows().alias("count"))
    return counts.filter("count > 1").orderBy(F.desc("count"), "title")
