"""Entry points over the stored tables: one function per command of the application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as a
from ..operators import conflicts, enhance, export, filters, integrity
from ..operators.merge import absent_rows, number_rows
from ..sinks import files
from ..sources.store import append_rows, load_tables, replace_rows
from ..session import cut_lineage
from ..vocab import SEED_CATEGORIES
from .recommend import recommendations, severity_counts, with_recommendation


def init_tables(spark: SparkSession, root: str) -> None:
    """Adds the seed categories that are not stored yet."""
    categories = load_tables(spark, root, register=False)["categories"]
    seeds = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(SEED_CATEGORIES, 1)], "position BIGINT, name STRING, description STRING"
    )
    top = categories.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    rows = number_rows(seeds, "position", "number").withColumn("id", F.col("number") + top)
    append_rows(absent_rows(categories, rows, ["name"], "position"), root, "categories")


def list_upcoming(spark: SparkSession, root: str, as_of: str, limit: int | None = 10, **options) -> DataFrame:
    tables = load_tables(spark, root, register=False)
    return filters.list_display(
        filters.list_events(tables["events"], tables["enhanced_content"], as_of, limit, **options)
    )


def show_event(spark: SparkSession, root: str, event_id: int) -> DataFrame:
    """Detail, tags and stored recommendation of one event; empty when there is no such event."""
    tables = load_tables(spark, root, register=False)
    event = filters.by_id(tables["events"], event_id)
    detail = enhance.event_detail(event, tables["enhanced_content"], tables["event_tags"])
    advice = with_recommendation(event, tables["event_recommendations"]).select(
        "id", "severity", "conflict_type", "recommended_action", "alternative_times", "details"
    )
    return detail.join(advice, "id", "left")


def basic_analysis(events: DataFrame, year: int) -> dict[str, DataFrame]:
    return {
        "top_locations": a.top_locations(events),
        "day_distribution": a.weekday_distribution(events),
        "month_distribution": a.month_distribution(events, year),
        "time_specifications": a.share_of_total(a.time_specification(events)),
    }


def enhanced_analysis(events: DataFrame, content: DataFrame) -> dict[str, DataFrame]:
    return {
        "building_usage": a.building_utilisation(a.building_counts(events)),
        "recurring_patterns": a.frequent_types(content),
        "insights": a.insights(events, content),
    }


def detect_conflicts(events: DataFrame, as_of: str) -> dict[str, DataFrame]:
    return {
        "venue": conflicts.venue_conflicts(events, as_of),
        "building": conflicts.building_conflicts(events, as_of),
        "recurring": conflicts.recurring_conflicts(events, as_of),
        "events": conflicts.event_conflicts(events, as_of),
        "summary": conflicts.conflict_summary(events, as_of),
    }


def generate_recommendations(spark: SparkSession, root: str, as_of: str) -> dict[str, int]:
    """Stores a fresh recommendation per upcoming event; returns the counters."""
    tables = load_tables(spark, root, register=False)
    replace_rows(spark, root, "event_recommendations", recommendations(tables["events"], as_of))
    fresh = load_tables(spark, root, register=False)["event_recommendations"]
    current = filters.upcoming(tables["events"], as_of).select(F.col("id").alias("event_id"))
    return severity_counts(fresh.join(current, "event_id", "left_semi")).first().asDict()


def enhance_all(spark: SparkSession, root: str) -> int:
    """Enhances the events still waiting for it; returns how many."""
    tables = load_tables(spark, root, register=False)
    queue = enhance.enhancement_queue(tables["events"], tables["enhanced_content"])
    fresh = cut_lineage(enhance.enhance(queue))
    replace_rows(spark, root, "enhanced_content", enhance.content_of(fresh))
    replace_rows(spark, root, "event_tags", enhance.tags_of(fresh))
    return fresh.count()


def export_csv(spark: SparkSession, root: str, path: str, as_of: str, single_file: bool = False, **options) -> int:
    tables = load_tables(spark, root, register=False)
    rows = export.export_rows(tables["events"], as_of, tables["enhanced_content"], tables["event_tags"], **options)
    return files.write_csv(rows, path, single_file)


def export_ical(spark: SparkSession, root: str, path: str, as_of: str, single_file: bool = False, **options) -> int:
    tables = load_tables(spark, root, register=False)
    entries = export.vevents(tables["events"], tables["enhanced_content"], as_of, **options)
    return files.write_calendars(entries, path, single_file=single_file)


def export_event_ical(spark: SparkSession, root: str, path: str, as_of: str, event_id: int) -> bool:
    """One event; False when it is unknown or past."""
    return export_ical(spark, root, path, as_of, single_file=True, event_ids=[event_id]) > 0


def export_statistics(events: DataFrame, content: DataFrame, as_of: str) -> dict[str, DataFrame]:
    return {
        "total": a.totals(events, as_of).select("upcoming_events"),
        "by_type": a.upcoming_by_type(events, content, as_of),
        "by_month": a.upcoming_by_month(events, as_of),
    }


def check_tables(spark: SparkSession, root: str, as_of: str) -> dict[str, DataFrame]:
    tables = load_tables(spark, root, register=False)
    return {
        "health": integrity.health(tables["events"], as_of),
        "constraints": integrity.constraint_report(tables),
    }
