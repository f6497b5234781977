"""Table checks and repair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REQUIRED_TABLES, TABLES
from .dedup import dedup_cleanup, duplicate_count

def n_rows() -> Column:
    return F.count(F.lit(1))


def orphans(child: DataFrame, events: DataFrame) -> DataFrame:
    """Child rows whose event is gone."""
    return child.join(events.select(F.col("id").alias("event_id")), "event_id", "left_anti")


def without_orphans(child: DataFrame, events: DataFrame) -> DataFrame:
    return child.join(events.select(F.col("id").alias("event_id")), "event_id", "left_semi")


def clean_orphans(children: dict[str, DataFrame], events: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Cleaned tables, and (table, removed) counts with a total row."""
    cleaned = {name: without_orphans(df, events) for name, df in children.items()}
    counts = [
        orphans(df, events).agg(F.lit(name).alias("table"), n_rows().alias("removed")) for name, df in children.items()
    ]
    per_table = reduce(DataFrame.unionByName, counts)
    total = per_table.agg(F.lit("total").alias("table"), F.sum("removed").alias("removed"))
    return cleaned, per_table.unionByName(total)


def cleanup_events(events: DataFrame, as_of: str) -> DataFrame:
    """Events from ``as_of`` on (rows without a date stay), duplicates removed."""
    return dedup_cleanup(events.filter(F.coalesce(F.col("date") >= as_of, F.lit(True))))


def cleanup_summary(events: DataFrame, as_of: str) -> DataFrame:
    """One row: past events removed, then duplicates removed from what is left."""
    past = events.agg(F.count_if(F.col("date") < as_of).alias("past_removed"))
    kept = events.filter(F.coalesce(F.col("date") >= as_of, F.lit(True)))
    return past.withColumn("duplicates_removed", duplicate_count(kept).scalar())


def health(events: DataFrame, as_of: str) -> DataFrame:
    """Past-event count and the repeated (title, date) groups, one line each."""
    past = events.agg(F.count_if(F.col("date") < as_of).alias("count")).select(
        F.lit("past_events").alias("check"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("date"),
        "count",
    )
    groups = events.groupBy("title", "date").agg(n_rows().alias("count")).filter("count > 1")
    return past.unionByName(groups.select(F.lit("duplicate").alias("check"), "title", "date", "count"))


def missing_tables(spark: SparkSession, present: list[str]) -> DataFrame:
    """Required tables that do not exist."""
    required = spark.createDataFrame([(t,) for t in REQUIRED_TABLES], "table STRING")
    found = spark.createDataFrame([(t,) for t in present], "table STRING")
    return required.join(found, "table", "left_anti")


# Constraints of the stored tables: (table, kind, columns, referenced table) - fixed values.
CONSTRAINTS = [
    ("events", "unique", ["id"], None),
    ("events", "not_null", ["title"], None),
    ("events", "unique", ["link"], None),
    ("categories", "unique", ["id"], None),
    ("categories", "not_null", ["name"], None),
    ("categories", "unique", ["name"], None),
    ("event_categories", "unique", ["event_id", "category_id"], None),
    ("event_categories", "foreign", ["event_id"], "events"),
    ("event_categories", "foreign", ["category_id"], "categories"),
    ("scraping_history", "not_null", ["start_time"], None),
    ("event_recommendations", "unique", ["event_id"], None),
    ("event_recommendations", "foreign", ["event_id"], "events"),
    ("enhanced_content", "unique", ["event_id"], None),
    ("enhanced_content", "foreign", ["event_id"], "events"),
    ("event_tags", "not_null", ["tag"], None),
    ("event_tags", "unique", ["event_id", "tag"], None),
    ("event_tags", "foreign", ["event_id"], "events"),
]


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint, violations) for every constraint of the tables given; a missing required table is a violation.

    ``unique`` counts the rows beyond the first of each non-NULL key.
    """
    lines = []
    for table, kind, columns, parent in CONSTRAINTS:
        if table not in tables or (parent and parent not in tables):
            continue
        rows = tables[table]
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        if kind == "not_null":
            found = rows.agg(F.count_if(~filled).alias("violations"))
        elif kind == "unique":
            extra = rows.filter(filled).groupBy(*columns).agg((n_rows() - 1).alias("extra"))
            found = extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
        else:
            keys = tables[parent].select(F.col("id").alias(columns[0]))
            found = rows.filter(filled).join(keys, columns[0], "left_anti").agg(n_rows().alias("violations"))
        name = f"{table}.{kind}({','.join(columns)})"
        lines.append(found.select(F.lit(name).alias("constraint"), "violations"))
    spark = next(iter(tables.values())).sparkSession
    absent = missing_tables(spark, [t for t in TABLES if t in tables]).select(
        F.concat(F.col("table"), F.lit(".present")).alias("constraint"), F.lit(1).cast("bigint").alias("violations")
    )
    return reduce(DataFrame.unionByName, lines).unionByName(absent)
