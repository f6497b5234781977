"""File sinks written from the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.export import vevent_text, with_headers
from ..schema import TABLES
from ..sources.known import rebuild_known
from ..sources.store import append_rows, load_tables, read_table, write_table


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> int:
    """Writes the export layout with its headers; returns the row count and writes nothing when there is no row."""
    if rows.isEmpty():
        return 0
    laid_out = with_headers(rows)
    # The rows come range-partitioned by their sort; counting above that exchange meets each row once.
    counted, seen = _counted(laid_out.coalesce(1) if single_file else laid_out)
    # Quotes are doubled and line breaks kept inside quoted fields, as spreadsheet readers expect.
    counted.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return seen.get["rows"]


CALENDAR_NAME = "Campus Events"


def calendar_header(name: str = CALENDAR_NAME, product: str = "Event Manager") -> str:
    return "\r\n".join(
        [
            "BEGIN:VCALENDAR",
            f"PRODID:-//{product}//EN",
            "VERSION:2.0",
            "CALSCALE:GREGORIAN",
            "METHOD:PUBLISH",
            f"X-WR-CALNAME:{name}",
            f"X-WR-CALDESC:Events from {product}",
        ]
    )


def write_calendars(
    entries: DataFrame, path: str, stamp: Column | None = None, name: str = CALENDAR_NAME, single_file: bool = False
) -> int:
    """One complete calendar per written part; returns the number of entries written.

    Entries are range-partitioned by date and time, so each part is a calendar of consecutive dates and one
    busy date may span several parts.
    """
    if entries.isEmpty():
        return 0
    blocks = vevent_text(entries, stamp if stamp is not None else F.current_timestamp())
    placed = blocks.repartition(1) if single_file else blocks.repartitionByRange("date", "time", "id")
    # Counted after the range partitioning, whose sampling pass reads the rows once more.
    counted, seen = _counted(placed)
    header, footer = calendar_header(name), "END:VCALENDAR\r"

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = False
        for batch in batches:
            if not opened and len(batch):
                yield pd.DataFrame({"value": [header + "\r"]})
                opened = True
            yield pd.DataFrame({"value": batch["body"] + "\r"})
        if opened:
            yield pd.DataFrame({"value": [footer]})

    ordered = counted.sortWithinPartitions("date", "time", "id").select("body")
    ordered.mapInPandas(frame, "value string").write.mode("overwrite").text(path)
    return seen.get["rows"]


def write_rejects(rejects: DataFrame, path: str) -> bool:
    """Quarantined rows of one run as JSON lines, in place of those it wrote before; no folder when there are none."""
    if rejects.isEmpty():
        return False
    rejects.write.mode("overwrite").json(path)
    return True


def append_history(spark: SparkSession, root: str, events_scraped: int, stamp: Column | None = None) -> None:
    """One run record: start = end = stamp, status success."""
    now = stamp if stamp is not None else F.current_timestamp()
    run = spark.range(1).select(
        F.lit(None).cast("bigint").alias("id"),
        now.alias("start_time"),
        now.alias("end_time"),
        F.lit(events_scraped).cast("bigint").alias("events_scraped"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    history = read_table(spark, root, "scraping_history")
    next_id = history.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).scalar()
    append_rows(run.withColumn("id", next_id).select(*history.columns), root, "scraping_history")


def snapshot(spark: SparkSession, root: str, name: str) -> str:
    """Copies every table to ``root/snapshots/name``."""
    folder = f"{root}/snapshots/{name}"
    for table, df in load_tables(spark, root, register=False).items():
        df.write.mode("overwrite").parquet(f"{folder}/{table}")
    return folder


def restore(spark: SparkSession, root: str, name: str) -> None:
    """Every table becomes what its snapshot holds, and what is known of links follows; nothing is written if any schema differs.

    The snapshot stays: a restore that fails on its way is repeated.
    """
    folder = f"{root}/snapshots/{name}"
    saved = {table: spark.read.parquet(f"{folder}/{table}") for table in TABLES}
    for table, df in saved.items():
        expected = spark.createDataFrame([], TABLES[table]).dtypes
        if df.dtypes != expected:
            raise ValueError(f"snapshot {name!r}: table {table} has columns {df.dtypes}, expected {expected}")
    for table, df in saved.items():
        write_table(df, root, table, name)
    rebuild_known(spark, root)
