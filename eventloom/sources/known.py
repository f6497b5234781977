"""What an ingest has to know of stored events, laid out so that a batch reads only what its own rows can meet.

Two events can be duplicates if they share their link or their date. Events lie by date, so titles are read from the batch's dates
alone; links are kept beside them in ``seen_links``, by hash bucket, for ever: a link is refused after any delay. The highest id given
out is kept in ``last_ids``, a row for each run. So what a batch reads does not grow with the events of other dates
and links of other buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..session import cut_lineage
from .store import events_on, exists, overwrite_folders, read_folders, read_table

LINK_BUCKETS = 1024
_LINKS = "id BIGINT, link STRING, bucket INT, batch STRING"
_LAST = "last_id BIGINT, batch STRING"


def link_bucket(link: Column) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(LINK_BUCKETS)).cast("int")


def _other_batches(rows: DataFrame, batch: str | None) -> DataFrame:
    """Without what an earlier attempt of the same micro-batch has left."""
    return rows if batch is None else rows.filter(F.col("batch") != batch)


def seen_links(spark: SparkSession, root: str, rows: DataFrame, batch: str | None = None) -> DataFrame:
    """(id, link) of every stored link that may equal one of ``rows``: those of the same buckets, LINK_BUCKETS at most."""
    asked = rows.filter("link IS NOT NULL").select(link_bucket(F.col("link"))).distinct()
    buckets = [r[0] for r in asked.collect()]
    found = read_folders(spark, f"{root}/seen_links", _LINKS, "bucket", buckets)
    return _other_batches(found, batch).select("id", "link")


def _with_folders(rows: DataFrame, batch: str) -> DataFrame:
    links = rows.filter("link IS NOT NULL").select("id", "link")
    return links.withColumns({"bucket": link_bucket(F.col("link")), "batch": F.lit(batch)}).hint("rebalance", "bucket")


def add_links(rows: DataFrame, root: str, batch: str) -> None:
    """Keeps the links of ``rows`` (id, link); a micro-batch that is run again replaces its own."""
    overwrite_folders(_with_folders(rows, batch), f"{root}/seen_links", "bucket", "batch")


def append_links(rows: DataFrame, root: str, batch: str) -> None:
    _with_folders(rows, batch).write.mode("append").partitionBy("bucket", "batch").parquet(f"{root}/seen_links")


def first_of_links(rows: DataFrame, root: str, order: str, batch: str | None = None) -> DataFrame:
    """Rows whose link was never stored, the first by ``order`` of each new link; rows without a link are all kept."""
    linked = rows.filter("link IS NOT NULL")
    fresh = keep_first(linked, ["link"], order).join(seen_links(rows.sparkSession, root, linked, batch).select("link"), "link", "left_anti")
    return rows.filter("link IS NULL").unionByName(fresh.select(*rows.columns))


def known_events(spark: SparkSession, root: str, rows: DataFrame, batch: str | None = None) -> DataFrame:
    """(id, title, date, link) of stored events that ``rows`` (date, link) may duplicate: all of their dates, and links of their buckets."""
    dates = [r[0] for r in rows.filter("date IS NOT NULL").select("date").distinct().collect()]
    same_day = _other_batches(events_on(spark, root, dates), batch).select("id", "title", "date", "link")
    links = seen_links(spark, root, rows, batch)
    nothing = F.lit(None).cast("string")
    return same_day.unionByName(links.select("id", nothing.alias("title"), nothing.alias("date"), "link"))


def last_id(spark: SparkSession, root: str, batch: str | None = None) -> int:
    """The highest id given out; from the events themselves where no run has left a record."""
    if exists(spark, f"{root}/last_ids"):
        kept = _other_batches(spark.read.schema(_LAST).parquet(f"{root}/last_ids"), batch)
        top = kept.agg(F.max("last_id")).head()[0]
        if top is not None:
            return top
    return _other_batches(read_table(spark, root, "events", "batch"), batch).agg(F.coalesce(F.max("id"), F.lit(0))).head()[0]


def reserve_ids(spark: SparkSession, root: str, top: int, batch: str) -> None:
    """Records the highest id before its rows are written; a run that fails in between leaves a gap, never a repeated id."""
    row = spark.range(1).select(F.lit(top).cast("bigint").alias("last_id"), F.lit(batch).alias("batch"))
    overwrite_folders(row, f"{root}/last_ids", "batch")


def rebuild_known(spark: SparkSession, root: str, batch: str = "rebuilt") -> None:
    """Links and last id from the stored events, e.g. after a restore or for events that another writer stored."""
    events = cut_lineage(read_table(spark, root, "events").select("id", "link"))
    writer = _with_folders(events, batch).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("bucket", "batch").parquet(f"{root}/seen_links")
    top = events.agg(F.coalesce(F.max("id"), F.lit(0))).head()[0]
    row = spark.range(1).select(F.lit(top).cast("bigint").alias("last_id"), F.lit(batch).alias("batch"))
    row.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(f"{root}/last_ids")
