"""Incremental jobs. Each is a stream over new files that stops when it has caught up, or keeps running."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import accept_in_order
from ..operators.enhance import content_of, default_content, enhance, enhancement_queue, tags_of
from ..operators.validation import rejected_rows, valid_rows, validate
from ..plans.ingest import new_events
from ..schema import RAW_EVENTS
from ..session import cut_lineage
from ..sources.known import add_links, first_of_links, known_events, last_id, reserve_ids
from ..sources.store import FOLDERS, append_rows, overwrite_folders, read_table, replace_rows, rows_of_ids

INCOMING = f"position BIGINT, {RAW_EVENTS}"


def read_incoming(spark: SparkSession, path: str, schema: str = INCOMING, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def _name(number: int) -> str:
    return f"{number:09d}"


def _write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Each micro-batch owns one folder and overwrites it when it is run again."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def ingest_stream(incoming: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Validates each micro-batch, refuses duplicates of stored and earlier rows, appends the rest.

    Writes the tables under ``root``: ``events``, ``enhanced_content`` (the default row of each new event) and ``scraping_history``, and
    beside them ``rejects`` and what ``sources.known`` keeps. A micro-batch reads events of its own dates and links of its own buckets
    only; one that is run again does not see its earlier attempt and replaces it.
    """

    def ingest(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, _name(number)
        checked = cut_lineage(validate(batch))
        valid = valid_rows(checked, "position")
        accepted = accept_in_order(valid.withColumnRenamed("position", "id"), known_events(spark, root, valid, name))
        accepted = cut_lineage(accepted.withColumnRenamed("id", "position"))
        top, added = last_id(spark, root, name), accepted.count()
        reserve_ids(spark, root, top + added, name)
        fresh = cut_lineage(new_events(accepted, top, "position", F.current_timestamp()))
        overwrite_folders(fresh.withColumn("batch", F.lit(name)), f"{root}/events", *FOLDERS["events"])
        add_links(fresh, root, name)
        _write_batch(rejected_rows(checked), f"{root}/rejects", number)
        ids = fresh.select(F.col("id").alias("event_id"))
        append_rows(default_content(fresh, rows_of_ids(spark, root, "enhanced_content", ids)), root, "enhanced_content")
        now = F.current_timestamp()
        run = spark.range(1).select(
            F.lit(number + 1).cast("bigint").alias("id"),
            now.alias("start_time"),
            now.alias("end_time"),
            F.lit(added).cast("bigint").alias("events_scraped"),
            F.lit("success").alias("status"),
            F.lit(None).cast("string").alias("error_message"),
        )
        _write_batch(run, f"{root}/scraping_history", number)

    writer = incoming.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "events")


def run_history(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "scraping_history")


def first_links_stream(
    incoming: DataFrame, root: str, checkpoint: str, order: str = "position", available_now: bool = True
) -> StreamingQuery:
    """Rows whose link comes for the first time ever go to ``root/first_links``; a repeated link is refused after any delay.

    Keys are kept in ``root/seen_links``, and a micro-batch reads the buckets of its own links. Of a link's rows in one micro-batch the
    first by ``order`` stays; rows without a link all do. The stream yields what ``merge.insert_if_absent`` yields on all rows in turn.
    """

    def take(batch: DataFrame, number: int) -> None:
        name = _name(number)
        fresh = cut_lineage(first_of_links(batch, root, order, name))
        _write_batch(fresh, f"{root}/first_links", number)
        add_links(fresh.withColumn("id", F.col(order)), root, name)

    writer = incoming.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def enhance_waiting_stream(events: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Enhances the streamed events that still wait for it: those whose stored content has no description.

    Each micro-batch is held against the stored content of its own ids, so an event that comes again, or whose content another job has
    written meanwhile, is left alone. Content and tags of the others take the place of their default rows.
    """

    def fill(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(["id"])
        stored = rows_of_ids(spark, root, "enhanced_content", rows.select(F.col("id").alias("event_id")))
        fresh = cut_lineage(enhance(enhancement_queue(rows, stored)))
        # Tags first: content with a description is what marks an event as done.
        replace_rows(spark, root, "event_tags", tags_of(fresh))
        replace_rows(spark, root, "enhanced_content", content_of(fresh))

    writer = events.writeStream.foreachBatch(fill).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def enhance_stream(events: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Stateless: every new event is enhanced once and appended."""
    writer = (
        content_of(enhance(events))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def distinct_links(incoming: DataFrame, arrival: str = "arrived_at", delay: str = "1 day") -> DataFrame:
    """Streaming rows with a link not seen within ``delay``; the state of older links is dropped."""
    return incoming.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(["link"])
