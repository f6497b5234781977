"""Adapter: the test tables in the shape of the event tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KIND_TITLES = {
    "signup": "Career Resume Workshop",
    "error": "Study Skills Seminar",
    "click": "Club Mixer",
    "view": "Art Exhibition",
}
TEXT_COLUMNS = {"title", "description"}
#: A title takes words from the first so many of its document.
TITLE_WORDS = 8
#: Events whose texts one task meets.
TASK_EVENTS = 10_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text``, dealt out: the table is a single file; what is done with the texts should not be left to one task."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return texts.repartition(spark.sparkContext.defaultParallelism)


def campus_events(
    spark: SparkSession,
    sf_dir: str,
    *columns: str,
    since: str | None = None,
    until: str | None = None,
    first: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Events view over ``events`` and ``documents``.

    ``columns`` limits the output; the documents side is read only when a text column is asked for (event n has document n modulo
    the number of documents, so leaving the left join out changes no row). ``since`` is a date before which, ``until`` one from which
    on the caller wants no rows; both reach the scan. ``first`` is what the caller does to the rows before texts are fetched, a filter or a
    join: it is given the wanted columns but title and description, and columns that it adds are passed on.
    """
    wanted = columns or ("id", "title", "description", "date", "time", "location", "link")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    if since:
        events = events.filter(F.col("ts") >= F.lit(since).cast(events.schema["ts"].dataType))
    if until:
        events = events.filter(F.col("ts") < F.lit(until).cast(events.schema["ts"].dataType))
    id_, user = F.col("event_id"), F.col("user_id")
    clock = F.concat(
        F.lpad(F.hour("ts").cast("string"), 2, "0"), F.lit(":"), F.lpad(F.minute("ts").cast("string"), 2, "0")
    )
    place = id_ % 8
    location = (
        F.when(place == 0, F.lit(None).cast("string"))
        .when(place == 1, F.concat(F.lit("Student Center Room "), (user % 9).cast("string")))
        .when(place == 2, F.concat(F.lit("Building "), (user % 30 + 10).cast("string"), F.lit(", Room 1")))
        .when(place == 3, F.lit("Virtual"))
        .otherwise(
            F.concat(F.lit("Bldg "), (user % 40).cast("string"), F.lit(", Room "), (user % 7).cast("string"))
        )
    )
    link_id = F.when(id_ % 50 == 0, id_ + 1).otherwise(id_)
    projections = {
        "id": id_,
        "date": F.to_date("ts").cast("string"),
        "time": F.when(id_ % 10 != 0, clock),
        "location": location,
        "link": F.concat(F.lit("https://campus.example.edu/event/"), link_id.cast("string")),
    }
    needs_text = TEXT_COLUMNS & set(wanted)
    # The tables are single files; what is done with the texts should not be left to one task.
    tasks = -(-events.count() // TASK_EVENTS) if needs_text else 0
    added = []
    if first:
        own = [c for c in wanted if c in projections]
        rows = first(events.select(F.struct("*").alias("given"), *[projections[c].alias(c) for c in own]))
        added = [c for c in rows.columns if c not in (*own, "given")]
        events = rows.select("given.*", *[F.col(c).alias(f"added_{c}") for c in added])
    if needs_text:
        documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        n = documents.count()
        events = events.withColumn("own", F.col("event_id") % n)
        cores = spark.sparkContext.defaultParallelism
        if "description" not in wanted:
            # No whole text is shuffled for a title.
            documents = documents.withColumn("text", F.substring_index("text", " ", TITLE_WORDS))
            events = events.repartition(cores)
        elif tasks > 4 * cores and n > 10 * tasks:
            # Joined texts are many times what was shuffled for them: tasks are as many as the events ask for, not the shuffled bytes.
            documents = documents.repartition(tasks, "doc_id")
            events = events.repartition(tasks, "own")
        else:
            events = events.repartition(cores)
        events = events.join(documents, F.col("own") == F.col("doc_id"), "left")
    text = F.col("text") if needs_text else F.lit(None).cast("string")
    kind = F.lit("Basketball Game")
    for name, title in KIND_TITLES.items():
        kind = F.when(F.col("event_type") == name, F.lit(title)).otherwise(kind)
    # A whole text would be split at all its blanks.
    head = F.substring_index(text, " ", TITLE_WORDS)
    word = lambda place: F.split_part(head, F.lit(" "), place.cast("int"))
    title = (
        F.when(id_ % 97 == 0, F.lit("Gala"))
        .when(id_ % 101 == 0, F.concat(F.repeat(F.concat(kind, F.lit(" and ")), F.lit(6)), F.lit("more")))
        .when(id_ % 3 == 0, kind)
        .otherwise(F.concat(kind, F.lit(" "), word(id_ % 5 + 1), F.lit(" "), word(id_ % 7 + 2)))
    )
    description = F.when(
        id_ % 6 != 0,
        F.concat(
            F.lit("Join us on January "),
            F.dayofmonth("ts").cast("string"),
            F.lit(" at "),
            (id_ % 11 + 1).cast("string"),
            F.lit(":30 PM in Room "),
            user.cast("string"),
            F.when(id_ % 4 == 0, F.lit(" free, rsvp or email us. ")).otherwise(F.lit(". ")),
            text,
        ),
    )
    projections |= {"title": title, "description": description}
    return events.select(*[projections[name].alias(name) for name in wanted], *[F.col(f"added_{c}").alias(c) for c in added])
