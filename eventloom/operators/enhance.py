"""Enhanced content of events: description, structured fields, type, score, tags, suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import features as f
from ..functions.words import words_in
from .late import Reader, split_by_id


def enhance(
    events: DataFrame, footer: str = vocab.FOOTER, keep: tuple[str, ...] = (), one_pass: bool = False
) -> DataFrame:
    """One narrow projection, no shuffle: id, content columns, ``tags`` and the two suggestion lists; ``keep`` are columns to pass on.

    ``one_pass`` reads long texts in Python workers: an automaton finds the words of types, tags and details, and patterns for times and
    places meet only the words near them. Who wants the suggestions alone needs no worker for them.
    """
    title, description = F.col("title"), F.col("description")
    given = events.select("id", "title", "description", *[c for c in keep if c not in ("id", "title", "description")])
    if one_pass:
        # No keyword holds a blank, so none spans title and description. All that read the description share one copy sent.
        read = given.select(
            "*",
            words_in(f.said(title), f.KEYWORDS, any_case=True).alias("in_title"),
            words_in(f.said(description), f.ALL_WORDS, any_case=True).alias("in_description"),
            f.near_mentions(f.said(description)).alias("near"),
        ).withColumn("found", F.array_union("in_title", "in_description"))
        suggested = F.size(f.description_suggestions(description, F.col("near"), F.col("in_description")))
    else:
        read = given.select("*", f.keywords(title, description).alias("found"), f.said(description).alias("near"))
        suggested = F.size("missing_details")
    typed = read.select(
        "*",
        f.time_mentions(F.col("near")).alias("structured_time"),
        f.location_mentions(F.col("near")).alias("structured_location"),
        f.event_types(F.col("found")).alias("event_type"),
        f.title_suggestions(title).alias("title_suggestions"),
        f.description_suggestions(description).alias("missing_details"),
    )
    when_text, where_text = F.col("structured_time"), F.col("structured_location")
    return typed.select(
        F.col("id").alias("event_id"),
        f.enhanced_text(description, when_text, where_text, F.col("event_type"), footer).alias(
            "enhanced_description"
        ),
        "structured_time",
        "structured_location",
        "event_type",
        f.seo_score(title, description, F.size("title_suggestions"), suggested).alias("seo_score"),
        "missing_details",
        "title_suggestions",
        f.tags(F.col("found")).alias("tags"),
        *keep,
    )


CONTENT_COLUMNS = [
    "event_id",
    "enhanced_description",
    "structured_time",
    "structured_location",
    "event_type",
    "seo_score",
    "missing_details",
]


def content_of(enhanced: DataFrame) -> DataFrame:
    return enhanced.select(*CONTENT_COLUMNS)


def tags_of(enhanced: DataFrame) -> DataFrame:
    return enhanced.select("event_id", F.explode("tags").alias("tag"))


def enhancement_queue(events: DataFrame | Reader, content: DataFrame) -> DataFrame:
    """Events without content, or whose enhanced description is still missing. A reader fetches the texts of these alone."""
    done = content.filter("enhanced_description IS NOT NULL").select(F.col("event_id").alias("id"))
    wait = lambda rows: rows.join(done, "id", "left_anti")
    return (events(wait) if callable(events) else wait(events)).select("id", "title", "description")


def tag_text(tags: DataFrame, separator: str = ", ") -> DataFrame:
    """Tags of each event, sorted and joined; grouped before any wide row is touched."""
    return tags.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("tag")), separator).alias("tags"))


def event_detail(events: DataFrame, content: DataFrame, tags: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Events with content and tag list, one row per event.

    ``own``: rows of ``enhance`` that kept the events' columns, for further events whose id no other row has. Their content stands
    beside them, so their texts are not shuffled.
    """
    columns = ["id", "title", "description", "date", "time", "location", *CONTENT_COLUMNS[1:], "tags"]
    detail = (
        events.join(content.withColumnRenamed("event_id", "id"), "id", "left")
        .join(tag_text(tags, ",").withColumnRenamed("event_id", "id"), "id", "left")
        .select(*columns)
    )
    if own is None:
        return detail
    text = F.when(F.size("tags") > 0, F.array_join(F.array_sort(F.array_distinct("tags")), ","))
    return own.withColumnRenamed("event_id", "id").withColumn("tags", text).select(*columns).unionByName(detail)


def key_element_report(events: DataFrame) -> DataFrame:
    """Title and description sentences of the word-list check, exploded with their position."""
    title, description = F.col("title"), F.col("description")
    sentences = F.concat(
        f.title_suggestions(title, vocab.TITLE_NO_NUMBER), f.key_element_suggestions(description)
    )
    return events.select("id", F.posexplode(sentences).alias("pos", "suggestion"))


def feature_bundle(events: DataFrame | Reader, keywords: DataFrame, one_pass: bool = False) -> DataFrame:
    """Description, tags, suggestions and key terms of every event in one row.

    ``keywords`` holds (id, keywords ARRAY<STRING>), e.g. from ``keywords.key_terms``; ``one_pass`` as in ``enhance``. A reader
    fetches texts after the key terms are joined; where an id comes once all stands in one row, so no text is shuffled by its id.
    """
    once, again = split_by_id(events) if callable(events) else (None, events)
    sentences = [
        f.title_suggestions(F.col("title"), vocab.TITLE_NO_NUMBER).alias("title_suggestions"),
        f.key_element_suggestions(F.col("description")).alias("description_suggestions"),
    ]
    columns = ["id", "title_suggestions", "description_suggestions", "enhanced_description", "tags", "keywords"]
    content = enhance(again, one_pass=one_pass).withColumnRenamed("event_id", "id").select("id", "enhanced_description", "tags")
    bundle = again.select("id", *sentences).join(content, "id").join(keywords, "id", "left").select(*columns)
    if once is not None:
        known = once(lambda rows: rows.join(keywords, "id", "left"))
        own = enhance(known, keep=("title", "description", "keywords"), one_pass=one_pass).withColumnRenamed("event_id", "id")
        bundle = own.select("id", *sentences, "enhanced_description", "tags", "keywords").unionByName(bundle)
    hint = F.when(
        F.size("keywords") > 0, F.array(F.concat(F.lit(vocab.KEYWORD_HINT), F.array_join("keywords", ", ")))
    ).otherwise(F.array().cast("array<string>"))
    return bundle.withColumns({"general_suggestions": hint, "tags": f.tag_slugs(F.col("tags"))})


def default_content(events: DataFrame, content: DataFrame) -> DataFrame:
    """A zero-score row for each event that has no content row yet."""
    new = events.select(F.col("id").alias("event_id")).join(content.select("event_id"), "event_id", "left_anti")
    no_text = F.lit(None).cast("string")
    return new.select(
        "event_id",
        *[no_text.alias(c) for c in CONTENT_COLUMNS[1:5]],
        F.lit(0).alias("seo_score"),
        F.lit(None).cast("array<string>").alias("missing_details"),
    )
