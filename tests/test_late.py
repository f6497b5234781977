"""Joins by id before texts are fetched: the rows of a plain join, and no text below a shuffle."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import enhance
from eventloom.operators.late import split_by_id

WHOLE = ("id", "title", "description", "date", "time", "location")


@pytest.fixture(scope="module")
def stored(spark):
    """Events 2 (twice, unlike) and two without an id beside single ones."""
    rows = [
        (n, i, f"Career Workshop {n}", "Join us at 5 PM in Room 7, rsvp. " * (n % 3), "2024-01-20", "10:00", "Hall")
        for n, i in enumerate([1, 2, 2, None, None, 3, 4])
    ]
    kind = "row INT, id BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING"
    return spark.createDataFrame(rows, kind)


def reader(stored):
    texts = stored.select("row", "title", "description")
    return lambda step: step(stored.drop("title", "description")).join(F.broadcast(texts), "row", "left").drop("row")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def joins(df):
    """Kinds of joins from the top down."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line.split("Join ")[1].split(",")[0] for line in plan.splitlines() if "Join " in line]


def detail(stored):
    enhanced = enhance.enhance(stored)
    return enhance.event_detail(stored, enhance.content_of(enhanced), enhance.tags_of(enhanced))


def late_detail(stored):
    once, again = split_by_id(reader(stored))
    enhanced = enhance.enhance(again)
    own = enhance.enhance(once(lambda rows: rows), keep=WHOLE[1:])
    return enhance.event_detail(again, enhance.content_of(enhanced), enhance.tags_of(enhanced), own)


def test_detail_of_repeated_and_missing_ids(stored):
    assert rows_of(late_detail(stored)) == rows_of(detail(stored))


def test_detail_joins_nothing_where_ids_come_once(stored):
    single = stored.filter("id IN (1, 3, 4)")
    assert rows_of(late_detail(single)) == rows_of(detail(single))
    assert joins(late_detail(single)) == ["LeftOuter"]


def test_queue_drops_rows_before_texts_are_fetched(stored):
    content = stored.filter("id IN (2, 3)").select(F.col("id").alias("event_id"), F.lit("done").alias("enhanced_description"))
    late = enhance.enhancement_queue(reader(stored), content)
    assert rows_of(late) == rows_of(enhance.enhancement_queue(stored, content))
    assert joins(late)[0] == "LeftOuter" and "LeftAnti" in joins(late)[1:]


def test_bundle_fetches_texts_after_key_terms(spark, stored):
    terms = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (2, ["c"]), (4, [])], "id BIGINT, keywords ARRAY<STRING>")
    assert rows_of(enhance.feature_bundle(reader(stored), terms)) == rows_of(enhance.feature_bundle(stored, terms))
    single = stored.filter("id IN (1, 3, 4)")
    late = enhance.feature_bundle(reader(single), terms)
    assert rows_of(late) == rows_of(enhance.feature_bundle(single, terms))
    assert joins(late) == ["LeftOuter", "LeftOuter"]
