import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions import features, words
from eventloom.functions.text import unicode_pattern
from eventloom.functions.words import words_in
from eventloom.operators import export
from eventloom.operators.enhance import enhance


@pytest.mark.parametrize("words", [["a", "ab", "ba", "bab", "é"], ["theater", "theatre", "at", "heat", "he"], ["x"]])
def test_matches_a_search_for_each_word(spark, words):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abéx ther") for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [None, "", "the theatre", "\x00a", "b" * 100_000 + "ab", *words]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    found = {r.id: r.found for r in rows.select("id", words_in(F.col("text"), words).alias("found")).collect()}
    assert found == {i: [w for w in words if text and w in text] for i, text in enumerate(texts)}


def test_no_words_and_no_rows(spark):
    rows = spark.createDataFrame([("a",), (None,)], "text STRING")
    assert [r.found for r in rows.select(words_in(F.col("text"), []).alias("found")).collect()] == [[], []]
    assert rows.limit(0).select(words_in(F.col("text"), ["a"]).alias("found")).collect() == []


def test_texts_are_read_once_and_only_when_words_are_asked_for(make_events, capsys):
    events = make_events(("Art Party", "2025-01-01", "10:00", "Hall", "at the gym"))
    enhance(events, one_pass=True).select("event_type", "tags").explain("simple")
    # Once as a node of the plan; types and tags share its result.
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    enhance(events, one_pass=True).select("title_suggestions", "missing_details").explain("simple")
    assert "ArrowEvalPython" not in capsys.readouterr().out


def test_types_and_tags_of_no_words(spark):
    row = spark.range(1).select(words_in(F.lit(None).cast("string"), features.KEYWORDS).alias("found"))
    out = row.select(features.event_types(F.col("found")).alias("kind"), features.tags(F.col("found")).alias("tags")).first()
    assert (out.kind, out.tags) == ("General Event", [])


def test_both_ways_agree(spark, make_events):
    texts = ["Evening lecture in the THEATRE lab", "plazaquad", "", None, "AM classroom", "ſtudent İ KELVIN club"]
    events = make_events(*[(text or "none", "2025-01-01", "10:00", "Hall", text) for text in texts])
    assert enhance(events).orderBy("event_id").collect() == enhance(events, one_pass=True).orderBy("event_id").collect()


def test_look_ahead_loses_no_mention(spark):
    ends = ["room 5", "Hall B", "cLassRoom İx", "laboratory 9 east", "lab  7", "Fİeld 3", "fıeld 3", "commonſ 2", "gym", "qu ad 1"]
    dates = ["Jan 5", "January 12th", "May 3rd", "Sept 4", "Sep 4", "jan 5", "Dec  31st", "March 1", "Marsh 1", "Nov 2"]
    texts = [f"x{e} {d}{e}" for e in ends for d in dates]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    words = "|".join(vocab.LOCATION_KEYWORDS)
    places = unicode_pattern(f"(?iu)(?:{words}){vocab.LOCATION_TAIL}")
    plain = [F.regexp_extract_all("t", F.lit(unicode_pattern(p)), 0) for p in vocab.TIME_PATTERNS]
    out = rows.select(
        features.location_mentions(F.col("t")).alias("place"),
        F.array_join(F.regexp_extract_all("t", F.lit(places), 0), ", ").alias("plain_place"),
        features.time_mentions(F.col("t")).alias("time"),
        F.array_join(F.concat(*plain), ", ").alias("plain_time"),
    ).collect()
    assert all(r.place == r.plain_place and r.time == r.plain_time for r in out)
    assert sum(r.place != "" for r in out) > 50 and sum(r.time != "" for r in out) > 50


def test_words_near_mentions_hold_all_of_them(spark):
    rng = random.Random(5)
    spaces = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "　", "\x85", ""]
    bits = ["5", "12:30", "٣", "१२", "５", "𝟙", "to", "-", "PM", "am", "Jan", "xMay", "December", "3rd", "1/2/2024", "1/2", "the", "thea", "–", "é", "|", "日本", "İ"]
    bits += [*vocab.LOCATION_KEYWORDS, "ROOM", "buİlding", "lıbrary", "commonſ", "Hall-", "xgym", "roo", "a-b", "word", "über", "ſ", "€"]
    texts = ["".join(rng.choice(bits) + rng.choice(spaces) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [None, "", " ", "5", "room", " 5 pm", "word " * 60_000 + "Hall 7 b c", "ro", "om 5 am", "at 5", "to 6 PM", "x" * 300_000 + " gym 1"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING").coalesce(2)
    told = rows.select("id", "t", features.near_mentions(features.said(F.col("t"))).alias("near"))
    ways = [features.time_mentions, features.location_mentions, features.names_time, features.names_place]
    text = features.said(F.col("t"))
    out = told.select("near", *[way(col).alias(f"{side}{i}") for i, way in enumerate(ways) for side, col in (("a", text), ("b", F.col("near")))])
    out = out.collect()
    assert all(r[f"a{i}"] == r[f"b{i}"] for r in out for i in range(4))
    assert sum(r.a0 != "" for r in out) > 500 and sum(r.a1 != "" for r in out) > 500
    assert [r.near for r in out[-6:]] == ["Hall 7 b c", "ro", "om 5 am", "at 5", "to 6 PM", "gym 1"]


def test_long_ways_agree_on_odd_letters(make_events):
    texts = ["SİGN-UP \u212aFREE gym 3", "\u212aeY COST", "ΟΔΟΣ CLUB", "e\u0130mail", "ROOM  \u00a05", "sign", "up", "Ǆ rsvp İ", "@", "$"]
    events = make_events(*[(a, "2025-01-01", "10:00", "Hall", b) for a in texts for b in texts])
    assert enhance(events).orderBy("event_id").collect() == enhance(events, one_pass=True).orderBy("event_id").collect()


def test_digits_of_all_scripts_are_told_by_their_first_bytes():
    everything = "".join(map(chr, range(128, sys.maxunicode + 1)))
    assert {digit.encode()[0] for digit in re.findall(r"\d", everything)} == set(words.DIGIT_BYTES)


def test_the_words_around_a_mention_are_left(spark):
    text = "Join us all here on January 5 at the Big hall of the old town, next to many others who come"
    row = spark.range(1).select(features.near_mentions(F.lit(text)).alias("near")).first()
    assert row.near == "January 5 at the Big hall of the |"


def test_long_texts_are_read_by_no_pattern_of_the_jvm(make_events, capsys):
    events = make_events(("Art Party", "2025-01-01", "10:00", "Hall", "at the gym"))
    export.enhanced_export_rows(events, "2024-01-01").explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") and "regexp_extract_all(near" in plan and "regexp_extract_all(coalesce(description" not in plan
    assert "Contains(lower(coalesce(description" not in plan and "RLIKE" in plan
