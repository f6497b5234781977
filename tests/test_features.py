import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.catalog import queries as q
from eventloom.functions import features
from eventloom.functions.features import tag_slugs
from eventloom.functions.labels import building_label, names_a_building
from eventloom.operators import analytics as a
from eventloom.operators import enhance, keywords
from eventloom.operators.keywords import key_terms, keyword_lists

WORKSHOP = (
    "Student Leadership Workshop",
    "2025-11-15",
    "14:30",
    "Student Center Room 105",
    "Join us on November 15th at 2:30 PM in the Student Center Room 105 for an interactive workshop on leadership "
    "skills. Learn about team management, communication, and project planning.",
)


def seeds(make_events):
    return make_events(
        ("Registration Deadline", "2025-09-30 17:00:00", None, "Online/Student Services Building"),
        ("Basketball Game", "2025-10-15 19:00:00", None, "North Student Center Gym"),
        ("Art Exhibition", "2025-10-05 18:00:00", None, "Art Building Gallery"),
        ("Career Fair", "2025-11-01 10:00:00", None, "A. B. Founder Theater"),
    )


def test_workshop(spark, make_events):
    row = enhance.enhance(make_events(WORKSHOP)).first()
    assert row.structured_time == "2:30 PM, November 15th"
    assert row.structured_location == "Center Room 105"
    assert row.event_type == "Academic, Student Life"
    assert row.tags == ["academic", "afternoon", "center", "morning", "room", "student", "student_life", "workshop"]
    assert row.seo_score == 80
    text, details = row.enhanced_description.split("\n\n\nEvent Details:\n")
    assert text == WORKSHOP[4]
    assert details.split("\n") == [
        "When: 2:30 PM, November 15th",
        "Where: Center Room 105",
        "Event Type: Academic, Student Life",
        "",
        vocab.FOOTER.strip(),
    ]


def test_empty_text(spark, make_events):
    row = enhance.enhance(make_events(("Tea", "2025-11-15", None, None))).first()
    assert row.event_type == vocab.DEFAULT_EVENT_TYPE
    assert row.title_suggestions == [vocab.TITLE_SHORT, vocab.TITLE_NO_DATE]
    # -20 short title, -30 no description, -5 for each of two title and six description suggestions.
    assert len(row.missing_details) == 6 and row.seo_score == 10


def test_weekdays_months_and_times_of_seeds(spark, make_events):
    events = seeds(make_events)
    days = {r.day_of_week: r["count"] for r in a.weekday_distribution(events).collect()}
    assert days == {"Tuesday": 1, "Wednesday": 1, "Sunday": 1, "Saturday": 1}
    months = [(r.month, r["count"]) for r in a.month_distribution(events, 2025).collect()]
    assert months == [("September", 1), ("October", 2), ("November", 1)]
    assert [tuple(r) for r in a.time_specification(events).collect()] == [("No specific time", 4)]


def test_bad_dates_come_first(spark, make_events):
    rows = a.weekday_distribution(make_events(("A", None, None, None), ("B", "2025-03-02", None, None))).collect()
    assert [r.day_of_week for r in rows] == [None, "Sunday"]


def test_building_labels(spark, make_events):
    counts = {r.building: r["count"] for r in a.events_by_building(seeds(make_events)).collect()}
    assert counts == {"Bldg ": 1, "Bldg Ga": 1, "North Student Center Gym": 1}
    cases = {
        "Bldg 10, Room 5": "Bldg 10",
        "Bldg. 12, Rm 1": "Bldg. 12",
        "Building 1, Room 101": "Bldg 1,",
        "bldg 7": "bldg 7",
        "Gym": "Gym",
    }
    df = spark.createDataFrame(list(cases.items()), "location STRING, wanted STRING")
    assert df.filter(building_label(F.col("location")) != F.col("wanted")).count() == 0
    kept = df.filter(names_a_building(F.col("location"))).count()
    assert kept == 5


def test_fallback_to_location_classes(spark, make_events):
    events = make_events(("A", None, None, "Rm. 4 (east)"), ("B", None, None, "a/b"), ("C", None, None, "Rm. 5"))
    assert {r.building: r["count"] for r in a.building_counts(events).collect()} == {"Various Rooms": 2, "a/b": 1}


def test_utilisation(spark):
    counts = spark.createDataFrame([("A", 16), ("B", 13), ("C", 12), ("D", 1)], "building STRING, count BIGINT")
    rows = {r.building: (r.peak_times, r.utilization) for r in a.building_utilisation(counts).collect()}
    assert rows["A"] == (["Morning", "Afternoon"], 100.0)
    assert rows["B"] == (["Morning", "Afternoon"], 81.2)
    assert rows["C"] == (["Morning"], 75.0)
    assert rows["D"] == (["Variable"], 6.2)


def test_analysis_of_nothing(spark, make_events):
    none = make_events(("A", "2025-01-01", None, None)).limit(0)
    content = enhance.content_of(enhance.enhance(none))
    assert a.insights(none, content).count() == 0
    assert a.building_utilisation(a.building_counts(none)).count() == 0
    assert a.share_of_total(a.time_specification(none)).count() == 0


def test_key_terms(spark):
    texts = spark.createDataFrame(
        [(1, "Robot club robot club meeting"), (2, "the club meeting"), (3, "")], "id BIGINT, text STRING"
    )
    terms = key_terms(texts, "id", "text", top_n=3)
    lists = {r.id: r.keywords for r in keyword_lists(terms).collect()}
    assert lists[1][:2] == ["robot", "robot club"] and set(lists) == {1, 2}
    counts = {(r.id, r.term): r.tf for r in key_terms(texts, "id", "text", top_n=50).collect()}
    assert counts[(1, "robot")] == 2 and counts[(1, "club robot")] == 1 and (2, "the club") not in counts


def test_bundle(spark, make_events):
    events = make_events(WORKSHOP, ("Tea", "2025-11-15", None, None))
    texts = events.select("id", F.concat_ws(" ", "title", "description").alias("text"))
    bundle = {r.id: r for r in enhance.feature_bundle(events, keyword_lists(key_terms(texts, "id", "text"))).collect()}
    assert bundle[1].general_suggestions[0].startswith(vocab.KEYWORD_HINT)
    assert "student-life" in bundle[1].tags
    assert bundle[2].description_suggestions[1:] == [
        vocab.KEY_ELEMENT_MISSING.format(element=e) for e in ("time", "location", "contact")
    ]


def test_slugs(spark):
    df = spark.createDataFrame([(["Student Life!", "--", "A & B"],)], "tags ARRAY<STRING>")
    assert df.select(tag_slugs(F.col("tags"))).first()[0] == ["student-life", "a-b"]


def test_enhancement_needs_no_shuffle(spark, make_events):
    plan = enhance.enhance(make_events(WORKSHOP))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_details_by_word_are_those_of_the_patterns(spark):
    texts = ["sign up", "Sign-UP", "sign  up", "SİGNUP", "registration", "regist", "$", "fe e", "PHONE", "contac t", "", None, "a@b free rsvp"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    low = F.lower(F.coalesce("t", F.lit("")))
    plain = F.array_compact(F.array(*[F.when(~low.rlike(p), F.lit(s)) for p, s in vocab.DETAIL_CHECKS]))
    assert all(r.a == r.b for r in rows.select(features.missing_details(F.col("t")).alias("a"), plain.alias("b")).collect())


def test_a_mention_is_told_without_taking_all_out(spark):
    texts = ["at 3 pm", "3 to 5 PM", "May 5", "1/2/24", "٣ am", "May", "3 p", "1/2", "Room 5", "Room", "fıeld 3", "hall 5", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    t = F.col("t")
    told = rows.select(
        features.names_time(t).alias("a"), (features.time_mentions(t) != "").alias("b"),
        features.names_place(t).alias("c"), (features.location_mentions(t) != "").alias("d"),
    ).collect()
    assert all((r.a, r.c) == (r.b, r.d) for r in told) and sum(r.a for r in told) == 5 and sum(r.c for r in told) == 3


def test_scores_take_no_mentions_out(make_events, capsys):
    events = make_events(("Art Party", "2025-01-01", "10:00", "Hall", "at the gym"))
    enhance.enhance(events, one_pass=True).select("seo_score").explain("simple")
    assert "regexp_extract_all" not in capsys.readouterr().out


def _plain_key_terms(rows, top_n):
    said = []
    for id_, text in rows:
        words = [w for w in re.findall(r"\w{2,}", (text or "").lower()) if w not in vocab.STOP_WORDS]
        said.append((id_, Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])))
    df = Counter(term for _, terms in said for term in terms)
    found = {}
    for id_, terms in said:
        found.setdefault(id_, []).extend(
            (-round(tf * (math.log((len(rows) + 1) / (df[t] + 1)) + 1), 9), t, tf, df[t]) for t, tf in terms.items()
        )
    return sorted(
        ((id_, rank, t, tf, n) for id_, all_ in found.items() for rank, (_, t, tf, n) in enumerate(sorted(all_)[:top_n], 1)), key=str
    )


def test_key_terms_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(keywords, "BLOCK_BYTES", 300)
    monkeypatch.setattr(keywords, "RANGE_BYTES", 500)
    rng = random.Random(3)
    some = ["river", "riverbank", "riverbanks", "été", "naïve", "x1", "stone", "a", "the", "ß_9", "日本"]
    rows = [(i % 40, " ".join(rng.choice(some) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    # Many terms of equal score, told apart by name; nulls, blanks, copies under one id and under none.
    rows += [(100, " ".join(f"internat{rng.randrange(10**6)}" for _ in range(40))), (101, None), (102, ""), (103, " , "), (104, "solo")]
    rows += [rows[5], rows[5], (None, "river stone river"), (None, "stone")]
    texts = spark.createDataFrame(rows, "id long, text string")
    found = key_terms(texts, "id", "text", top_n=3)
    assert sorted((tuple(r)[:5] for r in found.collect()), key=str) == _plain_key_terms(rows, 3)
    assert "hashpartitioning(term" not in found._jdf.queryExecution().executedPlan().toString()


def test_filtered_listing_makes_no_other_content(spark, tmp_path):
    days = [f"2024-01-{d:02d} 10:00:00" for d in range(8, 29)]
    events = [(i, days[i % len(days)], i, "click") for i in range(300)] + [(12, days[3], 1, "view"), (None, days[4], 2, "view")]
    typed = spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string")
    typed.withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/events.parquet")
    texts = [(i, f"some words of an art show number {i} with more words after them") for i in range(7)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    listed = q.list_all_filtered(spark, str(tmp_path))
    bounds = {"since": "2024-01-10", "until": "2024-01-26"}
    rows = q.filters.list_events(
        q.ce(spark, str(tmp_path), "id", "title", "date", "location", **bounds),
        q.content(spark, str(tmp_path), "event_type", "seo_score", **bounds),
        q.AS_OF, limit=None, event_type="Arts", location="bldg", date_from="2024-01-10", date_to="2024-01-25",
    )
    assert listed.count() > 50
    assert sorted(map(tuple, listed.collect()), key=str) == sorted(map(tuple, q.ints_as_long(q.filters.list_display(rows)).collect()), key=str)
    # Ids are met before any text is: the semi join stands below the join with the documents.
    plan = listed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = next(line for line in plan if "LeftSemi" in line)
    texts_join = [line for line in plan[: plan.index(semi)] if "Join LeftOuter, (own" in line]
    assert texts_join and min(len(x) - len(x.lstrip(" :")) for x in texts_join) < len(semi) - len(semi.lstrip(" :")), "\n".join(plan)
