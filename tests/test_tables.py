import datetime
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from eventloom.operators import analytics as a
from eventloom.operators import enhance, export, filters, integrity, merge
from eventloom.plans import commands
from eventloom.plans.cleanup import purge
from eventloom.plans.ingest import run_ingest, run_upsert
from eventloom.schema import EVENTS
from eventloom.sinks import files
from eventloom.sources.pages import LISTING_BLOCKS, extract_listing_rows
from eventloom.sources.known import known_events, last_id, seen_links
from eventloom.sources.store import append_rows, existing_tables, load_tables, read_table, run_sql, write_table

AS_OF = "2025-01-01"
STAMP = "2025-01-01 12:00:00"

PAGE = """<html><body>
<div class="views-row"><div class="field-title"><h2><a href="/event/1">Art &amp; Music</a></h2></div>
<div class="views-field-field-dates-value"><time datetime="2025-03-01T14:30:00">March</time></div>
<div class="field-location"> Hall 1 </div><div class="field-body"><p>Come <b>along</b></p></div></div>
<div class="views-row"><div class="field-title">No link</div></div>
<div class="views-row odd"><div class="field-title"><a href="https://other.example.edu/2">Plain</a></div>
<div class="field-body">No time given</div></div></body></html>"""


def stamp():
    return F.lit(STAMP).cast("timestamp")


def sample(make_events):
    return make_events(
        ("Workshop, part; one", "2025-03-01", "10:00", "Bldg 1, Room 2", "Line one\nLine two, with comma"),
        ("Open day", "2025-03-02", None, None, 'He said "hi"'),
        ("Broken", "2025-03-03", "99:99", "Hall"),
        ("Past", "2024-03-03", "10:00", "Hall"),
        ("Late", "2025-03-01", "23:30", "Hall"),
    )


def test_listing_blocks(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id BIGINT, html STRING")
    rows = {r.row_no: r for r in extract_listing_rows(pages, LISTING_BLOCKS).collect()}
    assert set(rows) == {0, 2}
    first = rows[0]
    assert (first.title, first.description, first.date, first.time, first.location, first.link) == (
        "Art & Music", "Come along", "2025-03-01", "14:30", "Hall 1", "https://campus.example.edu/event/1",
    )
    last = rows[2]
    assert (last.title, last.date, last.time, last.location, last.link) == (
        "Plain", None, None, None, "https://other.example.edu/2",
    )


def test_a_block_ends_at_its_own_tag(spark):
    row = '<div class="views-row"><div class="field-title"><a href="{0}">{1}</a></div>{2}</div>'
    inner = row.format("/in", "Inner", "")
    html = row.format("/one", "One", '<div class="field-body"><div>a</div><div>b</div>c</div><p>x</p>') + "<div>between</div>"
    html += row.format("two", "Two", inner) + '</div></div><div class="views-row"><div class="field-title"><a href="/open">Open</a>'
    pages = spark.createDataFrame([(1, "https://s.example.edu/list?x=1", html), (2, None, html[:40]), (3, "", None)], "page_id BIGINT, url STRING, html STRING")
    rows = [(r.page_id, r.row_no, r.title, r.description, r.link) for r in extract_listing_rows(pages, LISTING_BLOCKS, base_url=None).collect()]
    assert sorted(rows) == [
        (1, 0, "One", "abc", "https://s.example.edu/one"),
        (1, 1, "Two", None, "two"),
        (1, 2, "Inner", None, "https://s.example.edu/in"),
        (1, 3, "Open", None, "https://s.example.edu/open"),
    ]


def test_csv(spark, make_events, tmp_path):
    events = sample(make_events)
    enhanced = enhance.enhance(events)
    rows = export.export_rows(events, AS_OF, enhance.content_of(enhanced), enhance.tags_of(enhanced))
    assert files.write_csv(rows, str(tmp_path / "csv"), single_file=True) == 4
    back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"')
    assert back.columns == list(export.ENHANCED_HEADERS.values())
    first = back.filter("ID = 1").first()
    assert first["Description"] == "Line one\nLine two, with comma" and first["Tags"] == "academic, art, arts, workshop"
    assert [r.ID for r in back.select("ID").collect()] == ["1", "5", "2", "3"]
    nothing = export.export_rows(events, "2030-01-01", include_enhanced=False)
    assert files.write_csv(nothing, str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()


def test_calendar(spark, make_events, tmp_path):
    events = sample(make_events)
    content = enhance.content_of(enhance.enhance(events))
    entries = export.vevents(events, content, AS_OF)
    assert files.write_calendars(entries, str(tmp_path / "ics"), stamp(), single_file=True) == 3
    (part,) = glob.glob(str(tmp_path / "ics" / "part-*"))
    body = open(part, newline="").read()
    lines = body.split("\r\n")
    assert lines[0] == "BEGIN:VCALENDAR" and lines[-2:] == ["END:VCALENDAR", ""]
    assert body.count("BEGIN:VEVENT\r\n") == body.count("END:VEVENT\r\n") == 3
    assert "SUMMARY:Workshop\\, part\\; one" in lines
    assert "DTSTART:20250301T100000" in lines and "DTEND:20250301T110000" in lines
    assert "DTEND:20250302T003000" in lines
    assert "DTSTART;VALUE=DATE:20250302" in lines and "DTEND;VALUE=DATE:20250303" in lines
    assert lines.count("X-MICROSOFT-CDO-ALLDAYEVENT:TRUE") == 1
    assert "DESCRIPTION:[Academic\\, Arts]\\n\\nLine one\\nLine two\\, with comma" in lines
    assert lines.index("UID:event-1@campus.example.edu") < lines.index("UID:event-5@campus.example.edu")
    assert not [line for line in lines[:-1] if "\n" in line]


def test_each_part_is_a_calendar(spark, make_events, tmp_path):
    events = make_events(*[(f"Event {i}", f"2025-03-{i % 28 + 1:02d}", "10:00", None) for i in range(200)])
    content = enhance.content_of(enhance.enhance(events))
    assert files.write_calendars(export.vevents(events, content, AS_OF), str(tmp_path / "ics"), stamp()) == 200
    parts = [p for p in glob.glob(str(tmp_path / "ics" / "part-*")) if os.path.getsize(p)]
    for part in parts:
        body = open(part, newline="").read()
        assert body.startswith("BEGIN:VCALENDAR\r\n") and body.rstrip().endswith("END:VCALENDAR")
    assert sum(open(p).read().count("BEGIN:VEVENT") for p in parts) == 200


def test_rejects_and_history(spark, tmp_path):
    assert not files.write_rejects(spark.range(0), str(tmp_path / "rejects")) and not (tmp_path / "rejects").exists()
    assert files.write_rejects(spark.createDataFrame([("u", "e")], "url STRING, error STRING"), str(tmp_path / "rejects"))
    text = "".join(open(part).read() for part in glob.glob(str(tmp_path / "rejects" / "part-*.json")))
    assert json.loads(text) == {"url": "u", "error": "e"}
    for n in (3, 4):
        files.append_history(spark, str(tmp_path), n, stamp())
    rows = read_table(spark, str(tmp_path), "scraping_history").orderBy("id").collect()
    assert [(r.id, r.events_scraped, r.status) for r in rows] == [(1, 3, "success"), (2, 4, "success")]


def stored(make_events):
    return sample(make_events).withColumns({"created_at": stamp(), "last_updated": stamp()})


def parts(root, table="events"):
    """Data files of a table and when they were written."""
    return {p: os.path.getmtime(p) for p in glob.glob(f"{root}/{table}/**/part-*", recursive=True)}


def test_appends_leave_files_alone(spark, make_events, tmp_path):
    root, rows = str(tmp_path), stored(make_events)
    append_rows(rows.filter("id <= 2"), root, "events", "one")
    before = parts(root)
    append_rows(rows.filter("id > 2"), root, "events", "two")
    assert before and before.items() < parts(root).items()
    table = load_tables(spark, root)["events"]
    assert sorted(r.id for r in table.collect()) == [1, 2, 3, 4, 5] and existing_tables(spark, root) == ["events"]
    assert table.dtypes == spark.createDataFrame([], EVENTS).dtypes
    write_table(rows.filter("id = 1"), root, "events")
    assert [r.id for r in load_tables(spark, root)["events"].collect()] == [1]
    assert read_table(spark, root, "event_tags").count() == 0


def test_a_date_bound_prunes_folders(spark, make_events, tmp_path, capsys):
    root = str(tmp_path)
    append_rows(stored(make_events), root, "events", "one")
    found = filters.upcoming(load_tables(spark, root)["events"], AS_OF).select("id", "title")
    found.explain("formatted")
    assert "PartitionFilters: [isnotnull(date" in capsys.readouterr().out
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 5]


def raw(spark, *rows):
    """Listed rows (position, title, date, link)."""
    full = [(p, t, f"about {p}", d, "10:00", "Hall", f"https://a.example.edu/{k}") for p, t, d, k in rows]
    return spark.createDataFrame(
        full, "position BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING, link STRING"
    )


def test_an_upsert_rewrites_its_dates_only(spark, tmp_path):
    root = str(tmp_path)
    first = raw(spark, *[(i, f"{word} meeting", f"2025-03-{i:02d}", i) for i, word in enumerate(("Alpha", "Bravo", "Chess", "Delta"), 1)])
    assert run_ingest(spark, root, first, stamp=stamp(), run="one")["added"] == 4
    before = parts(root)
    again = raw(spark, (7, "Bravo meeting", "2025-03-02", 2), (8, "Elsewhere", "2025-03-02", 4), (9, "Foxtrot night", "2025-03-03", 9))
    later = F.lit("2025-02-02 00:00:00").cast("timestamp")
    assert run_upsert(spark, root, again, stamp=later, run="two") == 2
    out = {r.title: r for r in read_table(spark, root, "events").collect()}
    assert set(out) == {"Alpha meeting", "Bravo meeting", "Chess meeting", "Delta meeting", "Foxtrot night"}
    assert out["Bravo meeting"].description == "about 7" and out["Bravo meeting"].id == 2 and out["Foxtrot night"].id > 4
    changed = {p.split("date=")[1][:10] for p, _ in set(parts(root).items()) ^ set(before.items())}
    assert changed == {"2025-03-02", "2025-03-03"}
    whole = merge.upsert_events(stored_like(spark, first), again, "position", later)
    assert sorted((r.title, r.description) for r in whole.collect()) == sorted((r.title, r.description) for r in out.values())
    assert run_ingest(spark, root, raw(spark, (1, "Other", "2025-05-05", 9)), stamp=stamp())["added"] == 0


def stored_like(spark, rows):
    return rows.withColumnRenamed("position", "id").withColumns({"created_at": stamp(), "last_updated": stamp()})


def test_what_an_ingest_reads_does_not_grow_with_other_dates(spark, tmp_path):
    root = str(tmp_path)
    batch = raw(spark, (1, "Chess night", "2025-03-01", "new"), (2, "Open stage", "2025-03-02", "x7"))
    run_ingest(spark, root, raw(spark, (1, "Chess nights", "2025-03-01", "c")), stamp=stamp())
    size = lambda: sum(os.path.getsize(f.removeprefix("file://")) for f in known_events(spark, root, batch).inputFiles())
    read = []
    for month in (4, 5):
        rows = [(d, f"{chr(64 + d)} talk number {d} {month}", f"2025-{month:02d}-{d:02d}", f"{month}-{d}") for d in range(1, 13)]
        assert run_ingest(spark, root, raw(spark, *rows), stamp=stamp())["added"] == 12
        read.append(size())
    found = len(seen_links(spark, root, batch).inputFiles())
    assert read[0] > 0 and max(read) - min(read) < 20_000 and found < 5 < len(parts(root, "seen_links"))
    assert last_id(spark, root) == 25
    assert run_ingest(spark, root, batch, stamp=stamp())["added"] == 1


def test_a_repeated_run_replaces_its_rejects(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "Robot Workshop", "2025-03-01"), (2, "", "2025-03-01")], "position BIGINT, title STRING, date STRING"
    ).selectExpr("*", "CAST(NULL AS STRING) description", "'10:00' time", "'Hall' location", "concat('https://a.example.edu/', position) link")
    added = [run_ingest(spark, str(tmp_path), rows, stamp=stamp(), run="one")["added"] for _ in range(2)]
    assert added == [1, 0] and spark.read.json(str(tmp_path / "rejects")).count() == 1
    assert load_tables(spark, str(tmp_path))["scraping_history"].count() == 2


def test_snapshot_and_restore(spark, make_events, tmp_path):
    root = str(tmp_path)
    write_table(stored(make_events), root, "events")
    files.snapshot(spark, root, "before")
    write_table(stored(make_events).limit(0), root, "events")
    assert load_tables(spark, root)["events"].count() == 0
    files.restore(spark, root, "before")
    assert load_tables(spark, root)["events"].count() == 5 and last_id(spark, root) == 5
    assert run_sql(spark, "SELECT title FROM events WHERE id = :id", id=2).first().title == "Open day"
    spark.range(3).write.mode("overwrite").parquet(f"{root}/snapshots/before/event_tags")
    with pytest.raises(ValueError):
        files.restore(spark, root, "before")


def test_operators_as_sql_functions(spark, make_events, tmp_path):
    root, events = str(tmp_path), stored(make_events)
    append_rows(events.unionByName(events.filter("id = 2").withColumn("id", F.lit(9).cast("bigint"))), root, "events")
    append_rows(enhance.content_of(enhance.enhance(events.filter("id <= 2"))), root, "enhanced_content")
    tables = load_tables(spark, root)
    listed, content = tables["events"], tables["enhanced_content"]
    same = {
        "upcoming_events(:a)": filters.upcoming(listed, AS_OF),
        "past_events(:a)": filters.past(listed, AS_OF),
        "events_between('2025-03-01', '2025-03-02')": filters.date_range(listed, AS_OF, "2025-03-01", "2025-03-02", "listing"),
        "events_at('bldg')": filters.text_filters(listed, location="bldg"),
        "content_of_type('arts')": filters.text_filters(content, event_type="arts"),
        "waiting_events()": enhance.enhancement_queue(listed, content),
        "duplicate_events()": a.duplicate_groups(listed.select("title", "date")),
    }
    for call, wanted in same.items():
        found = run_sql(spark, f"SELECT * FROM {call}", a=AS_OF)
        rows = sorted(map(tuple, found.select(*wanted.columns).collect()), key=str)
        assert rows and rows == sorted(map(tuple, wanted.collect()), key=str), call


def test_number_rows(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 10007).alias("at"))
    numbered = merge.number_rows(rows, "at", "n").orderBy("at").collect()
    assert [r.n for r in numbered] == list(range(1, 1001))


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "Arts")], "id BIGINT, name STRING")
    rows = spark.createDataFrame([(9, "Arts", 1), (8, "Career", 3), (7, "Career", 2)], "id BIGINT, name STRING, at BIGINT")
    out = merge.insert_if_absent(target, rows, ["name"], "at")
    assert sorted(map(tuple, out.collect())) == [(1, "Arts"), (7, "Career")]


def test_upsert(spark, make_events):
    later = F.lit("2025-02-02 00:00:00").cast("timestamp")
    incoming = spark.createDataFrame(
        [
            (1, "New", "d", "2025-04-01", None, None, "n1"),
            (2, "Open day", "changed", "2025-03-02", None, "Gym", "https://campus.example.edu/event/2"),
            (3, "Open day", "changed twice", "2025-03-02", None, "Lab", "https://campus.example.edu/event/2"),
            (4, "New", "same link again", "2025-04-01", None, None, "n1"),
            (5, "Elsewhere", "other title", "2025-03-02", None, None, "https://campus.example.edu/event/1"),
        ],
        "position BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING, link STRING",
    )
    out = {r.id: r for r in merge.upsert_events(stored(make_events), incoming, "position", later).collect()}
    assert set(out) == {1, 2, 3, 4, 5, 6}
    assert (out[2].description, out[2].location) == ("changed twice", "Lab")
    assert out[2].last_updated == datetime.datetime(2025, 2, 2) and out[1].last_updated == datetime.datetime(2025, 1, 1, 12)
    assert (out[6].link, out[6].description) == ("n1", "same link again")
    assert integrity.constraint_report({"events": spark.createDataFrame(list(out.values()), EVENTS)}).filter(
        "constraint = 'events.unique(link)' AND violations = 0"
    ).count() == 1


def test_missing_tables_and_purge(spark, make_events):
    report = {r.constraint: r.violations for r in integrity.constraint_report({"events": stored(make_events)}).collect()}
    assert report["enhanced_content.present"] == 1 and report["event_tags.present"] == 1
    enhanced = enhance.enhance(sample(make_events))
    tables = {"events": stored(make_events), "enhanced_content": enhance.content_of(enhanced), "event_tags": enhance.tags_of(enhanced)}
    after = purge(tables, AS_OF)
    assert after["events"].count() == 4 and after["enhanced_content"].count() == 4
    assert integrity.orphans(after["event_tags"], after["events"]).isEmpty()


def test_commands_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        commands.init_tables(spark, root)
    assert load_tables(spark, root)["categories"].count() == 5
    rows = spark.createDataFrame(
        [
            (1, "Robot Workshop", None, "2025-03-01", "10:00", "Hall", "https://campus.example.edu/1"),
            (2, "Robot Workshop!", None, "2025-03-01", "10:00", "Hall", "https://campus.example.edu/2"),
            (3, "Chess Night", "Free games", "3/1/2025", "10:30 am", "hall", "https://campus.example.edu/3"),
            (4, "", None, "2025-03-01", None, None, "https://campus.example.edu/4"),
            (5, "Old News", None, "2024-03-01", None, None, "https://campus.example.edu/5"),
        ],
        "position BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING, link STRING",
    )
    metrics = run_ingest(spark, root, rows, stamp=stamp())
    assert metrics == {"total": 5, "valid": 4, "invalid": 1, "added": 3, "skipped": 1, "updated": 0}
    assert run_ingest(spark, root, rows, stamp=stamp())["added"] == 0
    assert commands.enhance_all(spark, root) == 3 and commands.enhance_all(spark, root) == 0
    counts = commands.generate_recommendations(spark, root, AS_OF)
    assert (counts["total"], counts["high_severity"]) == (2, 2)
    listed = commands.list_upcoming(spark, root, AS_OF).collect()
    assert [r.title for r in listed] == ["Robot Workshop", "Chess Night"]
    detail = commands.show_event(spark, root, listed[0].id).first()
    assert detail.severity == "HIGH" and detail.conflict_type == "Venue Double Booking"
    assert commands.show_event(spark, root, 99).count() == 0
    assert commands.export_csv(spark, root, f"{root}/out", AS_OF, event_type="academic") == 1
    assert commands.export_event_ical(spark, root, f"{root}/one", AS_OF, listed[0].id)
    assert not commands.export_event_ical(spark, root, f"{root}/none", AS_OF, 99)
    health = commands.check_tables(spark, root, AS_OF)
    assert health["constraints"].filter("violations > 0").count() == 0
