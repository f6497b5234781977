from datetime import datetime

from eventloom.sources.campus import campus_events


def test_a_title_takes_no_whole_text_with_it(spark, tmp_path, capsys):
    texts = ["one two three four five six seven eight nine ten", "a  b c", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(i, datetime(2024, 1, 1 + i % 20), i % 7, "view") for i in range(300)] + [(None, None, None, None)]
    spark.createDataFrame(events, "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING").write.parquet(f"{tmp_path}/events.parquet")
    narrow, wide = campus_events(spark, str(tmp_path), "id", "title"), campus_events(spark, str(tmp_path), "id", "title", "description")
    rows = {tuple(r) for r in narrow.collect()}
    assert rows == {(r.id, r.title) for r in wide.collect()} and len(rows) == 301
    assert any(title and title.endswith("five eight") for _, title in rows)
    narrow.explain()
    assert "substring_index" in capsys.readouterr().out


def test_texts_are_dealt_to_as_many_tasks_as_events_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("eventloom.sources.campus.TASK_EVENTS", 50)
    texts = [f"t{i} " + "x " * (i % 40) for i in range(900)] + [None] * 100
    spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(i, datetime(2024, 1, 1 + i % 20), i % 7, "view") for i in range(2000)] + [(None, None, None, None)]
    spark.createDataFrame(events, "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING").write.parquet(f"{tmp_path}/events.parquet")
    spread = campus_events(spark, str(tmp_path), "id", "title", "description")
    with monkeypatch.context() as one:
        one.setattr("eventloom.sources.campus.TASK_EVENTS", 1)  # more tasks than documents allow: dealt by turns
        by_turns = campus_events(spark, str(tmp_path), "id", "title", "description")
    rows = spread.collect()
    assert len(rows) == 2001 and sorted(rows, key=str) == sorted(by_turns.collect(), key=str)
    for row in rows[:100]:
        if row.id is not None and row.id % 6:
            text = texts[row.id % 1000]
            assert row.description is None if text is None else row.description.endswith(text)
    assert spread.rdd.getNumPartitions() >= 40


def test_an_upsert_reads_the_whole_texts_once(spark, tmp_path, capsys):
    from eventloom.catalog.queries import QUERIES

    texts = [(i, f"word{i} b c d e f g h i") for i in range(10)]
    spark.createDataFrame(texts, "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(i, datetime(2024, 1, 1 + i % 28), i % 7, "view") for i in range(1, 100)]
    spark.createDataFrame(events, "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING").write.parquet(f"{tmp_path}/events.parquet")
    table = QUERIES["upsert_events"](spark, str(tmp_path))
    ids = [r.id for r in table.select("id").collect()]
    stored = sum(1 + i % 28 < 22 for i in range(1, 100))
    assert len(ids) == len(set(ids)) > stored
    table.explain()
    plan = capsys.readouterr().out
    assert plan.count("doc_id") and len([line for line in plan.splitlines() if "FileScan" in line and "doc_id" in line]) == 1
