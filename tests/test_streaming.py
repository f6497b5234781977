from pyspark.sql import functions as F

from eventloom.plans.ingest import ingest_batch
from eventloom.operators.merge import insert_if_absent
from eventloom.schema import EVENTS
from eventloom.sources.store import load_tables, read_table
from eventloom.streaming import jobs

ROWS = [
    (1, "Robot Workshop", "2025-03-01", "10:00", "a"),
    (2, "Robot Workshop!", "2025-03-01", "10:00", "b"),
    (3, "Chess Night", "2025-03-01", "19:00", "c"),
    (4, "", "2025-03-01", None, "d"),
    (5, "Chess Nights", "2025-03-01", None, "e"),
    (6, "Art Show", "2025-03-02", None, "c"),
    (7, "Film Evening", "2025-03-02", None, "f"),
]


def incoming(spark):
    full = [(i, t, None, d, m, None, f"https://campus.example.edu/{link}") for i, t, d, m, link in ROWS]
    return spark.createDataFrame(full, jobs.INCOMING)


def test_stream_equals_batch(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = incoming(spark)
    for start in (1, 4, 6):
        end = {1: 3, 4: 5, 6: 7}[start]
        rows.filter(F.col("position").between(start, end)).coalesce(1).write.mode("append").parquet(source)
        query = jobs.ingest_stream(jobs.read_incoming(spark, source), root, str(tmp_path / "ck"))
        query.awaitTermination()
    batch = ingest_batch(rows, spark.createDataFrame([], EVENTS), "position")
    wanted = sorted(r.title for r in batch.accepted.collect())
    stored = jobs.stored_events(spark, root)
    assert sorted(r.title for r in stored.collect()) == wanted == ["Chess Night", "Film Evening", "Robot Workshop"]
    assert sorted(r.id for r in stored.collect()) == [1, 2, 3]
    content = read_table(spark, root, "enhanced_content")
    assert [(r.seo_score, r.event_type) for r in content.collect()] == [(0, None)] * 3
    runs = jobs.run_history(spark, root).orderBy("id").collect()
    assert [r.events_scraped for r in runs] == [2, 0, 1]
    assert spark.read.parquet(f"{root}/rejects").filter("title = ''").count() == 1
    again = jobs.ingest_stream(jobs.read_incoming(spark, source), root, str(tmp_path / "ck"))
    again.awaitTermination()
    assert jobs.stored_events(spark, root).count() == 3


def test_enhancement_stream(spark, make_events, tmp_path):
    source, out = str(tmp_path / "events"), str(tmp_path / "content")
    events = make_events(("Robot Workshop", "2025-03-01", None, None), ("Chess Club", "2025-03-01", None, None))
    schema = "id BIGINT, title STRING, description STRING"
    for i in (1, 2):
        events.filter(F.col("id") == i).select("id", "title", "description").write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.enhance_stream(stream, out, str(tmp_path / "ck")).awaitTermination()
    kinds = {r.event_id: r.event_type for r in spark.read.parquet(out).collect()}
    assert kinds == {1: "Academic", 2: "Student Life"}


def test_distinct_links(spark, tmp_path):
    source, out = str(tmp_path / "links"), str(tmp_path / "distinct")
    rows = spark.createDataFrame([("a", "2025-03-01 10:00:00"), ("a", "2025-03-01 11:00:00"), ("b", "2025-03-01 11:00:00")], "link STRING, at STRING")
    rows.select("link", F.col("at").cast("timestamp").alias("arrived_at")).write.parquet(source)
    stream = spark.readStream.schema("link STRING, arrived_at TIMESTAMP").parquet(source)
    writer = jobs.distinct_links(stream).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.link for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_a_link_is_refused_after_any_delay(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "position BIGINT, link STRING, title STRING"
    rows = [(i, f"https://a.example.edu/{i * i % 23}" if i % 9 else None, f"t{i}") for i in range(120)]
    frame = spark.createDataFrame(rows, schema)
    for start in range(0, 120, 40):
        frame.filter(F.col("position").between(start, start + 39)).coalesce(1).write.mode("append").parquet(source)
        jobs.first_links_stream(jobs.read_incoming(spark, source, schema), root, str(tmp_path / "ck")).awaitTermination()
    found = spark.read.schema(schema).parquet(f"{root}/first_links")
    wanted = insert_if_absent(frame.limit(0), frame, ["link"], "position")
    assert sorted(map(tuple, found.select(*frame.columns).collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    jobs.first_links_stream(jobs.read_incoming(spark, source, schema), root, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(f"{root}/first_links").count() == found.count()


def test_a_repeated_micro_batch_replaces_its_attempt(spark, tmp_path):
    """The same files with a fresh checkpoint run as the same batch number, as after a failure before the commit."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    incoming(spark).coalesce(1).write.parquet(source)
    for attempt in ("one", "two"):
        jobs.ingest_stream(jobs.read_incoming(spark, source), root, str(tmp_path / attempt)).awaitTermination()
        stored = jobs.stored_events(spark, root).orderBy("id").collect()
        assert [(r.id, r.title) for r in stored] == [(1, "Robot Workshop"), (2, "Chess Night"), (3, "Film Evening")]
    assert read_table(spark, root, "enhanced_content").count() == 3
    assert [r.events_scraped for r in jobs.run_history(spark, root).collect()] == [3]


def test_waiting_events_are_enhanced_once(spark, make_events, tmp_path):
    source, root = str(tmp_path / "events"), str(tmp_path / "out")
    events = make_events(*[(t, "2025-03-01", None, None) for t in ("Robot Workshop", "Chess Club", "Art Show")])
    rows = events.select("id", "title", "description")
    schema = "id BIGINT, title STRING, description STRING"

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.enhance_waiting_stream(stream, root, str(tmp_path / "ck")).awaitTermination()
        return {r.event_id: r for r in read_table(spark, root, "enhanced_content").collect()}

    rows.filter("id <= 2").coalesce(1).write.parquet(source)
    first = run()
    assert {i: r.event_type for i, r in first.items()} == {1: "Academic", 2: "Student Life"}
    # The first event comes again under another title: its content stands.
    again = rows.filter("id <> 2").withColumn("title", F.when(F.col("id") == 1, "Art Show").otherwise(F.col("title")))
    again.coalesce(1).write.mode("append").parquet(source)
    second = run()
    assert second[1] == first[1] and set(second) == {1, 2, 3} and second[3].event_type == "Arts"
    assert load_tables(spark, root)["event_tags"].filter("event_id = 1 AND tag = 'art'").count() == 0
