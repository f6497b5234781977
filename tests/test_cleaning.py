from pyspark.sql import functions as F

from eventloom.functions.calendar import split_iso
from eventloom.functions.clean import clean_date, clean_link, clean_time, clean_title
from eventloom.operators.validation import invalid_messages, rejected_rows, valid_rows, validate, validation_stats
from eventloom.schema import RAW_EVENTS


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_EVENTS)


def batch(spark):
    def row(title, date, time, location, n, description):
        return (title, description, date, time, location, f"https://campus.example.edu/event/{n}")

    room = "Building 1, Room 101"
    return raw(
        spark,
        row("Valid Event", "2025-12-15", "14:00", room, 123, "All required fields are here."),
        row("", "2025-12-15", "14:00", room, 124, "No title"),
        row("Invalid Date Event", "2025-13-45", "14:00", room, 125, "Bad date"),
        row("Past Event", "2020-01-01", "14:00", room, 126, "In the past"),
        row("Invalid Time Event", "2025-12-15", "25:99", room, 127, "Bad time"),
        row("   Extra   Whitespace   Event   ", "2025-12-16", "10:00", "  Building 2  ", 128, "   padded   text   "),
    )


def test_batch_of_six(spark):
    checked = validate(batch(spark))
    stats = validation_stats(checked).first()
    assert (stats.total, stats.valid, stats.invalid, stats.warnings) == (6, 4, 2, 1)
    good = {r.title: r for r in valid_rows(checked).collect()}
    assert set(good) == {"Valid Event", "Past Event", "Invalid Time Event", "Extra Whitespace Event"}
    assert good["Extra Whitespace Event"].location == "Building 2"
    assert good["Extra Whitespace Event"].description == "padded text"
    assert good["Invalid Time Event"].time is None
    messages = {r.message for r in invalid_messages(checked).collect()}
    assert messages == {"ERROR: Title is required", "ERROR: Invalid date format: '2025-13-45'"}
    assert rejected_rows(checked).count() == 2


def test_missing_required_column(spark):
    checked = validate(batch(spark).drop("link")).first()
    assert checked.errors[0] == "Missing required field: link" and not checked.is_valid


def test_message_order(spark):
    row = validate(raw(spark, ("", None, "13/13/2024", "x", None, "ftp://a"))).first()
    assert row.messages == [
        "ERROR: Title is required",
        "ERROR: Invalid date format: '13/13/2024'",
        "ERROR: Invalid URL format: 'ftp://a'",
        "WARNING: Invalid time format: 'x', skipping",
    ]


def one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "v STRING")
    return tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(fn(F.col("v")))]).first())


def test_title_is_cut_before_collapsing(spark):
    value, error, warning = one(spark, clean_title, "ab" + " " * 250 + "c" * 10)
    assert value == "ab " and error is None and warning == "Title exceeds 200 characters, truncating"
    assert one(spark, clean_title, " ab ") == (None, "Title too short: 'ab'", None)


def test_unicode_white_space(spark):
    assert one(spark, clean_title, " A title ")[0] == "A title"


def test_dates(spark):
    converted = "Date converted from {} to YYYY-MM-DD".format
    assert one(spark, clean_date, "2024-1-5") == ("2024-01-05", None, None)
    assert one(spark, clean_date, "1/5/2024") == ("2024-01-05", None, converted("%m/%d/%Y"))
    assert one(spark, clean_date, "25-12-2024") == ("2024-12-25", None, converted("%d-%m-%Y"))
    assert one(spark, clean_date, "2024/12/25") == ("2024-12-25", None, converted("%Y/%m/%d"))
    assert one(spark, clean_date, "24-1-5")[0] is None
    assert one(spark, clean_date, None)[1] == "Date is required"


def test_times(spark):
    for given, wanted in [("2:30 PM", "14:30"), ("2:30pm", "14:30"), ("12 am", "00:00"), ("12:05 PM", "12:05"), ("7 Pm", "19:00")]:
        value, _, warning = one(spark, clean_time, given)
        assert (value, warning) == (wanted, "Time converted from 12-hour to 24-hour format")
    assert one(spark, clean_time, "9:5") == ("09:05", None, None)
    assert one(spark, clean_time, "7pm") == (None, None, "Invalid time format: '7pm', skipping")
    assert one(spark, clean_time, "") == (None, None, None)


def test_links(spark):
    for good in ["http://localhost:8000/x", "https://127.0.0.1", "HTTPS://A.example.EDU/p?q=1"]:
        assert one(spark, clean_link, good) == (good, None, None)
    for bad in ["campus.example.edu", "https://x y.edu", "https://a.toolongtld"]:
        assert one(spark, clean_link, bad)[0] is None


def test_split_iso(spark):
    cases = {
        "2025-10-01T14:30:00Z": ("2025-10-01", "14:30"),
        "2025-10-01": ("2025-10-01", None),
        "2025-99-01T10:00": (None, None),
        "2025-10-01T10:00T11": (None, None),
        "": (None, None),
    }
    for given, wanted in cases.items():
        assert one(spark, split_iso, given) == wanted


def test_long_texts_collapse_as_short_ones(spark):
    """By Arrow, which reads a text for what has to change before it rewrites any."""
    from eventloom.functions.text import collapse, collapse_long
    from eventloom.vocab import WHITESPACE

    texts = [f"a{c}b{c}{c}é{c}" for c in WHITESPACE] + ["a b", " ", "  ", "", None, "a" * 9000 + "  b", "​x", WHITESPACE, "a b " * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = rows.select("t", collapse(F.col("t")).alias("a"), collapse_long(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b for r in found) and len(found) == len(texts)
