"""Line dedup: lines that many documents share go, but for the last document that holds them.

Lines are exploded, normalised and hashed; the documents of each hash are counted, and lines of hashes over the threshold are dropped.
Texts are put together again by position, from the places their dropped lines leave.

DataFrame functions only. A first pass counts lines by a coarse hash, pre-aggregated, and keeps those that may reach the threshold;
only lines of these meet again, so unique lines are shuffled once, as a number and a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize

LEAST_CHARS = 40
LEAST_DOCS = 5
#: What is stripped from a line's ends, and the letters that count in lower case.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A table of so many hashes of eight bytes may be sent to all tasks; a larger one is joined by a shuffle.
SENT_HASHES = 1_000_000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def key(line: Column) -> Column:
    """What makes two lines the same: blanks at both ends stripped, A-Z in lower case."""
    return F.translate(stripped(line), UPPER, LOWER)


def _two_hashes(*columns: Column) -> tuple[Column, Column]:
    """128 bits: the same columns behind two different first values."""
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)


def _text_key() -> list[Column]:
    """Names a row by its id and text: rows equal in both drop the same lines."""
    one, two = _two_hashes("doc_id", F.coalesce(F.col("text"), F.lit("")))
    return [one.alias("text_1"), two.alias("text_2")]


def shared_lines(rows: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """``text_1, text_2, places``: for each text that loses lines their places, from 0."""
    lines = rows.select("doc_id", *_text_key(), F.posexplode(split_lines(F.col("text"))).alias("place", "line"))
    long_enough = F.length(stripped(F.col("line"))) >= least_chars
    # Lower case of all letters is coarser than the key, and cheap.
    lines = lines.filter(long_enough).withColumn("coarse", F.xxhash64(F.lower(stripped(F.col("line")))))
    often = materialize(lines.groupBy("coarse").agg(F.count("*").alias("rows")).filter(F.col("rows") >= least_docs))
    if often.count() <= SENT_HASHES:
        met = lines.join(F.broadcast(often.select("coarse")), "coarse")
    else:
        met = lookup(lines, often, ["coarse"], "rows")
    line_1, line_2 = _two_hashes(key(F.col("line")))
    met = materialize(met.select("doc_id", "text_1", "text_2", "place", line_1.alias("line_1"), line_2.alias("line_2")))
    by_doc = met.groupBy("line_1", "line_2", "doc_id").agg(F.count("*").alias("rows"))
    # A null id is an id of its own, below all others.
    over = (
        by_doc.groupBy("line_1", "line_2")
        .agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"), F.sum("rows").alias("rows"))
        .filter(F.col("docs") >= least_docs)
        .drop("docs")
    )
    lost = lookup(met, over, ["line_1", "line_2"], "rows").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return lost.groupBy("text_1", "text_2").agg(F.collect_set("place").alias("places"))


def drop_shared_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row: the text without the lines it shares with many others.

    A line of ``least_chars`` code points or more, stripped, that ``least_docs`` documents or more hold goes everywhere but in the document of
    the largest id that holds it, where all its copies stay. Rows of one id are one document, a null id is an id of its own and
    below all others; repeated rows are each returned. A null or empty text is one empty line; a text of any length is
    read whole; of a text that loses all its lines the empty text is kept. Lines are told apart by 128 bits of hash. Other
    columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    lost = materialize(shared_lines(rows, least_chars, least_docs))
    # Copies under other ids have other keys; only rows equal in id and text meet, and the adaptive planner cuts those up.
    found = rows.select("doc_id", "text", *_text_key()).join(lost, ["text_1", "text_2"], "left")
    # A column of its own: inside the function below the split would be repeated for each line.
    found = found.withColumn("lines", split_lines(F.col("text"))).withColumn("places", F.coalesce("places", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n")
    return found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("places").cast("long").alias("n_dropped"),
        F.when(F.size("places") == 0, F.coalesce(F.col("text"), F.lit(""))).otherwise(kept).alias("kept"),
    )


def digest(deduped: DataFrame) -> DataFrame:
    """The counts, and SHA-256 in hex of what is kept."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
