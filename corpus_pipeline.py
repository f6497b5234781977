"""A training corpus from raw documents, stage by stage; each stage's rows are stored and read by the next.

Every stage but the last returns the columns of ``documents`` and keeps repeated rows, nulls and extra columns as they are, whatever
their names: what a stage adds on its way gets a name that is free.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, langid, packing, secrets, simhash
from eventloom.llm.common import materialize, remainder, table

#: A text of which a language's filter holds less than this share of the n-grams is no text of a known language.
LEAST_LANGUAGE_SCORE = 0.2
#: A text of fewer letters is too short to tell and stays.
LEAST_LETTERS = 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def free(docs: DataFrame, name: str) -> str:
    """``name``, or the first longer one that is no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose text fits no learned language."""
    pred, score = free(docs, "lang_pred"), free(docs, "score")
    train = docs.filter(remainder("doc_id", 4) != 2)
    found = langid.identify(docs, langid.fit(train), lang_pred=pred, score=score)
    letters = F.length(F.regexp_replace("text", r"\P{L}", ""))
    foreign = (F.col(score) < LEAST_LANGUAGE_SCORE) & (letters >= LEAST_LETTERS)
    return found.filter((F.col(pred) != langid.UNDECIDED) & ~foreign).select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The same rows stored with a number each, and the name of its column: ids may be null or repeated, numbers are neither."""
    name = free(docs, "row")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id())), name


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group whose fingerprints are linked: one with the smallest id, null ids last."""
    rows, row = numbered(docs)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("number").alias("row"))
    found = simhash.near_duplicates(rows, row).select(F.col("doc_id").alias("number"), "component_id")
    ids = rows.select(F.col(row).alias("number"), "doc_id")
    kept = found.join(ids, "number").groupBy("component_id").agg(F.min(order)["row"].alias(row))
    return rows.join(kept.select(row), row, "left_semi").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that hold a passage of the benchmark, and no others of their id."""
    rows, row = numbered(docs)
    found = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), row).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with secrets replaced by a mark; ``n_chars`` follows the text."""
    found = free(docs, "secrets")
    out = secrets.redact(secrets.scan(docs, into=found), found=found)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(out.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

#: No stage can be expressed in SQL: filters of n-grams, fingerprints and components, seeds, tests, and a solver.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
