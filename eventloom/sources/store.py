"""Stored tables: one folder of partitioned parquet each, written by Spark's own appends and partition overwrites.

``events`` lie by date and batch, rows that belong to an event by range of its id. Appends add files; a changed row
rewrites the partitions it falls into (``partitionOverwriteMode=dynamic``), and a filter on the date or on
ranges of ids prunes folders. Readers see what Spark's commit has put in place; two rewrites of one partition at a time
need a table format, which is left to the installation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import replace_by_key, replace_tags
from ..schema import TABLES
from ..session import cut_lineage

#: Events of one folder of a table that hangs on events, by id.
IDS_PER_FOLDER = 1_000_000
#: What each partitioned table lies by; ``batch`` names the run or micro-batch that brought an event.
FOLDERS = {
    "events": ("date", "batch"),
    "event_categories": ("ids",),
    "event_recommendations": ("ids",),
    "enhanced_content": ("ids",),
    "event_tags": ("ids",),
}
_TYPES = {"date": "STRING", "batch": "STRING", "ids": "BIGINT"}


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the class of its paths."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return paths(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), paths


def exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = filesystem(spark, path)
    return fs.exists(path_of(path))


def id_folder(event_id: Column) -> Column:
    return F.floor(event_id / IDS_PER_FOLDER).cast("bigint")


def _foldered(rows: DataFrame, name: str, batch: str) -> DataFrame:
    """Rows with the columns their table lies by, gathered by these so that few files are written; hot folders are split."""
    if name not in FOLDERS:
        return rows
    if "ids" in FOLDERS[name]:
        rows = rows.withColumn("ids", id_folder(F.col("event_id")))
    if "batch" in FOLDERS[name] and "batch" not in rows.columns:
        rows = rows.withColumn("batch", F.lit(batch))
    return rows.hint("rebalance", *FOLDERS[name])


def _columns(name: str) -> list[str]:
    return [part.split()[0] for part in TABLES[name].replace(", ", ",").split(",")]


def _schema(name: str) -> str:
    """With the columns that the table lies by and that are not its own."""
    return ", ".join([TABLES[name], *(f"{c} {_TYPES[c]}" for c in FOLDERS.get(name, ()) if c != "date")])


def read_table(spark: SparkSession, root: str, name: str, *extra: str) -> DataFrame:
    """The stored table, or an empty frame of its schema; ``extra`` are columns it lies by. A blank date is stored as none."""
    path = f"{root}/{name}"
    columns = [*_columns(name), *extra]
    if not exists(spark, path):
        return spark.createDataFrame([], _schema(name)).select(*columns)
    return spark.read.schema(_schema(name)).parquet(path).select(*columns)


def read_folders(spark: SparkSession, path: str, schema: str, column: str, values: Iterable[str]) -> DataFrame:
    """Rows of the folders ``column=value`` under ``path``; the others are neither read nor listed below their name."""
    fs, path_of = filesystem(spark, path)
    pattern = f"{path}/{column}={{{','.join(sorted(map(str, values)))}}}"
    if not fs.exists(path_of(path)) or not fs.globStatus(path_of(pattern)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(pattern)


def _table_folders(spark: SparkSession, root: str, name: str, values: Iterable[str]) -> DataFrame:
    return read_folders(spark, f"{root}/{name}", _schema(name), FOLDERS[name][0], values)


def events_on(spark: SparkSession, root: str, dates: Iterable[str]) -> DataFrame:
    """Stored events of some dates, with their ``batch``; no other date's folder is opened."""
    return _table_folders(spark, root, "events", dates)


def rows_of_ids(spark: SparkSession, root: str, name: str, ids: DataFrame) -> DataFrame:
    """Rows of a table in the folders of the ids in column ``event_id``."""
    asked = ids.select(id_folder(F.col("event_id"))).distinct()
    return _table_folders(spark, root, name, [r[0] for r in asked.collect()]).select(*_columns(name))


def append_rows(rows: DataFrame, root: str, name: str, batch: str = "") -> None:
    """Adds rows to a table; files already there stay as they are."""
    writer = _foldered(rows, name, batch).write.mode("append")
    (writer.partitionBy(*FOLDERS[name]) if name in FOLDERS else writer).parquet(f"{root}/{name}")


def overwrite_folders(rows: DataFrame, path: str, *columns: str) -> None:
    """The folders that ``rows`` fall into hold these rows afterwards; the others stay as they are."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(path)


def write_table(rows: DataFrame, root: str, name: str, batch: str = "") -> None:
    """``rows``, which do not come from the table, become its whole content."""
    writer = _foldered(rows, name, batch).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*FOLDERS[name]) if name in FOLDERS else writer).parquet(f"{root}/{name}")


def replace_rows(spark: SparkSession, root: str, name: str, new: DataFrame) -> None:
    """Rows of the events in ``new`` give way to the new ones; only the folders of these events' ids are read and written."""
    new = cut_lineage(new)
    old = rows_of_ids(spark, root, name, new).select(*new.columns)
    merged = replace_tags(old, new) if name == "event_tags" else replace_by_key(old, new, ["event_id"])
    overwrite_folders(_foldered(cut_lineage(merged), name, ""), f"{root}/{name}", *FOLDERS[name])


def load_tables(spark: SparkSession, root: str, register: bool = True) -> dict[str, DataFrame]:
    """All event tables under ``root`` with their fixed schemas, also as temp views with the SQL functions over them."""
    tables = {name: read_table(spark, root, name) for name in TABLES}
    if register:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        register_functions(spark)
    return tables


def existing_tables(spark: SparkSession, root: str) -> list[str]:
    return [name for name in TABLES if exists(spark, f"{root}/{name}")]


#: Operators as SQL table functions over the registered tables: parameters, columns and body.
FUNCTIONS = {
    "upcoming_events": ("as_of STRING", TABLES["events"], "SELECT * FROM events WHERE date >= as_of"),
    "past_events": ("cutoff STRING", "title STRING, date STRING, time STRING", "SELECT title, date, time FROM events WHERE date < cutoff"),
    "events_between": (
        "date_from STRING, date_to STRING",
        TABLES["events"],
        "SELECT * FROM events WHERE date >= date_from AND date <= date_to",
    ),
    "events_at": ("place STRING", TABLES["events"], "SELECT * FROM events WHERE location ILIKE '%' || place || '%'"),
    "content_of_type": (
        "kind STRING",
        TABLES["enhanced_content"],
        "SELECT * FROM enhanced_content WHERE event_type ILIKE '%' || kind || '%'",
    ),
    "waiting_events": (
        "",
        "id BIGINT, title STRING, description STRING",
        """SELECT id, title, description FROM events WHERE NOT EXISTS (SELECT 1 FROM enhanced_content c
            WHERE c.event_id = events.id AND c.enhanced_description IS NOT NULL)""",
    ),
    "duplicate_events": (
        "",
        "title STRING, date STRING, count BIGINT",
        "SELECT title, date, count(*) AS count FROM events GROUP BY title, date HAVING count(*) > 1",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Makes ``FUNCTIONS`` callable from SQL, as ``SELECT * FROM upcoming_events('2025-01-01')``; the tables have to be registered."""
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """Parameterised SQL over the registered views and functions."""
    return spark.sql(query, args=params)
