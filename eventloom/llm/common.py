"""Helpers shared by the operators: stored tables, whole texts as byte buffers, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task; one longer text is a piece of its own.
PIECE_BYTES = 1_000_000


def materialize(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared checkpoint folder and reads it back.

    It cuts the lineage as ``checkpoint()`` does, survives the loss of executors, and later readers get column pruning.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


#: A key with more than one in this many of all rows is a hot one; so many of them there can be.
HOT_KEYS = 1000


def _by_heat(right: DataFrame, rows: str) -> tuple[DataFrame, DataFrame]:
    """Keys of more than a thousandth of the counted rows, which are fewer than a thousand whatever the data, and the others."""
    right = materialize(right)
    total = right.agg(F.sum(rows)).head()[0] or 0
    is_hot = F.col(rows) * HOT_KEYS > total
    return right.filter(is_hot).drop(rows), right.filter(~is_hot).drop(rows)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Inner join with ``right``, which holds each key once and in ``rows`` (dropped) how many rows of ``left`` have it.

    Hot keys are sent to all tasks, so no task gets all rows of one; the others meet in a shuffle.
    """
    hot, others = _by_heat(right, rows)
    met = left.join(F.broadcast(hot), keys)
    return met.unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(others, keys))


def without(left: DataFrame, right: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; both as for ``lookup``."""
    hot, others = _by_heat(right, rows)
    return left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(others.select(*keys), keys, "left_anti")


def dealt(rows: DataFrame, blocks: int, block_bytes: int) -> DataFrame:
    """``rows (doc_id, text, …)`` with ``drawn``, a hash that deals them out, and ``block``, one of ``blocks``.

    Copies of a text under one id share their hash; where such copies would overfill a block, each is dealt out by a number of its own.
    """
    name = F.xxhash64("doc_id", "text")
    sizes = rows.select(name.alias("name"), F.octet_length("text").alias("bytes")).groupBy("name").agg(
        F.count("*").alias("rows"), F.sum("bytes").alias("bytes")
    )
    many = materialize(sizes.filter((F.col("rows") > 1) & (F.col("bytes") > block_bytes)).drop("bytes"))
    named = rows.withColumn("name", name)
    if many.head(1):
        # Stored, so that the numbers stay the same whenever the rows are read.
        copies = materialize(lookup(named, many, ["name"], "rows").withColumn("copy", F.monotonically_increasing_id()))
        others = without(named, many, ["name"], "rows").withColumn("copy", F.lit(-1).cast("long"))
        named = others.unionByName(copies).withColumn("name", F.xxhash64("name", "copy")).drop("copy")
    return named.withColumnRenamed("name", "drawn").withColumn("block", F.pmod(F.col("drawn"), F.lit(blocks)).cast("int"))


def bit_table(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each value of the leading ``bits`` bits of a 64-bit column: built in parts by tasks, of the same size whatever the data."""
    of_chunk = min(20, bits - 3)
    bit = F.shiftrightunsigned(column, 64 - bits)
    marked = keys.select(F.shiftright(bit, of_chunk).cast("int").alias("chunk"), bit.bitwiseAND((1 << of_chunk) - 1).cast("int").alias("bit"))

    def fill(table: pa.Table) -> pa.Table:
        there = np.zeros(1 << of_chunk, bool)
        there[np.asarray(table["bit"])] = True
        return pa.table({"chunk": table["chunk"].slice(0, 1), "bits": pa.array([np.packbits(there, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (of_chunk - 3)
    for r in marked.distinct().groupBy("chunk").applyInArrow(fill, "chunk int, bits binary").toLocalIterator():
        out[r["chunk"] * size : (r["chunk"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each begins (one more entry than texts); nulls are empty."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        _, starts = utf8(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 1024)
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]), dtype=np.uint64)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b))


def word_spans(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; no word crosses the border of two texts."""
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    border = starts[:-1][starts[:-1] < len(data)]
    first[border] = inside[border]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = border[border > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word with A-Z lower-cased, and the index of its text."""
    begin, end = word_spans(data, starts, separators)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    length = end - begin
    place = np.arange(int(length.sum()), dtype=np.int64)
    offset = place - np.repeat(np.cumsum(length) - length, length)
    letters = LOWER[data[offset + np.repeat(begin, length)]].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(letters * _powers(int(length.max()))[offset], np.cumsum(length) - length)
    return mix(sums + length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), np.searchsorted(starts, begin, "right") - 1
