"""Packing of tokenised documents into windows of fixed length.

Whole windows are cut from each document; what remains is shorter than a window. Combinations of two or three such
lengths that fill a window exactly are enumerated, all of them, and their repeat counts are the non-negative least-squares fit to the
histogram of lengths. The fit grows by columns: combinations are priced by what the histogram has left over, the best-priced join
the fit, and it ends when none would improve it. The rounded counts say which documents share a window. What is left over is
laid end to end and cut at window borders, so that one window at most is padded. The driver sees the histogram alone, a
number per length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from .common import materialize, pieces

WINDOW = 1024
END = 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Combinations that join the fit at once.
JOINING = 256
#: The fit of the combinations at hand ends when a sweep moves counts by less than this share of all lengths.
STILL = 1e-3
#: Rows numbered in one task.
BUCKET_ROWS = 50_000

class TextIds:
    """Ids of texts by a vocabulary of byte pairs, given as merge ranks and as the tokenizer's own file.

    The ranks are the same vocabulary and several times faster to use than the file's own reader, which is kept for texts that
    spell a special token.
    """

    def __init__(self, name: str, ranks: str):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(ranks), "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def of(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit values, with END behind."""
        if any(s in text for s in self.special):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        else:
            ids = self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return ids.tobytes() + END.to_bytes(4, "little")


def combinations(window: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """All combinations of two or three lengths in ascending order that fill the window, of those present."""
    there = present > 0
    a, b = np.divmod(np.arange(window * window), window)
    rows = np.stack([a, b, window - a - b], 1)[(a <= b) & (a + 2 * b <= window) & (b > 0)]
    rows = rows[(there[rows] | (rows == 0)).all(1)]
    return [tuple(row[row[0] == 0 :]) for row in rows.tolist()]


def _refit(left: np.ndarray, fit: dict[int, float], combos: np.ndarray, least: float) -> None:
    """Non-negative least squares over the combinations in ``fit``, by cyclic coordinate descent; ``left`` is what they leave."""
    parts = [(i, *np.unique(combos[i][combos[i] > 0], return_counts=True)) for i in fit]
    parts = [(i, x.tolist(), m.tolist(), sum(m * m)) for i, x, m in parts]
    moved = np.inf
    while moved > least:
        moved = 0.0
        for i, lengths, times, square in parts:
            step = max(sum(m * left[x] for x, m in zip(lengths, times)) / square, -fit[i])
            if step:
                fit[i] += step
                moved += abs(step)
                for x, m in zip(lengths, times):
                    left[x] -= m * step


def fitted(histogram: np.ndarray, combos: np.ndarray) -> dict[int, float]:
    """Repeat counts of the combinations that the least-squares fit uses.

    A combination's price is the gradient of the fit, the sum of what is left of its lengths. Those of the highest prices join until no
    price would gain a whole window.
    """
    left, fit = histogram.astype(float), {}
    left[0] = 0.0
    least = STILL * max(1.0, float(histogram.sum()))
    while True:
        price = left[combos].sum(1) / (combos > 0).sum(1)
        price[list(fit)] = 0.0
        best = np.argsort(-price, kind="stable")[:JOINING]
        best = best[price[best] >= 1.0]
        if not len(best):
            return fit
        fit.update((int(i), 0.0) for i in best)
        _refit(left, fit, combos, least)


def repeat_counts(histogram: np.ndarray, combos: list[tuple[int, ...]]) -> np.ndarray:
    """How often each combination is used: fitted, rounded and held to the lengths at hand, then again on what is left."""
    rows = np.array([(0,) * (3 - len(c)) + tuple(c) for c in combos], np.int64).reshape(-1, 3)
    at_hand, counts = histogram.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
    placed = 1
    while placed > counts.sum() // 100:
        usable = np.flatnonzero(((at_hand[rows] >= 1) | (rows == 0)).all(1))
        placed = 0
        for k, value in sorted(fitted(at_hand, rows[usable]).items(), key=lambda f: (-f[1], f[0])):
            i = usable[k]
            lengths, times = np.unique(rows[i][rows[i] > 0], return_counts=True)
            n = min(round(value), int((at_hand[lengths] // times).min()))
            counts[i] += n
            at_hand[lengths] -= times * n
            placed += n
    return counts


def tokenized(docs: DataFrame, doc_id: str, text: str, tokenizer: str, ranks: str, window: int) -> DataFrame:
    """Stored, for each row: ``row`` (its number), ``doc_id, tokens``, CRCs of its whole windows, length, CRC and ids of its tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = TextIds(tokenizer, ranks)
        row = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text"):
            tokens, crcs, lengths, tail_crcs, tails = [], [], [], [], []
            for value in batch.column("text").to_pylist():
                ids = texts.of(value or "")
                n = len(ids) // 4
                full = n // window
                tokens.append(n)
                crcs.append([zlib.crc32(ids[4 * i * window : 4 * (i + 1) * window]) for i in range(full)])
                tail = ids[4 * full * window :]
                lengths.append(n - full * window)
                tail_crcs.append(zlib.crc32(tail))
                tails.append(tail)
            rows = np.arange(row, row + len(tokens))
            row += len(tokens)
            yield pa.record_batch(
                [
                    pa.array(rows),
                    batch.column("doc_id"),
                    pa.array(tokens, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(lengths, pa.int32()),
                    pa.array(tail_crcs, pa.int64()),
                    pa.array(tails, pa.binary()),
                ],
                names=["row", "doc_id", "tokens", "crcs", "tail_length", "tail_crc", "tail"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialize(
        rows.mapInArrow(run, "row long, doc_id long, tokens long, crcs array<long>, tail_length int, tail_crc long, tail binary")
    )


def _starts(rows: DataFrame, amount: str, into: str, *group: str) -> DataFrame:
    """Adds the sum of ``amount`` over the rows before, by ``bucket`` and row; per ``group`` if given.

    Each bucket is summed by itself and moved by the sums of the buckets before it.
    """
    totals = rows.groupBy(*group, "bucket").agg(F.sum(amount).alias("total"))
    # One row for each bucket: BUCKET_ROWS times fewer than rows.
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    moved = totals.select(*group, "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("moved"))
    inside = Window.partitionBy(*group, "bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn(into, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(moved, [*group, "bucket"])
        .withColumn(into, (F.col(into) + F.col("moved")).cast("long"))
        .drop("moved")
    )


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    ranks: str = RANKS,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every row of ``docs`` is a document of its own, also where ids are null or repeat. A null text is an empty one; an empty
    text is its end token alone. An empty table gives no pieces. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = tokenized(docs, doc_id, text, tokenizer, ranks, window)
    histogram = np.zeros(window, np.int64)
    for r in rows.groupBy("tail_length").agg(F.count("*").alias("n")).collect():
        histogram[r["tail_length"]] = r["n"]
    n_rows, histogram[0] = int(histogram.sum()), 0
    buckets = max(1, -(-n_rows // BUCKET_ROWS))
    light = rows.drop("tail").withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))

    light = light.withColumn("full", F.size("crcs").cast("long"))
    n_full = light.agg(F.sum("full")).head()[0] or 0
    long_ones = _starts(light.filter("full > 0"), "full", "first")
    whole = long_ones.select("doc_id", "tokens", "first", F.posexplode("crcs").alias("i", "ids_crc32")).select(
        "doc_id",
        (F.col("i") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        "tokens",
        (F.col("first") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    combos = combinations(window, histogram)
    slots, taken, sequence = [], np.zeros(window, np.int64), n_full
    counts = repeat_counts(histogram, combos)
    for i in np.flatnonzero(counts):
        offset, count = 0, int(counts[i])
        for length in combos[i]:
            slots.append((length, int(taken[length]), int(taken[length]) + count, int(sequence), offset))
            taken[length] += count
            offset += length
        sequence += count
    # At most three rows for each combination of lengths, whatever the data: small enough to send to every task.
    places = F.broadcast(spark.createDataFrame(slots, "slot_length int, low long, high long, first_sequence long, slot_offset long"))
    tails = light.filter("tail_length > 0").select(
        "row", "doc_id", "tokens", "tail_length", "tail_crc", "bucket", F.lit(1).alias("one")
    )
    ranked = _starts(tails, "one", "rank", "tail_length")
    on = (F.col("tail_length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = materialize(ranked.join(places, on, "left"))
    begin = F.col("tokens") - F.col("tail_length")
    combined = placed.filter("low IS NOT NULL").select(
        "doc_id",
        begin.alias("start"),
        F.col("tail_length").cast("long").alias("length"),
        F.col("tail_crc").alias("ids_crc32"),
        "tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("low")).alias("sequence_id"),
        F.col("slot_offset").alias("offset"),
    )

    left = _starts(placed.filter("low IS NULL").select(*tails.columns), "tail_length", "at")
    laid = left.withColumn("offset", F.col("at") % window).withColumn("sequence_id", F.floor(F.col("at") / window) + int(sequence))
    uncut = laid.filter(F.col("offset") + F.col("tail_length") <= window).select(
        "doc_id",
        begin.alias("start"),
        F.col("tail_length").cast("long").alias("length"),
        F.col("tail_crc").alias("ids_crc32"),
        "tokens",
        "sequence_id",
        "offset",
    )

    names = uncut.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, split = r["tail"], window - r["offset"]
                start = r["tokens"] - len(ids) // 4
                out.append((r["doc_id"], start, split, zlib.crc32(ids[: 4 * split]), r["tokens"], r["sequence_id"], r["offset"]))
                rest = len(ids) // 4 - split
                out.append((r["doc_id"], start + split, rest, zlib.crc32(ids[4 * split :]), r["tokens"], r["sequence_id"] + 1, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 7, names=names)

    crossing = laid.filter(F.col("offset") + F.col("tail_length") > window).select("row", "doc_id", "tokens", "sequence_id", "offset")
    both = crossing.join(rows.select("row", "tail"), "row").drop("row")
    schema = "doc_id long, start long, length long, ids_crc32 long, tokens long, sequence_id long, offset long"
    parts = whole.unionByName(combined).unionByName(uncut).unionByName(both.mapInArrow(cut, schema))
    return parts.withColumnRenamed("tokens", "doc_tokens")
