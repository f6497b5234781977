"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words under the ones of a fixed mask; the words under its zeros may differ. Test and training seeds
are joined on their hash, and around every hit the words of both sides are compared place by place: a document leaks an item if
some window of the item's words (``WINDOW``, or all of a shorter item) is found with at least ``LEAST_SIMILARITY`` of its
words equal. The masks lose no such window; ``tests/llm`` checks that over all patterns of substitutions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bit_table, materialize, pair_hash, pieces, utf8, word_hashes

WINDOW = 20
LEAST_SIMILARITY = 0.8
MASKS = ("110111", "1110101")
#: For items of 5 to WINDOW - 1 words; shorter ones are looked up whole.
SHORT_MASKS = ("11011", "1111", "1101", "1011", "111")
LEAST_WORDS = 5
#: Bits of the table that tells documents' words which seeds can occur in the benchmark; its size doesn't depend on the data.
TABLE_BITS = 27

PUNCTUATION = SPACES.copy()
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80), *range(0x00, 0x20)]] = True
_REACH = WINDOW - 1
_NONE_LEFT, _NONE_RIGHT = np.int32(0), np.int32(1)


def all_masks() -> list[str]:
    return [*MASKS, *SHORT_MASKS, *("1" * n for n in range(1, LEAST_WORDS))]


SPAN = max(map(len, all_masks()))
WIDTH = 2 * _REACH + SPAN


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, punctuation left out and A-Z in lower case, and the index of the text of each."""
    return word_hashes(*utf8(texts), PUNCTUATION)


def seeds(hashes: np.ndarray, owner: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes, and the place of the first word of each."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.full(n, number + 1, np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1":
            key = pair_hash(key, hashes[i : i + n])
    place = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return key[place], place


def contexts(hashes: np.ndarray, owner: np.ndarray, places: np.ndarray, missing: np.int32) -> pa.Array:
    """For each place the words from _REACH before it to _REACH behind a seed, as 32-bit hashes above 1."""
    at = places[:, None] + np.arange(-_REACH, WIDTH - _REACH)
    inside = (at >= 0) & (at < len(hashes))
    at = np.clip(at, 0, max(len(hashes) - 1, 0))
    inside &= owner[at] == owner[places][:, None]
    short = (hashes >> np.uint64(33)).astype(np.int32) | np.int32(2)
    values = np.where(inside, short[at], missing).astype("<i4")
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH * 4), len(places), [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _item_masks(length: int) -> list[int]:
    if length >= WINDOW:
        return list(range(len(MASKS)))
    if length >= LEAST_WORDS:
        return list(range(len(MASKS) + len(SHORT_MASKS)))
    return [len(MASKS) + len(SHORT_MASKS) + length - 1]


def whole_hashes(hashes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of all words of each text in order; 0 for a text without words."""
    place = np.arange(len(hashes)) - np.repeat(first, length)
    out = np.zeros(len(length), np.uint64)
    some = np.flatnonzero(length)
    if len(some):
        out[some] = np.add.reduceat(pair_hash(place.astype(np.uint64), hashes), first[some])
    return out


def item_seeds(items: DataFrame) -> DataFrame:
    """``seed, place, length, around`` of all items; ``class_1, class_2``, which name these four; ``item_id`` and ``whole``, a hash of
    the item's words. Items that hold the same words around the same place share a class there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = all_masks()
        for batch in pieces(batches, "text"):
            ids = batch.column("item_id")
            hashes, owner = words(batch.column("text"))
            length = np.bincount(owner, minlength=len(ids))
            first = np.searchsorted(owner, np.arange(len(ids)))
            whole = whole_hashes(hashes, first, length).view(np.int64)
            for number, mask in enumerate(masks):
                used = np.array([number in _item_masks(int(n)) if n else False for n in length], bool)
                key, place = seeds(hashes, owner, mask, number)
                if len(mask) < LEAST_WORDS and number >= len(MASKS) + len(SHORT_MASKS):
                    used &= length == len(mask)
                keep = used[owner[place]]
                key, place = key[keep], place[keep]
                of = owner[place]
                yield pa.record_batch(
                    [
                        pa.array(key.view(np.int64)),
                        ids.take(pa.array(of)),
                        pa.array(place - first[of], pa.int32()),
                        pa.array(length[of], pa.int32()),
                        contexts(hashes, owner, place, _NONE_RIGHT),
                        pa.array(whole[of]),
                    ],
                    names=["seed", "item_id", "place", "length", "around", "whole"],
                )

    found = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    rows = found.mapInArrow(run, "seed long, item_id long, place int, length int, around binary, whole long")
    name = lambda i: F.xxhash64(F.lit(i), "seed", "place", "length", "around").alias(f"class_{i}")
    return rows.select("*", name(1), name(2))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document that leaks an item: ``doc_id, item_id, n_equal, n_window, similarity, word``.

    ``similarity`` is that of the best window (equal words, of ``n_window``), ``word`` where its alignment first hits in the
    document. Null and empty texts leak nothing; rows of one id are one document; a null id is an id of its own, of a document as of
    an item. Every item that a document leaks is reported, also where items share the passage; items of equal words are one, under their
    smallest id, and one without words is leaked by none. Other columns are not read.
    """
    known = materialize(item_seeds(items))
    names = ["class_1", "class_2"]
    # Each class is compared once; what it finds is every member's.
    ids = known.groupBy("whole", "length").agg(F.min("item_id").alias("item_id"))
    members = known.select(*names, "whole", "length").distinct().join(ids, ["whole", "length"]).select(*names, "item_id")
    classes = known.drop("item_id", "whole").dropDuplicates(names)
    can_occur = docs.sparkSession.sparkContext.broadcast(bit_table(known, "seed", TABLE_BITS))
    lengths = {r[0] for r in known.select(F.least("length", F.lit(WINDOW))).distinct().collect()}
    numbers = sorted({m for n in lengths for m in _item_masks(n)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, there = all_masks(), can_occur.value
        for batch in pieces(batches, "text"):
            ids = batch.column("doc_id")
            hashes, owner = words(batch.column("text"))
            first = np.searchsorted(owner, np.arange(batch.num_rows))
            for number in numbers:
                key, place = seeds(hashes, owner, masks[number], number)
                at = (key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
                keep = (there[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                key, place = key[keep], place[keep]
                for part in range(0, len(key), 20_000):
                    k, p = key[part : part + 20_000], place[part : part + 20_000]
                    yield pa.record_batch(
                        [
                            pa.array(k.view(np.int64)),
                            ids.take(pa.array(owner[p])).cast(pa.int64()),
                            pa.array(p - first[owner[p]], pa.int64()),
                            contexts(hashes, owner, p, _NONE_LEFT),
                        ],
                        names=["seed", "doc_id", "word", "seen"],
                    )

    hits = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "seed long, doc_id long, word long, seen binary"
    )
    met = hits.join(classes, "seed").select("doc_id", *names, "word", "place", "length", "seen", "around")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            side = [np.frombuffer(utf8(batch.column(c))[0].tobytes(), "<i4").reshape(-1, WIDTH) for c in ("seen", "around")]
            equal = np.cumsum(np.pad(side[0] == side[1], ((0, 0), (1, 0))), axis=1, dtype=np.int32)
            length = np.asarray(batch.column("length")).astype(np.int64)
            place = np.asarray(batch.column("place")).astype(np.int64)
            window = np.minimum(length, WINDOW)
            best = np.zeros(len(window), np.int64)
            for n in np.unique(window):
                rows = np.flatnonzero(window == n)
                sums = equal[rows][:, n:] - equal[rows][:, :-n]
                # Windows inside the item only: column c is word place - _REACH + c of it.
                start = place[rows][:, None] - _REACH + np.arange(sums.shape[1])
                best[rows] = np.where((start >= 0) & (start + n <= length[rows][:, None]), sums, 0).max(1)
            least = np.where(window < LEAST_WORDS, window, np.ceil(window * LEAST_SIMILARITY - 1e-9))
            good = pa.array(best >= least)
            kept = ["doc_id", *names, "word"]
            found = [*(batch.column(c) for c in kept), pa.array(best), pa.array(window)]
            yield pa.record_batch(found, names=[*kept, "n_equal", "n_window"]).filter(good)

    def best(found: DataFrame, *keys: str) -> DataFrame:
        return found.groupBy("doc_id", *keys).agg(
            F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"), F.min("word").alias("word")
        )

    schema = "doc_id long, class_1 long, class_2 long, word long, n_equal long, n_window long"
    return (
        best(best(met.mapInArrow(verify, schema), *names).join(members, names), "item_id")
        .select("doc_id", "item_id", "n_equal", "n_window", "word")
        .withColumn("similarity", F.col("n_equal") / F.col("n_window"))
    )
