"""Removal of byte strings that occur more than once, over all texts.

Content-sampled hash grouping in place of a suffix array: no triples, no recursion, no order of suffixes. A cover has to hold, for any two equal strings of the given length, a sampled place at the
same offset in both. A difference cover chosen by position does, at one place in ten or so; here the cover is chosen by content
(each window's place is the one whose next bytes, half a window's length, hash lowest in it), which takes one place in a hundred and
only its own text. Equal windows have the same place at the same offset, so the windows of a place are compared with those of equal
places only, in bins of neighbouring offsets:

1. each bin gets two names, for the bytes that all its windows share and for the bytes that any of them covers;
2. names are sorted and equal neighbours compared: windows whose covered bytes occur twice are all repeated, and
   windows whose shared bytes occur once are not;
3. the remaining windows, in bins that agree on the shared bytes but not on all, are merged with those of one bin of each
   repeated name, sorted by their whole string, and equal neighbours compared.

README.md says why not by position. Strings are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, dealt, mix, partitions, pieces, utf8
from .windows import Hashes, sliding

LENGTH = 400
BLOCK_BYTES, RANGE_BYTES = 8_000_000, 16_000_000
#: Bytes of text, or windows of one longer text, that are hashed at once.
SEGMENT = 1_000_000
#: Neighbouring offsets in a bin.
STEP = 32
#: Bits of the table of sampled strings that occur more than once; a hit by chance only adds work.
TABLE_BITS = 27
_SHARED, _COVERED, _WINDOW = 0, 1, 2


class _Bins(NamedTuple):
    """Bins of windows: first window and end in the segment, names of shared and covered bytes."""

    first: np.ndarray
    end: np.ndarray
    shared: np.ndarray
    covered: np.ndarray


class _Segment:
    """Windows of some whole texts, or of a part of one text."""

    def __init__(self, data: np.ndarray, valid: np.ndarray, length: int):
        self.length, self.gram = length, length // 2
        self.hashes = Hashes(data)
        grams = self.hashes.grams(self.gram)
        width = length - self.gram + 1
        least = sliding(grams, width, True)
        # A run of windows shares a place: it ends where the lowest value changes or the place falls out.
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1]) | (valid[1:] != valid[:-1])
        edges = np.append(np.flatnonzero(change), len(least))
        inside = valid[edges[:-1]]
        self.first, self.end = edges[:-1][inside], edges[1:][inside]
        self.places = np.empty(len(self.first), np.int64)
        ahead = np.arange(width)
        for a in range(0, len(self.first), 4096):
            some = self.first[a : a + 4096]
            self.places[a : a + 4096] = some + np.argmin(grams[some[:, None] + ahead], axis=1)
        self.grams = grams[self.places]

    def bins(self, chosen: np.ndarray) -> _Bins:
        first, end, places = self.first[chosen], self.end[chosen], self.places[chosen]
        step = max(1, min(STEP, self.length // 4))
        low, high = (places - end + 1) // step, (places - first) // step
        count = high - low + 1
        bin_ = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - low, count)
        first, end, places = (np.repeat(x, count) for x in (first, end, places))
        last = np.minimum(end - 1, places - bin_ * step)
        first = np.maximum(first, places - bin_ * step - step + 1)
        shared = self.hashes.of(places - bin_ * step, self.length - step + 1)
        covered = self.hashes.of(first, last - first + self.length)
        where = ((places - first) * (self.length + 1) + places - last).astype(np.uint64)
        return _Bins(first, last + 1, mix(shared + bin_.astype(np.uint64)), mix(covered + where))

    def windows(self, bins: _Bins, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All windows of the chosen bins, and their names."""
        size = (bins.end - bins.first)[chosen]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - bins.first[chosen], size)
        return at, self.hashes.of(at, self.length)


def _segments(data: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[int, _Segment]]:
    """Where each segment begins, and the segment; a text is cut at the same places whatever stands beside it."""
    ends = starts[1:]
    one = 0
    while one < len(ends):
        last = max(one + 1, int(np.searchsorted(ends, starts[one] + SEGMENT, "right")))
        begin, end = int(starts[one]), int(ends[last - 1])
        for a in range(begin, max(begin + 1, end - length + 1), SEGMENT if last == one + 1 else end - begin + 1):
            b = min(end, a + SEGMENT + length - 1)
            if b - a < length:
                continue
            valid = np.ones(b - a - length + 1, bool)
            for e in ends[one : last - 1] - a:
                valid[max(0, e - length + 1) : e] = False
            yield a, _Segment(data[a:b], valid, length)
        one = last


def _hits(segment: _Segment, bits: np.ndarray) -> np.ndarray:
    at = (segment.grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


class _Asked(NamedTuple):
    """Names of a block: sorted, how often each occurs there (two stands for more), and a value that goes with it."""

    keys: np.ndarray
    n: np.ndarray
    value: np.ndarray


def _unique(keys: np.ndarray, value: np.ndarray | None = None) -> _Asked:
    """With ``value``: the least one of each key, or 0 where a key has several (so those differ from any other)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.minimum(np.diff(np.append(begin, len(keys))), 2).astype(np.uint8)
    if value is None or not len(keys):
        return _Asked(keys[begin], n, np.zeros(0, np.uint64))
    value = value[order]
    least, most = np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin)
    return _Asked(keys[begin], n, np.where(least == most, least, np.uint64(0)))


_ASK = "block int, kind int, range int, keys binary, n binary, value binary"
_ASK_TYPES = {"block": pa.int32(), "kind": pa.int32(), "range": pa.int32(), "keys": pa.binary(), "n": pa.binary(), "value": pa.binary()}


def _message(block: int, asked: dict[int, _Asked], ranges: int) -> pa.Table:
    rows = {c: [] for c in _ASK_TYPES}
    for kind, a in asked.items():
        of = ((a.keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        cuts = np.searchsorted(of, np.arange(ranges + 1).astype(np.uint64))
        for r in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[r], cuts[r + 1])
            for c, v in zip(rows, (block, kind, r, *(x[part].tobytes() for x in a))):
                rows[c].append(v)
    return pa.table({c: pa.array(rows[c], t) for c, t in _ASK_TYPES.items()})


def _answer(asked: pa.Table) -> pa.Table:
    """For each name whether it occurs twice, and a second bit: shared bytes with different neighbours, or the first block of covered ones."""
    asked = asked.sort_by("block")
    keys = [np.frombuffer(k, np.uint64) for k in asked["keys"].to_pylist()]
    sizes = np.array([len(k) for k in keys])
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
    size = np.diff(np.append(begin, len(flat)))
    n = np.frombuffer(b"".join(asked["n"].to_pylist()), np.uint8)[order]
    again = np.add.reduceat(n.astype(np.int64), begin) > 1
    kind = asked["kind"][0].as_py()
    other = np.zeros(len(flat), bool)
    if kind == _SHARED:
        value = np.frombuffer(b"".join(asked["value"].to_pylist()), np.uint64)[order]
        least, most = np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin)
        other[order] = np.repeat((least != most) | (least == 0), size)
    elif kind == _COVERED:
        other[order[begin]] = True
    twice = np.empty(len(flat), bool)
    twice[order] = np.repeat(again, size)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    pack = lambda x: pa.array([np.packbits(x[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
    return pa.table(
        {"block": asked["block"], "kind": asked["kind"], "range": asked["range"], "size": pa.array(sizes, pa.int32()), "again": pack(twice), "other": pack(other)}
    )


_ANSWER = "block int, kind int, range int, size int, again binary, other binary"


def _answers(given: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Both bits for the names of a block, in their order."""
    given = given.filter(pa.compute.equal(given["kind"], kind)).sort_by("range")
    sizes = given["size"].to_pylist()
    return tuple(
        np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8))[:n] > 0 for b, n in zip(given[c].to_pylist(), sizes))])
        for c in ("again", "other")
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in the same text or another, is removed; ``kept`` are
    the other bytes. Overlaps count, matches never cross texts, and all is judged on the input. Null and empty texts have nothing to
    remove. Every row is a text of its own, also where ids are null or repeat. Other columns are not read.
    """
    assert length > 1
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).head()[0] or 1
    blocks = max(1, -(-total // BLOCK_BYTES))
    ranges = int(max(partitions(spark), -(-total // RANGE_BYTES)))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            for _, segment in _segments(*utf8(batch.column("text")), length):
                yield pa.record_batch([pa.array(segment.grams.view(np.int64))], names=["gram"])

    long_enough = rows.filter(F.octet_length("text") >= length)
    twice = long_enough.select("text").mapInArrow(sample, "gram long").groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    table = spark.sparkContext.broadcast(bit_table(twice, "gram", TABLE_BITS))
    rows = dealt(rows, blocks, BLOCK_BYTES).drop("drawn")

    def bins(texts: pa.Table) -> Iterator[tuple[int, _Segment, _Bins]]:
        data, starts = utf8(pa.concat_arrays(texts["text"].chunks))
        for a, segment in _segments(data, starts, length):
            yield a, segment, segment.bins(_hits(segment, table.value))

    def named(found: list[_Bins]) -> dict[int, _Asked]:
        shared, covered = (np.concatenate([np.zeros(0, np.uint64), *(getattr(b, c) for b in found)]) for c in ("shared", "covered"))
        return {_SHARED: _unique(shared, covered), _COVERED: _unique(covered)}

    def decided(found: list[_Bins], given: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each bin: are all its windows repeated, are they open, and do they answer for others of their name?"""
        names = named(found)
        covered, shared = _answers(given, _COVERED), _answers(given, _SHARED)
        for b in found:
            at = np.searchsorted(names[_COVERED].keys, b.covered)
            yes, first = (x[at] for x in covered)
            at = np.searchsorted(names[_SHARED].keys, b.shared)
            again, differ = (x[at] for x in shared)
            yield yes, ~yes & again, yes & first & differ

    def ask_names(texts: pa.Table) -> pa.Table:
        return _message(texts["block"][0].as_py(), named([b for _, _, b in bins(texts)]), ranges)

    def ask_windows(texts: pa.Table, given: pa.Table) -> pa.Table:
        if not texts.num_rows or not given.num_rows:
            return _message(0, {}, ranges)
        parts = list(bins(texts))
        out = [np.zeros(0, np.uint64)]
        for (_, segment, b), (_, is_open, answers) in zip(parts, decided([b for _, _, b in parts], given)):
            out.append(segment.windows(b, is_open | answers)[1])
        return _message(texts["block"][0].as_py(), {_WINDOW: _unique(np.concatenate(out))}, ranges)

    # All three steps take the same rows by block in one plan, and both readers of the answers the same questions: Spark shuffles
    # the texts, and the questions, once. Short texts come along, since without them the rows would be others; they hold no window.
    by_name = rows.groupBy("block").applyInArrow(ask_names, _ASK)
    by_name = by_name.groupBy("kind", "range").applyInArrow(_answer, _ANSWER)
    by_window = rows.groupBy("block").cogroup(by_name.groupBy("block")).applyInArrow(ask_windows, _ASK)
    by_window = by_window.groupBy("kind", "range").applyInArrow(_answer, _ANSWER)
    names_of = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def remove(texts: pa.Table, given: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        if not texts.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names_of)
        data, starts = utf8(pa.concat_arrays(texts["text"].chunks))
        edges = np.zeros(len(data) + 1, np.int32)
        if given.num_rows:
            parts = list(bins(texts))
            opened, asked = [], [np.zeros(0, np.uint64)]
            for (a, segment, b), (yes, is_open, answers) in zip(parts, decided([b for _, _, b in parts], given)):
                np.add.at(edges, a + b.first[yes], 1)
                np.add.at(edges, a + b.end[yes] + length - 1, -1)
                at, keys = segment.windows(b, is_open)
                opened.append((a + at, keys))
                asked += [keys, segment.windows(b, answers)[1]]
            keys, (again, _) = _unique(np.concatenate(asked)).keys, _answers(given, _WINDOW)
            for at, own in opened:
                at = at[again[np.searchsorted(keys, own)]]
                np.add.at(edges, at, 1)
                np.add.at(edges, at + length, -1)
        keep = np.cumsum(edges[:-1], dtype=np.int32) == 0
        out = []
        for a, b in zip(starts[:-1], starts[1:]):
            own = keep[a:b]
            kept = data[a:b][own].tobytes()
            spans = int((~own[1:] & own[:-1]).sum()) + int(b > a and not own[0])
            out.append((b - a, b - a - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        return pa.table([texts["doc_id"], *(pa.array(c, k) for c, k in zip(zip(*out), kinds[1:]))], names=names_of)

    given = by_name.unionByName(by_window).groupBy("block")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return rows.groupBy("block").cogroup(given).applyInArrow(remove, schema)
