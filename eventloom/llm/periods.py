"""Periodic runs: stretches of words that repeat themselves with some period, found by internal pattern matching.

The texts of a task are one sequence of words in which no word of one text equals a word of another. Names of all blocks of one, two, four …
words come from prefix doubling, which ends in the suffix array; blocks of equal name are neighbours there. A run of period q holds, for the
largest power of two B up to (q + 1) / 2, a block of B words that starts at a multiple of B, and its copy q words on. So each such
block that occurs again asks for its occurrences in the neighbouring windows, by range successor in a wavelet tree over the suffix
array. Within a window they are an arithmetic progression, whose members are candidate periods; of a progression of three or more, which lies in a
run of its own difference, only those matter that fit the ends of the runs around it. Candidates are extended to both
sides as far as their period holds, by the names of blocks. The least period of each stretch stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, utf8, word_spans

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2
#: What separates words, as a pattern.
SEPARATORS = r"[\x20\x09-\x0D]+"


class WaveletTree:
    """Values below ``limit`` by place, with counts of zeros for each bit; queries come as arrays of ranges of places."""

    def __init__(self, values: np.ndarray, limit: int):
        self.limit = limit
        self.bits = list(range(max(1, limit.bit_length()) - 1, -1, -1))
        self.zeros = []
        for bit in self.bits:
            one = (values >> bit) & 1 > 0
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of each range are below ``value``."""
        found, value = np.zeros(len(low), np.int64), np.minimum(value, self.limit)
        for bit, zeros in zip(self.bits, self.zeros):
            a, b = zeros[low], zeros[high]
            one = (value >> bit) & 1 > 0
            found += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return found

    def at(self, low: np.ndarray, high: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The value of each range that so many others come before."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.zeros):
            a, b = zeros[low], zeros[high]
            one = order >= b - a
            found |= np.where(one, 1 << bit, 0)
            order = np.where(one, order - (b - a), order)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return found

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least value of each range from ``value`` on; where there is none, more than any."""
        before = self.below(low, high, value)
        found = np.full(len(low), np.iinfo(np.int64).max)
        some = np.flatnonzero(before < high - low)
        found[some] = self.at(low[some], high[some], before[some])
        return found

    def predecessor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The greatest value of each range up to ``value``; there has to be one."""
        return self.at(low, high, self.below(low, high, value + 1) - 1)


def _starts_of(changes: np.ndarray) -> np.ndarray:
    """For each place the last one at or before it where ``changes`` holds."""
    return np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))


class Blocks:
    """Names of all blocks of 1, 2, 4 … symbols: where a block's name first stands among all suffixes in order.

    The last symbol has to occur once. Names of the last level are all different, so they are the order of suffixes.
    """

    def __init__(self, symbols: np.ndarray):
        order = np.argsort(symbols, kind="stable")
        changes = np.append(True, symbols[order][1:] != symbols[order][:-1])
        name = np.empty(len(symbols), np.int32)
        name[order] = _starts_of(changes)
        self.names = [name]
        sizes = np.diff(np.append(np.flatnonzero(changes), len(symbols)))
        open_ = np.sort(order[np.repeat(sizes > 1, sizes)])
        length = 1
        while len(open_):
            # A block that occurs twice ends before the last symbol, so there is one behind it.
            first, second = name[open_].astype(np.int64), name[open_ + length]
            order = np.argsort(first * len(symbols) + second, kind="stable")
            first, second = first[order], second[order]
            groups = np.append(True, first[1:] != first[:-1])
            changes = groups | np.append(True, second[1:] != second[:-1])
            name = name.copy()
            name[open_[order]] = first + _starts_of(changes) - _starts_of(groups)
            self.names.append(name)
            sizes = np.diff(np.append(np.flatnonzero(changes), len(order)))
            open_ = np.sort(open_[order][np.repeat(sizes > 1, sizes)])
            length *= 2
        self.suffixes = np.empty(len(symbols), np.int64)
        self.suffixes[name] = np.arange(len(symbols))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are the same; a and b differ."""
        same = np.zeros(len(a), np.int64)
        last = len(self.suffixes) - 1
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            x, y = np.minimum(a + same, last), np.minimum(b + same, last)
            same += np.where((name[x] == name[y]) & (x != y), 1 << level, 0)
        return same

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are the same."""
        same = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            x, y = a - same - (1 << level), b - same - (1 << level)
            inside = (x >= 0) & (y >= 0)
            same += np.where(inside & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)]), 1 << level, 0)
        return same


def _stretch(blocks: Blocks, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of the longest stretch around ``at`` that keeps the period."""
    return at - blocks.behind(at, at + period), at + period + blocks.ahead(at, at + period)


def _members(first: np.ndarray, step: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All members of the progressions, one after another."""
    order = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + order * np.repeat(step, count)


def candidates(blocks: Blocks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods such that every run has one of them."""
    n = len(blocks.suffixes)
    if len(blocks.names) < 3:
        return
    # Only what starts a block of two that occurs again can be an occurrence.
    name = blocks.names[1]
    repeated = np.bincount(name, minlength=n)[name][blocks.suffixes] > 1
    before = np.concatenate([[0], np.cumsum(repeated)])
    tree = WaveletTree(blocks.suffixes[repeated], n)
    for level in range(1, len(blocks.names) - 1):
        size, name = 1 << level, blocks.names[level]
        place = np.arange(0, n, size)
        copies = np.bincount(name, minlength=n)[name[place]]
        place, copies = place[copies > 1], copies[copies > 1]
        low, high = before[name[place]], before[name[place] + copies]
        # Blocks of two serve all periods up to six, in runs of twelve words or more.
        for ahead in range(1 if level == 1 else 2 * size - 1, 4 * size - 1, size):
            last = place + ahead + size - 1
            one = tree.successor(low, high, place + ahead)
            here = np.flatnonzero(one <= last)
            x, a, b, one, last = place[here], low[here], high[here], one[here], last[here]
            two = tree.successor(a, b, one + 1)
            several = two <= last
            yield x[~several], (one - x)[~several]
            x, a, b, one, two, last = (v[several] for v in (x, a, b, one, two, last))
            if not len(x):
                continue
            step = two - one
            count = (tree.predecessor(a, b, last) - one) // step + 1
            few = count == 2
            yield np.concatenate([x[few], x[few]]), np.concatenate([(one - x)[few], (two - x)[few]])
            x, one, step, count = (v[~few] for v in (x, one, step, count))
            # The block and the progression each lie in a run of the progression's difference.
            (from_0, to_0), (from_1, to_1) = _stretch(blocks, x, step), _stretch(blocks, one, step)
            apart = from_0 != from_1
            for period in (from_1 - from_0, to_1 - to_0):
                fits = apart & (period > 0)
                yield x[fits], period[fits]
            meet = apart & (to_0 >= from_1)
            yield np.repeat(x[meet], count[meet]), _members((one - x)[meet], step[meet], count[meet])


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, end and least period of every run, in order of place, then period. The last symbol has to occur once."""
    blocks = Blocks(symbols)
    found = []
    for place, period in candidates(blocks):
        inside = place + period < len(symbols)
        place, period = place[inside], period[inside]
        start, end = _stretch(blocks, place, period)
        long_enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.unique(np.stack([start, end, period])[:, long_enough], axis=1))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    # Of the periods of a stretch the least divides the others.
    start, end, period = np.unique(np.concatenate(found, axis=1), axis=1)
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batch(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    data, starts = utf8(texts)
    begin, end = word_spans(data, starts)
    owner = np.searchsorted(starts, begin, "right") - 1
    length = end - begin
    at = np.concatenate([[0], np.cumsum(length)])
    letters = data[np.arange(at[-1]) + np.repeat(begin - at[:-1], length)] if len(length) else data[:0]
    words = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))])
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    # One symbol of its own behind each text, so no block crosses texts.
    symbols = np.empty(len(length) + len(ids), np.int64)
    n_words = np.bincount(owner, minlength=len(ids))
    borders = np.cumsum(n_words + 1) - 1
    places = np.arange(len(length)) + owner
    symbols[borders] = -1 - np.arange(len(ids))
    symbols[places] = owner * (int(codes.max(initial=0)) + 1) + codes
    start, stop, period = runs(symbols) if len(symbols) else (np.zeros(0, np.int64),) * 3
    of = np.searchsorted(borders, start)
    edges = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, stop, -1)
    stays = (np.cumsum(edges)[:-1] == 0)[places]
    # Kept words with a space behind each; a text's last space is left out.
    kept_length, kept_begin = length[stays] + 1, begin[stays]
    to = np.concatenate([[0], np.cumsum(kept_length)])
    joined = np.full(int(to[-1]), 32, np.uint8)
    place = np.arange(int(to[-1])) - np.repeat(to[:-1], kept_length)
    inside = place < np.repeat(kept_length - 1, kept_length)
    joined[inside] = data[(place + np.repeat(kept_begin, kept_length))[inside]]
    cuts = to[np.searchsorted(owner[stays], np.arange(len(ids) + 1))].tolist()
    buffer = joined.tobytes()
    collapsed = [buffer[x : max(x, y - 1)] for x, y in zip(cuts[:-1], cuts[1:])]
    rows = pa.StructArray.from_arrays(
        [pa.array(start - (borders - n_words)[of]), pa.array(stop - start), pa.array(period)], fields=list(_RUN)
    )
    offsets = np.searchsorted(of, np.arange(len(ids) + 1)).astype(np.int32)
    return pa.record_batch(
        [ids, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), rows), pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are maximal runs without ASCII white space, compared byte by byte. ``runs`` holds (start, length, period) of every stretch
    of words of least period q and at least ``LEAST_WORDS`` words and two periods that no neighbouring word extends, by start, then
    period; ``collapsed`` are the words that no run contains behind its first period, joined by single spaces. Null and empty texts have no
    word. Every row is a text of its own, also where ids are null or repeat. A text of any length is handled whole, in one
    task, in some 200 bytes a word. Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            if batch.num_rows:
                yield _batch(batch.column("doc_id"), batch.column("text"))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, schema)


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one text in ten, by the checksum of its id, repeats a stretch of its words from some word on; a null id none."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", checksum.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    words = F.filter(F.split("text", SEPARATORS), lambda w: w != "")
    rows = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def word(own: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), own).otherwise(F.col("words")[(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")])

    planted = F.array_join(F.transform("words", word), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest (first of several, then of least period), and hashes of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
