"""SimHash fingerprints and exact linking of those at two or fewer differing bits.

The index is hierarchical in Gray order: fingerprints that follow each other by Gray rank share most bits, so a node keeps the
bits its whole group shares (a mask and a pattern) and the search walks pairs of nodes from the top, adding up differing
shared bits, and drops a pair of groups as soon as they exceed the limit. The upper nodes of all fingerprints are the
bits of two parts out of four: of two fingerprints that differ in two bits, two parts at least are equal, so each
fingerprint joins the groups of six masked patterns and no link is missed. A group too large for one task is cut along the
Gray order and its blocks are compared pair by pair, where their shared bits don't rule that out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, materialize, pieces, utf8, word_spans
from .components import min_labels, spanning_stars

SHINGLE = 3
DISTANCE = 2
PARTS = 4
#: Fingerprints of one masked pattern that one task compares; larger groups are cut into blocks of about this many.
BLOCK_ROWS = 20_000
LEAF = 16


def fingerprints(texts: pa.Array) -> np.ndarray:
    """SimHash of each text: bit b is set if it is set in over half of the XXH64 of all word 3-grams."""
    data, starts = utf8(texts)
    data = LOWER[data]
    begin, end = word_spans(data, starts)
    owner = np.searchsorted(starts, begin, "right") - 1
    # The words of all texts, joined by single spaces: a shingle is then one slice.
    length = end - begin
    at = np.concatenate([[0], np.cumsum(length + 1)])
    joined = np.full(int(at[-1]), 32, np.uint8)
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    joined[place + np.repeat(at[:-1], length)] = data[place + np.repeat(begin, length)]
    buffer = joined.tobytes()
    first = np.searchsorted(owner, np.arange(len(texts)))
    count = np.bincount(owner, minlength=len(texts))
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i in np.flatnonzero(count):
        a, n = int(first[i]), int(count[i])
        last = min(n, SHINGLE) - 1
        lows = at[a : a + n - last].tolist()
        highs = (at[a + last + 1 : a + n + 1] - 1).tolist()
        hashes = np.fromiter((digest(buffer[x:y], 42) for x, y in zip(lows, highs)), np.uint64, len(lows))
        ones = np.zeros(64, np.int64)
        for part in range(0, len(hashes), 65_536):
            chunk = hashes[part : part + 65_536]
            ones += np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def part_masks() -> list[int]:
    """The six masks that keep two of four 16-bit parts."""
    parts = [0xFFFF << (16 * i) for i in range(PARTS)]
    return [parts[i] | parts[j] for i, j in combinations(range(PARTS), PARTS - DISTANCE)]


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From leaves of LEAF codes in Gray order up to one root: the mask of shared bits and their pattern."""
    bounds = np.arange(0, len(codes), LEAF)
    all_set, any_set = np.bitwise_and.reduceat(codes, bounds), np.bitwise_or.reduceat(codes, bounds)
    out = [(~(all_set ^ any_set), all_set)]
    while len(out[-1][0]) > 1:
        bounds = np.arange(0, len(all_set), 4)
        all_set, any_set = np.bitwise_and.reduceat(all_set, bounds), np.bitwise_or.reduceat(any_set, bounds)
        out.append((~(all_set ^ any_set), all_set))
    return out


def _children(nodes: np.ndarray, fan: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node its children, and which node each is of."""
    of = np.repeat(np.arange(len(nodes)), fan)
    child = np.repeat(nodes * fan, fan) + np.tile(np.arange(fan), len(nodes))
    inside = child < size
    return of[inside], child[inside]


def close_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of index pairs of codes at DISTANCE or fewer differing bits; both sides are in Gray order.

    With ``same``, both sides are one and each pair comes once.
    """
    if not len(left) or not len(right):
        return
    a, b = _levels(left), _levels(right)
    top = max(len(a), len(b)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        (mask_a, bits_a), (mask_b, bits_b) = a[min(level, len(a) - 1)], b[min(level, len(b) - 1)]
        apart = np.bitwise_count((bits_a[i] ^ bits_b[j]) & mask_a[i] & mask_b[j])
        keep = (apart <= DISTANCE) & ((i <= j) if same else True)
        i, j = i[keep], j[keep]
        for part in range(0, len(i), 4096):
            x, y = i[part : part + 4096], j[part : part + 4096]
            if level:
                down_a = level < len(a)
                down_b = level < len(b)
                of, child = _children(x, 4, len(a[level - 1][0])) if down_a else (np.arange(len(x)), x)
                x, y = child, y[of]
                of, child = _children(y, 4, len(b[level - 1][0])) if down_b else (np.arange(len(y)), y)
                stack.append((level - 1, x[of], child))
            else:
                of, child = _children(x, LEAF, len(left))
                x, y = child, y[of]
                of, child = _children(y, LEAF, len(right))
                x, y = x[of], child
                near = (np.bitwise_count(left[x] ^ right[y]) <= DISTANCE) & ((x < y) if same else True)
                if near.any():
                    yield x[near], y[near]


def _stars(codes: np.ndarray, other: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group, or between two blocks of a group, as stars: fewer than codes, same connections."""
    codes = codes[np.argsort(gray_rank(codes))]
    if other is None:
        found = list(close_pairs(codes, codes, True))
        nodes = codes
    else:
        other = other[np.argsort(gray_rank(other))]
        found = [(x, y + len(codes)) for x, y in close_pairs(codes, other, False)]
        nodes = np.concatenate([codes, other])
    if not found:
        return nodes[:0], nodes[:0]
    root = min_labels(len(nodes), np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; emits the stars of each. A group has at most a few blocks of rows."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.RecordBatch | pa.Table) -> pa.RecordBatch | None:
        key = np.stack([np.asarray(rows.column(c)) for c in ("mask", "pattern", "low", "high")])
        code, side = np.asarray(rows.column("code")).view(np.uint64), np.asarray(rows.column("block"))
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        cuts = np.concatenate([[0], cuts, [key.shape[1]]])
        out = []
        for x, y in zip(cuts[:-1], cuts[1:]):
            if y - x > 1:
                low, high = key[2, x], key[3, x]
                one = code[x:y][side[x:y] == low]
                out.append(_stars(one, None if low == high else code[x:y][side[x:y] == high]))
        if not out:
            return None
        return pa.record_batch({n: pa.array(np.concatenate([o[k] for o in out]).view(np.int64)) for k, n in enumerate(("a", "b"))})

    def ready(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        end = rows.num_rows
        if not last:
            key = np.stack([np.asarray(rows.column(c)) for c in ("mask", "pattern", "low", "high")])
            changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0))
            end = int(changes[-1]) + 1 if len(changes) else 0
        found = solve(rows.slice(0, end)) if end else None
        held[:] = rows.slice(end).to_batches()
        if found is not None:
            yield found

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if len(held) > 8:
                yield from ready(False)
    if held:
        yield from ready(True)


def links(codes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stars ``(a, b)`` that connect all distinct ``code`` values at DISTANCE or fewer bits, directly or through others."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in part_masks()])
    grouped = codes.select("code", F.posexplode(masks).alias("mask", "bits")).select(
        "code", "mask", F.col("code").bitwiseAND(F.col("bits")).alias("pattern")
    )
    rank = F.col("code")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    sizes = grouped.groupBy("mask", "pattern").agg(F.count("*").alias("n")).filter("n > 1")
    hot = materialize(sizes.filter(F.col("n") > block_rows))
    small = grouped.join(sizes.filter(F.col("n") <= block_rows).drop("n"), ["mask", "pattern"])
    rows = small.select("code", "mask", "pattern", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("block"))
    if hot.head(1):
        # As a signed value the rank keeps codes of equal leading bits together, which is all that blocks need.
        ranked = grouped.join(hot, ["mask", "pattern"]).withColumn("rank", rank)
        cuts = _block_cuts(ranked, block_rows)
        blocks = materialize(
            ranked.join(cuts, ["mask", "pattern"]).select(
                "code", "mask", "pattern", F.expr("size(filter(cuts, c -> c < rank))").alias("block")
            )
        )
        nodes = blocks.groupBy("mask", "pattern", "block").agg(F.bit_and("code").alias("all"), F.bit_or("code").alias("any"))
        one, two = nodes.withColumnsRenamed({"block": "low", "all": "all1", "any": "any1"}), nodes.withColumnsRenamed(
            {"block": "high", "all": "all2", "any": "any2"}
        )
        pairs = one.join(two, ["mask", "pattern"]).filter(
            "low <= high AND bit_count((all1 ^ all2) & ~(all1 ^ any1) & ~(all2 ^ any2)) <= " + str(DISTANCE)
        )
        sides = pairs.select("mask", "pattern", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
        rows = rows.unionByName(
            blocks.join(sides, ["mask", "pattern", "block"]).select("code", "mask", "pattern", "low", "high", "block")
        )
    keys = ["mask", "pattern", "low", "high"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search, "a long, b long").distinct()


def _block_cuts(ranked: DataFrame, block_rows: int) -> DataFrame:
    """For each hot group the Gray ranks at which it is cut; a mergeable sketch of quantiles, so no group is sorted in one task."""
    most = ranked.agg(F.max("n")).head()[0]
    steps = 1
    while most / steps > block_rows:
        steps *= 2
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    return ranked.groupBy("mask", "pattern").agg(F.percentile_approx("rank", shares, 10_000).alias("cuts"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id, links_to``.

    ``component_id`` is the smallest id reachable over links, ``links_to`` whether another row has the same or a near
    fingerprint. Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id take part;
    they never name a component unless all its ids are null. Repeated rows stay repeated. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            codes = fingerprints(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(codes.view(np.int64))], names=["doc_id", "code"])

    rows = materialize(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, code long")
    )
    codes = materialize(rows.groupBy("code").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")))
    roots = spanning_stars(links(codes.select("code")))
    labelled = codes.join(roots, "code", "left").withColumn("near", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "code"))
    names = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    final = labelled.join(names, "root").select("code", "component_id", ((F.col("copies") > 1) | F.col("near")).alias("links_to"))
    return rows.join(final, "code").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id", "links_to"
    )
