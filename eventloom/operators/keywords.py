"""Key terms of a corpus: TF-IDF over one- and two-word phrases."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..vocab import STOP_WORDS

WORD = r"[\p{L}\p{N}_]{2,}"
#: Bytes of words that one task cuts into terms at once, and whose terms one task counts.
BLOCK_BYTES, RANGE_BYTES = 8_000_000, 8_000_000
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def kept_words(text_col: str, stop_words: list[str]) -> Column:
    """The lower-cased words of a text without stop words, each followed by a blank; a text without words is one blank."""
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words)
    words = f"regexp_extract_all(lower({text_col}), r'{WORD}', 0)"
    kept = f"filter({words}, w -> w NOT IN ({stops}))" if stop_words else words
    return F.expr(f"array_join({kept}, ' ') || ' '")


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of them at least."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            _POWERS[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
    return _POWERS


class _Terms(NamedTuple):
    """Distinct terms of each text: bytes of all texts, then of each term its text, name, count and one place."""

    data: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    tf: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def _terms(words: pa.ChunkedArray) -> _Terms:
    texts = pa.concat_arrays(words.chunks).cast(pa.large_binary()).fill_null(b"")
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    end = np.flatnonzero(data == 32)
    begin = np.concatenate([np.zeros(1, np.int64), end[:-1] + 1])[: len(end)]
    begin, end = begin[end > begin], end[end > begin]
    doc = np.searchsorted(starts - starts[0], begin, "right") - 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    begin, end, doc = (np.concatenate(x) for x in ((begin, begin[pair]), (end, end[pair + 1]), (doc, doc[pair])))
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * powers[: len(data)], out=sums[1:])
    key = _mix((sums[end] - sums[begin]) * inverse[begin])
    own = _mix(key + _mix(doc.astype(np.uint64)))
    order = np.argsort(own)
    first = np.flatnonzero(np.append(True, np.diff(own[order]) != 0)) if len(own) else np.zeros(0, np.int64)
    one = order[first]
    return _Terms(data, doc[one], key[one], np.diff(np.append(first, len(own))), begin[one], end[one])


def _ask(block: int, terms: _Terms, ranges: int) -> pa.Table:
    """The terms of a block, and how many of its texts hold each, by ranges of their names."""
    keys, texts = np.unique(terms.key, return_counts=True)
    of = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.searchsorted(of, np.arange(ranges + 1).astype(np.uint64))
    asked = np.flatnonzero(np.diff(cuts))
    packed = lambda x: pa.array([x[cuts[r] : cuts[r + 1]].tobytes() for r in asked], pa.binary())
    return pa.table(
        {"block": pa.array([block] * len(asked), pa.int64()), "range": pa.array(asked, pa.int64()), "keys": packed(keys), "texts": packed(texts)}
    )


def _count(asked: pa.Table) -> pa.Table:
    """For the terms of each block the number of texts, in all blocks, that hold them."""
    keys = [np.frombuffer(k, np.uint64) for k in asked["keys"].to_pylist()]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    texts = np.concatenate([np.frombuffer(t, np.int64) for t in asked["texts"].to_pylist()])
    total = np.zeros(int(place.max()) + 1, np.int64)
    np.add.at(total, place, texts)
    parts = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"block": asked["block"], "range": asked["range"], "df": pa.array([p.tobytes() for p in parts], pa.binary())})


def _heads(terms: _Terms, chosen: np.ndarray) -> np.ndarray:
    """The first eight bytes of the terms as numbers of the same order, up to ties."""
    begin, size, ahead = terms.begin[chosen], (terms.end - terms.begin)[chosen], np.arange(8)
    data = np.append(terms.data, np.zeros(8, np.uint8))
    return np.where(ahead < size[:, None], data[begin[:, None] + ahead], 0).astype(np.uint8).view(">u8").ravel().astype(np.uint64)


def _best(terms: _Terms, df: np.ndarray, n: int, top_n: int) -> np.ndarray:
    """Places of terms that hold the ``top_n`` best of each text, and few others.

    Scores are taken with a margin. Terms of one text with equal counts have equal scores, so only their first by name can be among the best.
    """
    score = terms.tf * (np.log((n + 1) / (df + 1)) + 1)
    order = np.sort((terms.doc.astype(np.uint64) << np.uint64(32)) | (np.uint64(2**32 - 1) - score.astype(np.float32).view(np.uint32)))
    doc = (order >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.append(True, np.diff(doc) != 0))
    last = np.minimum(begin + top_n, np.append(begin[1:], len(doc))) - 1
    least = np.zeros(int(doc[-1]) + 1)
    least[doc[begin]] = (2**32 - 1 - (order[last] & np.uint64(2**32 - 1))).astype(np.uint32).view(np.float32)
    some = np.flatnonzero(score >= least[terms.doc] * (1 - 1e-6) - 1e-6)
    head = _heads(terms, some)
    by = np.lexsort((head, df[some], terms.tf[some], terms.doc[some]))
    some, head = some[by], head[by]
    same = (np.diff(terms.doc[some]) == 0) & (np.diff(terms.tf[some]) == 0) & (np.diff(df[some]) == 0)
    begin = np.flatnonzero(np.append(True, ~same))
    size = np.diff(np.append(begin, len(some)))
    return some[head <= np.repeat(head[begin + np.minimum(size, top_n) - 1], size)]


def key_terms(
    texts: DataFrame, id_col: str, text_col: str, top_n: int = 5, stop_words: list[str] = STOP_WORDS
) -> DataFrame:
    """``id, rank, term, tf, df, score``: the top phrases of each text, ties by term.

    score = tf * (ln((1 + texts) / (1 + df)) + 1). Texts are dealt to blocks. A block sends each of its terms once, by a 64-bit hash and
    with its number of texts, to the task that counts it over all blocks; with the counts it picks the terms that can be among the best.
    So no row by text and term is shuffled, and the ranking meets a few rows of each text.
    """
    assert top_n > 0
    # Stored, so that each text is cut into words once and every reader numbers the rows alike.
    words = cut_lineage(
        texts.select(F.col(id_col).alias("id"), kept_words(text_col, stop_words).alias("words"), F.monotonically_increasing_id().alias("row"))
    )
    n, size = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).head()
    blocks, ranges = max(1, -(-size // BLOCK_BYTES)), max(1, -(-size // RANGE_BYTES))
    rows = words.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "id", "words")

    def ask(block: pa.Table) -> pa.Table:
        return _ask(block["block"][0].as_py(), _terms(block["words"]), ranges)

    def best(block: pa.Table, counted: pa.Table) -> pa.Table:
        names = ["id", "term", "tf", "df"]
        if not block.num_rows or not counted.num_rows:
            return pa.table([block["id"].slice(0, 0), pa.array([], pa.string()), *[pa.array([], pa.int64())] * 2], names=names)
        terms = _terms(block["words"])
        df = np.concatenate([np.frombuffer(d, np.int64) for d in counted.sort_by("range")["df"].to_pylist()])
        df = df[np.unique(terms.key, return_inverse=True)[1]]
        some = _best(terms, df, n, top_n)
        said = [terms.data[a:b].tobytes() for a, b in zip(terms.begin[some], terms.end[some])]
        ids = block["id"].take(pa.array(terms.doc[some]))
        return pa.table([ids, pa.array(said, pa.binary()).cast(pa.string()), pa.array(terms.tf[some]), pa.array(df[some])], names=names)

    counted = rows.groupBy("block").applyInArrow(ask, "block long, range long, keys binary, texts binary")
    counted = counted.groupBy("range").applyInArrow(_count, "block long, range long, df binary")
    kind = words.schema["id"].dataType.simpleString()
    tf = rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(best, f"id {kind}, term string, tf long, df long")
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    scored = tf.withColumn("score", F.round(F.col("tf") * idf, 9))
    ranked = Window.partitionBy("id").orderBy(F.desc("score"), "term")
    return (
        scored.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= top_n)
        .select("id", "rank", "term", "tf", "df", "score")
    )


def keyword_lists(terms: DataFrame) -> DataFrame:
    """(id, keywords): the terms in rank order."""
    ranked = terms.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("ranked"))
    return ranked.select("id", F.col("ranked.term").alias("keywords"))
