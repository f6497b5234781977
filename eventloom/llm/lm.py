"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of bigrams, words and a uniform floor are mixed; the weights depend on how often the word before was
seen (buckets of powers of two) and are learned by expectation-maximisation on held-out counts: a tenth of the training
texts, each token taken out of the counts while it is looked at.

Counting is a join of every text with counts of the whole corpus, so it is laid out for little traffic. Texts are dealt to blocks; a block
asks for the total count of each of its distinct words and bigrams once, as sorted arrays of 64-bit hashes cut by hash range;
a range adds up what all blocks sent and answers each with counts in the order asked. What is gathered grows with the corpus,
and no task holds more than a block or a range of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt, materialize, mix, pair_hash, partitions, utf8, word_hashes

#: Bytes of text in a block, and of text for each hash range.
BLOCK_BYTES, RANGE_BYTES = 8_000_000, 16_000_000
#: One in this many training texts teaches the weights.
DELETED = 10
#: Added to each count in the base score.
BASE_ADD = 0.1
#: Steps per doubling at which the ratios of estimates are counted for expectation-maximisation.
STEPS, ITERATIONS = 4, 60
BUCKETS = 64

END, START = mix(np.array([2, 3], np.uint64))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, of the token before it, and the index of its text; each text's last token is END."""
    hashes, owner = word_hashes(*utf8(texts))
    n = np.bincount(owner, minlength=len(texts)) + 1
    last = np.cumsum(n) - 1
    out = np.full(int(n.sum()), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[last] = False
    out[inside] = hashes
    before = np.concatenate([[START], out[:-1]]).astype(np.uint64)
    before[last - n + 1] = START
    return out, before, np.repeat(np.arange(len(texts)), n)


def _cut(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where the sorted keys are cut into hash ranges."""
    of = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(ranges + 1).astype(np.uint64))


def _text(table: pa.Table) -> pa.Array:
    column = table["text"].combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _keys(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Distinct words and bigrams of a block in order, and for each token their places; owner and word before."""
    word, before, owner = tokens(texts)
    words, at_word = np.unique(word, return_inverse=True)
    pairs, at_pair = np.unique(pair_hash(before, word), return_inverse=True)
    return words, at_word, pairs, at_pair, before, owner


def add_up(keys: list[bytes], counts: list[bytes]) -> tuple[list[bytes], bool, int, int]:
    """For each block's sorted keys of a range their counts over all blocks, in the order asked; whether they take 64 bits
    each, and how many keys have a count, and their sum."""
    sizes = [len(k) // 8 for k in keys]
    distinct, at = np.unique(np.frombuffer(b"".join(keys), np.uint64), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, np.frombuffer(b"".join(counts), "<u4").astype(np.int64))
    wide = bool(sums.max(initial=0) >= 1 << 32)
    given, cuts = sums.astype("<u8" if wide else "<u4")[at], np.cumsum([0, *sizes])
    return [given[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], wide, int((sums > 0).sum()), int(sums.sum())


class _Answers:
    """Counts of a block's words and bigrams, put together from the answers of all ranges."""

    def __init__(self, answers: pa.Table):
        order = np.argsort(np.asarray(answers["range"]))
        self.words, self.pairs = (self.read(answers[c].to_pylist(), answers[f"wide_{c}"].to_pylist(), order) for c in ("words", "pairs"))

    @staticmethod
    def read(given: list[bytes], wide: list[bool], order: np.ndarray) -> np.ndarray:
        parts = [np.frombuffer(given[i], "<u8" if wide[i] else "<u4").astype(np.int64) for i in order]
        return np.concatenate([np.zeros(0, np.int64), *parts])


def _bucket(seen: np.ndarray) -> np.ndarray:
    return np.where(seen > 0, 1 + np.log2(np.maximum(seen, 1)).astype(np.int64), 0)


def learn_weights(bucket: np.ndarray, pair: np.ndarray, word: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights (uniform, word, bigram) for each bucket by expectation-maximisation.

    ``pair`` and ``word`` are the estimates divided by the uniform one. A bucket without held-out tokens has the weights of all.
    """

    def fit(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(rows.sum()), word[rows], pair[rows]])
        weights = start
        for _ in range(ITERATIONS):
            share = x * weights
            share /= share.sum(1, keepdims=True)
            weights = (share * n[rows, None]).sum(0) / n[rows].sum()
        return weights

    everything = np.array([0.2, 0.5, 0.3])
    if n.sum():
        everything = fit(np.ones(len(n), bool), everything)
    # The floor keeps its weight above zero: a text never has probability zero.
    out = np.tile(everything, (BUCKETS, 1))
    for b in np.unique(bucket):
        out[b] = fit(bucket == b, np.array([0.2, 0.5, 0.3]))
    out = 0.9999 * out + 0.0001 * np.array([1.0, 0.0, 0.0])
    out[0] = [out[0, 0], out[0, 1] + out[0, 2], 0.0]
    return out


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; log10 probabilities.

    Learns from rows where ``held_out`` is false. Words are maximal runs without ASCII white space, A-Z in lower case, and each text
    ends with a token of its own, so null and empty texts have that one. Repeated rows count as often as they come. If no row may be
    learned from, ``train_tokens`` is 0 and both scores are those of the one unknown token. Other columns are not read.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out.alias("held_out"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).head()[0] or 1
    blocks = max(1, -(-total // BLOCK_BYTES))
    ranges = int(max(partitions(spark), -(-total // RANGE_BYTES)))
    rows, drawn = dealt(rows, blocks, BLOCK_BYTES), F.col("drawn")
    deleted = ~F.col("held_out") & (F.pmod(F.shiftrightunsigned(drawn, 33), F.lit(DELETED)) == 0)
    # Texts for the weights have blocks of their own, so that learning reads those alone.
    of_deleted = max(1, blocks // DELETED)
    block = F.when(deleted, F.pmod(drawn, F.lit(of_deleted))).otherwise(of_deleted + F.pmod(drawn, F.lit(blocks)))
    rows = rows.withColumn("block", block.cast("int")).drop("drawn")

    def ask(table: pa.Table) -> pa.Table:
        words, at_word, pairs, at_pair, _, owner = _keys(_text(table))
        train = ~np.asarray(table["held_out"])[owner]
        n_words = np.bincount(at_word[train], minlength=len(words)).astype("<u4")
        n_pairs = np.bincount(at_pair[train], minlength=len(pairs)).astype("<u4")
        w, p = _cut(words, ranges), _cut(pairs, ranges)
        slices = lambda values, cuts: pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
        return pa.table(
            {
                "block": pa.array(np.full(ranges, table["block"][0].as_py(), np.int32)),
                "range": pa.array(np.arange(ranges, dtype=np.int32)),
                "words": slices(words, w),
                "n_words": slices(n_words, w),
                "pairs": slices(pairs, p),
                "n_pairs": slices(n_pairs, p),
            }
        )

    asked = rows.groupBy("block").applyInArrow(
        ask, "block int, range int, words binary, n_words binary, pairs binary, n_pairs binary"
    )

    def answer(table: pa.Table) -> pa.Table:
        out = {"block": table["block"], "range": table["range"]}
        for name in ("words", "pairs"):
            given, wide, distinct, total = add_up(table[name].to_pylist(), table[f"n_{name}"].to_pylist())
            out[name], out[f"wide_{name}"] = pa.array(given, pa.binary()), pa.array([wide] * len(given))
            if name == "words":
                once = np.zeros((2, len(given)), np.int64)
                once[:, 0] = distinct, total
        return pa.table(out | {"distinct": pa.array(once[0]), "total": pa.array(once[1])})

    answers = materialize(
        asked.groupBy("range").applyInArrow(
            answer, "block int, range int, words binary, wide_words boolean, pairs binary, wide_pairs boolean, distinct long, total long"
        )
    )
    sizes = answers.agg(F.sum("distinct"), F.sum("total")).head()
    distinct, train_tokens = int(sizes[0] or 0), int(sizes[1] or 0)
    train_texts = rows.filter(~F.col("held_out")).count()
    uniform = 1 / (distinct + 1)
    given = answers.select("block", "range", "words", "wide_words", "pairs", "wide_pairs")

    def estimates(texts: pa.Array, answers_: pa.Table, less: int) -> tuple[np.ndarray, ...]:
        """Owner, count of the token, count of what is before it, both estimates; ``less`` is taken off each count."""
        words, at_word, _, at_pair, before, owner = _keys(texts)
        found = _Answers(answers_)
        word, pair = found.words[at_word], found.pairs[at_pair]
        seen = np.empty(len(word), np.int64)
        seen[1:] = word[:-1]
        seen[before == START] = train_texts
        c, s, p = word - less, seen - less, pair - less
        by_word = c / max(train_tokens - less, 1)
        by_pair = np.where(s > 0, p / np.maximum(s, 1), 0.0)
        return owner, word, s, by_word, by_pair

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("bucket", "pair", "word", "n")})
        _, _, seen, by_word, by_pair = estimates(_text(left), right, 1)
        step = lambda x: np.where(x > 0, 1 + np.round(np.log2(np.maximum(x / uniform, 2.0**-40)) * STEPS).astype(np.int64) + 40 * STEPS, 0)
        cells, n = np.unique(np.stack([_bucket(seen), step(by_pair), step(by_word)]), axis=1, return_counts=True)
        return pa.table({"bucket": cells[0], "pair": cells[1], "word": cells[2], "n": n})

    taught = rows.filter(F.col("block") < of_deleted).select("block", "text")
    cells = (
        taught.groupBy("block")
        .cogroup(given.filter(F.col("block") < of_deleted).groupBy("block"))
        .applyInArrow(look, "bucket long, pair long, word long, n long")
        .groupBy("bucket", "pair", "word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    value = lambda c: np.where(cells[c].to_numpy() > 0, 2.0 ** ((cells[c].to_numpy() - 1 - 40 * STEPS) / STEPS), 0.0)
    weights = learn_weights(cells["bucket"].to_numpy(), value("pair"), value("word"), cells["n"].to_numpy().astype(float))
    if not train_tokens:
        weights = np.tile([1.0, 0.0, 0.0], (BUCKETS, 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        owner, word, seen, by_word, by_pair = estimates(_text(left), right, 0)
        mixed = weights[_bucket(seen)]
        p = mixed[:, 0] * uniform + mixed[:, 1] * by_word + mixed[:, 2] * by_pair
        base = np.log10((word + BASE_ADD) / (train_tokens + BASE_ADD * (distinct + 1)))
        n = left.num_rows
        add = lambda x: pa.array(np.bincount(owner, x, n))
        return pa.table(
            [
                left["doc_id"],
                left["held_out"],
                pa.array(np.bincount(owner, minlength=n)),
                pa.array(np.bincount(owner[word > 0], minlength=n)),
                pa.array(np.full(n, train_tokens)),
                add(base),
                add(np.log10(p)),
            ],
            names=names,
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(rate, schema)
