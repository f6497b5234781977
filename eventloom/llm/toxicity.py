"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary text.

Both models are interpolated bigrams with absolute discounts. Counts are of distinct texts or of distinct words before, whichever
are fewer, so neither copies of a text nor a phrase repeated in one count more than once. What the discounts take from rare
expressions of either class makes up a lower order that both share. The score compares the length-normalised log-likelihoods of
the whole text and of its most toxic windows, so that a few toxic words in a very long text count too. What these differences
mean is fitted on labelled rows that the counts have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, mix, pair_hash, pieces, utf8, word_hashes
from .decontaminate import PUNCTUATION

#: What is taken from each count: of bigrams, of words, and of the words that both classes share.
PAIR_DISCOUNT, DISCOUNT, SHARED_DISCOUNT = 20.0, 2.0, 0.75
#: Labelled documents of each class (expected number) that the counts, and the meaning of scores, are fitted on.
COUNT_DOCS = 3000
FIT_DOCS = 1500
#: Words of a window, and how far the next one begins.
WINDOWS = ((1, 1), (8, 2))
CUT = 0.7

_START = mix(np.array([1], np.uint64))[0]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*utf8(texts), PUNCTUATION)


def _context(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The word before each word; a mark at the beginning of a text."""
    out = np.concatenate([[_START], hashes[:-1]]).astype(np.uint64)
    out[np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))] = _START
    return out


class _Lookup:
    """Sorted 64-bit keys with columns of values; absent keys have zeros."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [np.append(v[order], 0).astype(np.float32) for v in values]

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        if not len(self.keys):
            return [np.zeros(len(keys), np.float32) for _ in self.values]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        at = np.where(self.keys[at] == keys, at, len(self.keys))
        return [v[at] for v in self.values]


class KneserNey:
    """Both models. ``pairs`` are bigrams (before, word) with their counts in ordinary and in toxic text, at least those above the
    discount; ``contexts`` have for either class the sum of the counts and of what the discount takes; ``words`` the counts."""

    def __init__(
        self,
        pairs: tuple[np.ndarray, ...],
        contexts: tuple[np.ndarray, ...],
        words: tuple[np.ndarray, ...],
        pair_discount: float = PAIR_DISCOUNT,
    ):
        self.pair_discount = pair_discount
        before, word, *n = pairs
        self.pairs = _Lookup(pair_hash(before, word), *n)
        self.contexts = _Lookup(*contexts)
        word, *n = words
        left_over = sum(np.minimum(v, DISCOUNT) for v in n)
        self.words = _Lookup(word, *n, left_over)
        self.types = [float(v.sum()) for v in n]
        self.removed = [float(np.minimum(v, DISCOUNT).sum()) for v in n]
        self.all_types, self.all_words = float(left_over.sum()), float(len(word))

    def probabilities(self, before: np.ndarray, word: np.ndarray, c: int) -> np.ndarray:
        """P(word | word before) in ordinary (0) or toxic (1) text; words never seen share the rest."""
        known, contexts = self.words(word), self.contexts(before)
        unseen = 1 / (self.all_words + 1)
        total = max(self.all_types, 1.0)
        shared = np.maximum(known[2] - SHARED_DISCOUNT, 0) / total + min(1.0, SHARED_DISCOUNT * self.all_words / total) * unseen
        if self.types[c]:
            lower = np.maximum(known[c] - DISCOUNT, 0) / self.types[c] + self.removed[c] / self.types[c] * shared
        else:
            lower = shared
        seen, removed = np.maximum(contexts[c], 1), contexts[2 + c]
        upper = np.maximum(self.pairs(pair_hash(before, word))[c] - self.pair_discount, 0) / seen + removed / seen * lower
        return np.where(contexts[c] > 0, upper, lower)

    def differences(self, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word in its context."""
        before = _context(hashes, owner)
        ordinary, toxic = (np.maximum(self.probabilities(before, hashes, c), 1e-12) for c in (0, 1))
        return np.log(toxic) - np.log(ordinary)

    def features(self, texts: pa.Array) -> np.ndarray:
        """For each text the mean difference per word, and that of the highest window of each size; zeros without words."""
        hashes, owner = tokens(texts)
        out = np.zeros((len(texts), 1 + len(WINDOWS)))
        count = np.bincount(owner, minlength=len(texts))
        sums = np.concatenate([[0], np.cumsum(self.differences(hashes, owner))]) if len(hashes) else np.zeros(1)
        first = np.concatenate([[0], np.cumsum(count)])
        for i in np.flatnonzero(count):
            a, b = first[i], first[i + 1]
            out[i, 0] = (sums[b] - sums[a]) / (b - a)
            for k, (size, step) in enumerate(WINDOWS):
                begin = np.arange(a, max(a + 1, b - size + step), step)
                end = np.minimum(begin + size, b)
                begin = np.maximum(end - size, a)
                # A text shorter than a window is not held to fewer words.
                out[i, 1 + k] = ((sums[end] - sums[begin]) / size).max()
        return out


class Scorer:
    """A model and the logistic function of its differences."""

    def __init__(self, model: KneserNey, weights: np.ndarray):
        self.model, self.weights = model, weights

    def __call__(self, texts: pa.Array) -> np.ndarray:
        return logistic(design(self.model.features(texts)) @ self.weights)


def design(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), features])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic_weights(features: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for the logistic regression of ``toxic`` on the features, slightly shrunk."""
    x, y = design(features), toxic.astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        norm = np.abs(step).max()
        w = w + (step if norm < 4 else step * 4 / norm)
        if norm < 1e-8:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    pair_discount: float = PAIR_DISCOUNT,
) -> Scorer | None:
    """Fits on documents with a text and a label of 0 or 1; None if a class is missing.

    Of two thirds of the labels COUNT_DOCS of a class at most are counted; FIT_DOCS of a class at most, of the other
    third, give the weights. Both numbers are expected ones: labels are drawn by a hash of their id, before any text is read. An
    id that several texts share gives the one of least hash, so no id brings more than a text; an id or a text with both labels
    counts in both classes.
    """
    given = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IN (0, 1)").distinct()
    sizes = {r["toxic"]: r["n"] for r in given.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None
    drawn = F.xxhash64(F.lit("toxicity"), "id")
    point = F.pmod(F.shiftrightunsigned(drawn, 20), F.lit(1_000_000)) / 1e6
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL")

    def part(remainders: list[int], most: list[float], share: float) -> DataFrame:
        rate = [min(1.0, most[c] / (share * sizes[c])) for c in (0, 1)]
        picked = given.filter(F.pmod(drawn, F.lit(3)).isin(remainders) & (point < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0])))
        # COUNT_DOCS or FIT_DOCS ids of a class, whatever the data: sent to the texts, which stay where they are. Tasks pass on one text an id.
        met = texts.join(F.broadcast(picked), "id").groupBy("id", "toxic")
        return met.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct (two words before, word before, word) of each text; marks the first of each bigram and of each word."""
        for batch in pieces(batches, "text"):
            hashes, owner = tokens(batch.column("text"))
            if not len(hashes):
                continue
            before = _context(hashes, owner)
            rows = np.empty(len(hashes), [("text", np.int64), ("word", np.uint64), ("before", np.uint64), ("left", np.uint64)])
            rows["text"], rows["word"], rows["before"], rows["left"] = owner, hashes, before, _context(before, owner)
            rows = np.unique(rows)
            new_word = np.concatenate([[True], (rows["word"][1:] != rows["word"][:-1]) | (rows["text"][1:] != rows["text"][:-1])])
            new_pair = new_word | np.concatenate([[True], rows["before"][1:] != rows["before"][:-1]])
            yield pa.record_batch(
                [
                    *(pa.array(np.ascontiguousarray(rows[c]).view(np.int64)) for c in ("before", "word", "left")),
                    pa.array(np.asarray(batch.column("toxic"))[rows["text"]]),
                    pa.array(new_pair.astype(np.int64)),
                    pa.array(new_word.astype(np.int64)),
                ],
                names=["before", "word", "left", "toxic", "new_pair", "new_word"],
            )

    sample = part([0, 1], [COUNT_DOCS] * 2, 2 / 3).distinct()
    seen = sample.mapInArrow(count, "before long, word long, left long, toxic int, new_pair long, new_word long")
    by_left = seen.groupBy("toxic", "word", "before", "left").agg(F.sum("new_pair").alias("texts"), F.sum("new_word").alias("words"))
    by_pair = materialize(
        by_left.groupBy("toxic", "word", "before").agg(
            F.least(F.sum("texts"), F.count("*")).alias("n"), F.sum("words").alias("words")
        )
    )

    def classes(value: str, suffix: str = "") -> list:
        return [F.sum(F.expr(f"IF(toxic = {c}, {value}, 0)")).alias(f"n{c}{suffix}") for c in (0, 1)]

    def arrays(df: DataFrame, *keys: str) -> tuple[np.ndarray, ...]:
        got = df.toArrow()
        return tuple(got[c].to_numpy().view(np.uint64) if c in keys else got[c].to_numpy().astype(np.float64) for c in got.column_names)

    # All of it is of the bounded sample.
    by_word = by_pair.groupBy("toxic", "word").agg(F.least(F.sum("words"), F.count("*")).alias("n"))
    model = KneserNey(
        arrays(by_pair.filter(F.col("n") > pair_discount).groupBy("before", "word").agg(*classes("n")), "before", "word"),
        arrays(by_pair.groupBy("before").agg(*classes("n"), *classes(f"least(n, {pair_discount}D)", "_taken")), "before"),
        arrays(by_word.groupBy("word").agg(*classes("n")), "word"),
        pair_discount,
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"feature_{k}" for k in range(1 + len(WINDOWS))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = shared.value.features(batch.column("text"))
            yield pa.record_batch([batch.column("toxic"), *(pa.array(found[:, k]) for k in range(len(names)))], names=["toxic", *names])

    held = part([2], [FIT_DOCS] * 2, 1 / 3).mapInArrow(measure, ", ".join(["toxic int", *(f"{n} double" for n in names)])).toArrow()
    return Scorer(model, logistic_weights(np.column_stack([held[n].to_numpy() for n in names]), held["toxic"].to_numpy()))


def score(docs: DataFrame, scorer: Scorer | None, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, higher: likelier toxic) and ``predicted`` (1 from CUT on) to every row, in place of such columns.

    Null and empty texts get the score of a text without differences. Repeated rows are scored alike. Without a scorer every score is 0.
    """
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, text):
            scores = model(batch.column(text)) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= CUT).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return docs.mapInArrow(run, schema)
