"""Language identification by bit-sliced Bloom filters over character n-grams.

Row ``r`` of the filter holds one bit for each language, so looking up an n-gram is the AND of a few rows and returns all
languages that contain it at once. The popcount of a language's bit over a text, less the hits its filter gives by chance,
decides. What a filter holds is fitted on a bounded sample of labelled rows; every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, pieces

GRAM = 4
HASHES = 4
#: Documents of a language that its filter is fitted on (expected number), and the bits kept free for each n-gram.
SAMPLE_DOCS = 1500
BITS_PER_GRAM = 16
#: A language contains an n-gram that makes up this share of its n-grams, and this part of the largest share of any language.
LEAST_SHARE = 2e-5
LEAST_PART = 0.25
#: The most frequent n-grams a filter keeps.
MOST_GRAMS = 50_000
UNDECIDED = "und"


def letter_table() -> np.ndarray:
    """For each code point: its lower-case letter, or a space for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


_LETTERS: list[np.ndarray] = []


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of letters and single spaces, the index of the text of each, and the letters of each text."""
    if not _LETTERS:
        _LETTERS.append(letter_table())
    parts = [text or "" for text in texts]
    lengths = np.fromiter((len(p) + 2 for p in parts), np.int64, len(parts))
    joined = "".join(f" {p} " for p in parts)
    codes = _LETTERS[0][np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(parts)), lengths)
    letters = np.bincount(owner[codes != 32], minlength=len(parts))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    if len(codes) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    key = codes[: len(codes) - GRAM + 1].copy()
    for i in range(1, GRAM):
        key = key * np.uint64(0x100000001B3) + codes[i : len(codes) - GRAM + 1 + i]
    whole = owner[: len(key)] == owner[GRAM - 1 :]
    return mix(key[whole]), owner[: len(key)][whole], letters


def rows_of(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The filter's rows for each key, one array for each hash function."""
    low, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((low + np.uint64(i) * step) % np.uint64(size)).astype(np.int64)


class LanguageFilter:
    """Languages in order, the bit-sliced rows, and for each language the share of its bits that are set."""

    def __init__(self, contained: dict[str, np.ndarray]):
        self.languages = sorted(contained)
        self.size = max(64, BITS_PER_GRAM * max((len(g) for g in contained.values()), default=0))
        self.rows = np.zeros((self.size, (len(self.languages) + 63) // 64), np.uint64)
        for i, language in enumerate(self.languages):
            for rows in rows_of(contained[language], self.size):
                self.rows[rows, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        self.chance = np.array([self._bits(self.rows, i).mean() ** HASHES for i in range(len(self.languages))])

    @staticmethod
    def _bits(rows: np.ndarray, i: int) -> np.ndarray:
        return (rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """For each n-gram the bitmask of all languages that contain it."""
        found = None
        for rows in rows_of(keys, self.size):
            found = self.rows[rows] if found is None else found & self.rows[rows]
        return found

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        keys, owner, letters = grams(texts)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        masks = self.masks(keys)
        hits = np.stack([np.bincount(owner, self._bits(masks, i), len(texts)) for i in range(len(self.languages))], 1)
        held = (hits - total[:, None] * self.chance) / (1 - np.minimum(self.chance, 0.999))
        share = np.clip(held / np.maximum(total, 1)[:, None], 0, 1)
        best = share.argmax(1)
        known = letters > 0
        return (
            [self.languages[b] if k else UNDECIDED for b, k in zip(best, known)],
            np.where(known, share[np.arange(len(texts)), best], 0.0),
        )


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageFilter | None:
    """Fits the filters; None if no row has a language and a text.

    The sample of a language is drawn from its distinct texts, in proportion, so that ``SAMPLE_DOCS`` are expected of each: copies neither
    crowd the sample nor keep a language out of it, and a language of few texts gives them all.
    """
    rows = train.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    named = rows.withColumn("name", F.xxhash64(F.lit("language sample"), "text"))
    distinct = named.select("lang", "name").distinct()
    counts = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, SAMPLE_DOCS / n))])
    point = F.pmod(F.col("name"), F.lit(1_000_000)) / 1e6
    # Drawn by the hash first, then one row of each text: what is left to compare is small.
    sample = named.filter(point < F.element_at(rates, F.col("lang"))).dropDuplicates(["lang", "name"]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            keys, owner, _ = grams(batch.column("text").to_pylist())
            for language in sorted(set(langs)):
                found, n = np.unique(keys[(langs == language)[owner]], return_counts=True)
                yield pa.record_batch(
                    {"lang": pa.array([language] * len(found)), "gram": pa.array(found.view(np.int64)), "n": pa.array(n)}
                )

    seen = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = seen.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = seen.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    # At most MOST_GRAMS n-grams a language: only so many can have the least share.
    assert LEAST_SHARE * MOST_GRAMS >= 1
    kept = shares.filter(F.col("share") >= LEAST_SHARE).join(top, "gram").filter(F.col("share") >= LEAST_PART * F.col("top"))
    found = kept.select("lang", "gram").toArrow().to_pydict()
    langs, keys = np.array(found["lang"], object), np.array(found["gram"], np.int64).view(np.uint64)
    return LanguageFilter({language: keys[langs == language] for language in counts})


def identify(
    docs: DataFrame, model: LanguageFilter | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (or as they are called) to every row, in place of columns of these names.

    ``score`` is the share of the text's n-grams that the language contains, corrected for chance. A null text, a text
    without a letter, or a missing model gives ``und`` and 0. The first language in order wins a tie.
    """
    docs = docs.drop(lang_pred, score)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = batch.column(text).to_pylist()
            names, scores = model.decide(texts) if model else ([UNDECIDED] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, lang_pred, score],
            )

    return docs.mapInArrow(run, schema)
