import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventloom.llm.packing import combinations, pack, repeat_counts


def check(docs, window=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = defaultdict(list)
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        wanted[r.doc_id, len(ids)].append(ids)
    rows = pack(docs, window=window).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(wanted)
    for key, texts in wanted.items():
        found = sorted(pieces[key])
        assert sum(p[1] for p in found) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for start, length, crc in found:
                assert start == at and crc == zlib.crc32(np.array(texts[0][start : start + length], "<u4").tobytes())
                at += length
            assert at == len(texts[0])
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += window - at
    assert padding < window
    return rows


def test_every_id_once(spark, make_docs):
    rng = random.Random(2)
    words = "alpha beta gamma delta Straße día 12 345 <|endoftext|> it's we'll  \n\t 日本語".split(" ")
    rows = [(1, None), (2, ""), (None, "lost"), (3, "<|endoftext|> x"), (4, " \n\n  a   b \r\n"), (5, "long " * 9000)]
    rows += [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 700])))) for i in range(10, 120)]
    rows += [(500, "same words"), (500, "same words"), (501, "same words")]
    check(make_docs(*rows).withColumnRenamed("lang", "offset"))


def test_small_windows(spark, make_docs):
    check(make_docs(*[(i, "word " * (i % 23)) for i in range(300)]), window=16)


def test_empty_table(spark, make_docs):
    assert pack(make_docs()).count() == 0


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_counts_stay_within_the_histogram():
    rng = np.random.default_rng(4)
    histogram = rng.integers(0, 40, 1024)
    histogram[0] = 0
    combos = combinations(1024, histogram)
    counts = repeat_counts(histogram, combos)
    used = np.zeros(1024, np.int64)
    for combo, n in zip(combos, counts):
        assert sum(combo) == 1024 and n >= 0
        for x in combo:
            used[x] += n
    assert (used <= histogram).all() and used.sum() > 0.65 * histogram.sum()


def test_no_combination_is_left_out():
    assert len(combinations(1024, np.ones(1024))) == 512 + 87_381
    histogram = np.zeros(64, np.int64)
    histogram[[13, 22, 29]] = 50, 50, 50
    combos = combinations(64, histogram)
    assert combos == [(13, 22, 29)] and repeat_counts(histogram, combos).tolist() == [50]
