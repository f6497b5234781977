import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import lm
from eventloom.llm.common import dealt, remainder
from eventloom.llm.queries import op3_lm


def plain_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def plain_base(rows):
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows}
    counts = Counter(t for d, text in rows if not held[d] for t in plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        words = plain_tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in words)
        out.append((d, held[d], len(words), sum(counts[t] > 0 for t in words), n, base))
    return out


def texts():
    rng = random.Random(4)
    words = [f"Wörd{i}" for i in range(300)]
    rows = [(i, " ".join(words[min(int(rng.paretovariate(0.7)), 299)] for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\r\n"), (None, "wörd1 unseen\x85odd"), (203, "repeat repeat"), (203, "repeat repeat"), (204, "x " * 60_000)]
    return rows


@pytest.mark.parametrize("size", [8_000_000, 500])
def test_base_and_counts(spark, make_docs, size, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", size)
    rows = texts()
    docs = make_docs(*rows).withColumnRenamed("lang", "block")
    found = lm.score(docs, remainder("doc_id", 10) == 0).collect()
    key = lambda r: (str(r[0]), *r[2:4])
    mine, theirs = sorted((tuple(r)[:6] for r in found), key=key), sorted(plain_base(rows), key=key)
    assert [m[:5] for m in mine] == [t[:5] for t in theirs]
    assert np.allclose([m[5] for m in mine], [t[5] for t in theirs])
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_interpolation_beats_words_on_held_out_texts(spark, make_docs):
    rng = random.Random(6)
    follows = {w: [rng.choice("abcdefgh") for _ in range(3)] for w in "abcdefgh"}
    rows = []
    for i in range(600):
        words = [rng.choice("abcdefgh")]
        for _ in range(30):
            words.append(rng.choice(follows[words[-1]]))
        rows.append((i, " ".join(words)))
    found = [r for r in lm.score(make_docs(*rows), remainder("doc_id", 10) == 0).collect() if r.held_out]
    assert sum(r.score for r in found) > 0.7 * sum(r.base_score for r in found)


def test_weights_recover_a_mixture():
    rng = np.random.default_rng(5)
    word, pair = rng.choice([0.5, 2.0, 8.0], 4000), rng.choice([0.0, 1.0, 400.0], 4000)
    true = np.array([0.1, 0.3, 0.6])
    n = 0.1 + 0.3 * word + 0.6 * pair
    weights = lm.learn_weights(np.full(4000, 3), pair, word, n)
    assert abs(weights[3].sum() - 1) < 1e-6 and weights[3, 2] > true[2] / 2 and weights[0, 2] == 0


def test_nothing_to_learn_from(spark, make_docs):
    assert lm.score(make_docs(), F.lit(True)).count() == 0
    row = lm.score(make_docs((1, "a b")), F.lit(True)).head()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == pytest.approx(0, abs=1e-9)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {r[0]: r for r in plain_base(rows)}
    found = op3_lm(spark, sf).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[:5] == want[r.doc_id][:5] and r.base_score == pytest.approx(want[r.doc_id][5])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_above_32_bits():
    from eventloom.llm.lm import _Answers, add_up

    key = lambda *x: np.array(x, np.uint64).tobytes()
    count = lambda *x: np.array(x, "<u4").tobytes()
    most = 2**32 - 1
    given, wide, distinct, total = add_up([key(1, 2, 9), key(2, 5), key(2)], [count(7, most, 0), count(most, 3), count(4)])
    assert wide and (distinct, total) == (3, 2 * most + 14)
    assert [_Answers.read([g], [wide], np.array([0])).tolist() for g in given] == [[7, 2 * most + 4, 0], [2 * most + 4, 3], [2 * most + 4]]
    narrow = add_up([key(1), key(1)], [count(5), count(6)])
    assert narrow == ([np.array([11], "<u4").tobytes()] * 2, False, 1, 11)


def test_many_copies_of_a_row_are_dealt_out(spark, make_docs):
    from eventloom.llm.common import dealt

    rows = [(1, "copy of a row " * 20)] * 300 + [(i, f"text {i}") for i in range(50)] + [(None, None)] * 3
    docs = make_docs(*rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = dealt(docs, 40, 2000)
    assert out.count() == len(rows)
    copies = out.filter("doc_id = 1 AND length(text) > 100").select("block").distinct().count()
    assert copies > 20 and out.filter("doc_id IS NULL").select("block").distinct().count() == 1
    few = dealt(docs, 40, 10**9)
    assert few.filter("doc_id = 1 AND length(text) > 100").select("block").distinct().count() == 1


def test_score_against_dictionaries(spark, make_docs, monkeypatch):
    learned = []

    def spy(*args, learn=lm.learn_weights):
        learned.append(learn(*args))
        return learned[-1]

    monkeypatch.setattr(lm, "learn_weights", spy)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    rows = texts()[:-4] + [(204, "x y " * 900)]
    found = {r.doc_id: r for r in lm.score(make_docs(*rows), remainder("doc_id", 10) == 0).collect()}
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows}
    line = {d: plain_tokens(text) for d, text in rows}
    pairs_of = lambda d: list(zip(["<s>", *line[d]], line[d]))
    train = [d for d, _ in rows if not held[d]]
    word = Counter(t for d in train for t in line[d])
    pair = Counter(p for d in train for p in pairs_of(d))
    n, v = sum(word.values()), len(word)
    seen = lambda t: len(train) if t == "<s>" else word[t]
    bucket = lambda s: s.bit_length() if s > 0 else 0

    (weights,) = learned
    for d, _ in rows:
        want = 0.0
        for b, t in pairs_of(d):
            w, s = weights[bucket(seen(b))], seen(b)
            want += math.log10(w[0] / (v + 1) + w[1] * word[t] / n + w[2] * (pair[b, t] / s if s else 0))
        assert found[d].score == pytest.approx(want)

    # The weights: expectation-maximisation over single tokens, each taken out of the counts, without cells of rounded ratios.
    clean = make_docs(*rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    drawn = dealt(clean, 1, 10**9).filter(F.pmod(F.shiftrightunsigned("drawn", 33), F.lit(lm.DELETED)) == 0).select("doc_id").collect()
    by_bucket = {}
    for d in (r.doc_id for r in drawn if not held[r.doc_id]):
        for b, t in pairs_of(d):
            s = seen(b) - 1
            x = (1 / (v + 1), (word[t] - 1) / (n - 1), (pair[b, t] - 1) / s if s else 0.0)
            by_bucket.setdefault(bucket(s), []).append(x)
    assert sum(len(x) for x in by_bucket.values()) > 200
    for k, tokens in by_bucket.items():
        if k == 0:
            continue
        x, w = np.array(tokens), np.array([0.2, 0.5, 0.3])
        for _ in range(lm.ITERATIONS):
            share = x * w
            w = (share / share.sum(1, keepdims=True)).mean(0)
        gain = np.log(x @ w).mean() - np.log(x @ weights[k]).mean()
        assert abs(gain) < 0.01
