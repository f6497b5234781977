import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from eventloom.llm import periods


def plain_runs(words):
    """All stretches by comparing words at every distance; a stretch stays under its least period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                if i - start + q >= max(12, 2 * q):
                    out.setdefault((start, i + q), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain(doc_id, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if planted and doc_id is not None and h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(kept))


def texts():
    rng = random.Random(4)
    out = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "a " * 3000, "A a " * 10, "a b a b a\tb\na b a  b a b", "é è " * 9 + "é"]
    for letters in ("ab", "abc", "abcdefgh"):
        out += [" ".join(rng.choice(letters) for _ in range(rng.randint(20, 300))) for _ in range(30)]
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    out += [" ".join(x) for x in (fibonacci[-1], morse, "ab" * 12 + "a" + "ab" * 12 + "a", "b" + ("ab" * 12 + "a") * 2 + "b", ("a" * 40 + "b") * 5)]
    for period in (1, 2, 3, 5, 6, 7, 8, 13, 14, 15, 31, 64):
        for extra in (0, 1, period // 2):
            block = [rng.choice("abcdefghij") for _ in range(period)]
            stretch = (block * 14)[: max(12, 2 * period) + extra]
            out.append(" ".join([rng.choice("xyz") for _ in range(rng.randint(0, 9))] + stretch + [rng.choice("xyz") for _ in range(rng.randint(0, 9))]))
    out += [" ".join(f"w{i % 400}" for i in range(3000)), " ".join(["the same words again and again"] * 3)]
    return out


def test_matches_a_plain_search(spark, make_docs):
    rows = list(enumerate(texts())) + [(3, "a b " * 8), (None, "x y " * 9), (10**12, "c " * 13), (None, "x y " * 9)]
    docs = make_docs(*rows).withColumnRenamed("lang", "runs").withColumnRenamed("source", "n")
    found = sorted((tuple(r) for r in periods.digest(periods.find_runs(periods.plant(docs))).collect()), key=str)
    assert found == sorted((plain(*row) for row in rows), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_of_random_words(letters):
    rng = np.random.default_rng(letters)
    for _ in range(150):
        words = rng.integers(0, letters, rng.integers(1, 120))
        for _ in range(rng.integers(0, 3)):
            size = int(rng.integers(1, 20))
            words = np.concatenate([words, np.tile(rng.integers(0, letters, size), 40 // size)])
        start, end, period = periods.runs(np.append(words, -1))
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == plain_runs(words.tolist())


def test_wavelet_tree():
    rng = np.random.default_rng(2)
    values = rng.permutation(500)
    tree = periods.WaveletTree(values, 500)
    low = rng.integers(0, 500, 300)
    high = np.minimum(low + rng.integers(1, 60, 300), 500)
    asked = rng.integers(0, 520, 300)
    for a, b, y, found in zip(low, high, asked, tree.successor(low, high, asked)):
        above = [v for v in values[a:b] if v >= y]
        assert found == (min(above) if above else np.iinfo(np.int64).max)


def test_empty_table(spark, make_docs):
    assert periods.digest(periods.find_runs(periods.plant(make_docs()))).count() == 0
