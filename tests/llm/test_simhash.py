import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from eventloom.llm import simhash
from eventloom.llm.components import min_labels
from eventloom.llm.simhash import close_pairs, gray_rank, near_duplicates


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                label[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            groups[root(i)].append(d)
    return sorted(((d, f"{prints[i]:016x}", min(groups[root(i)], default=None)) for i, (d, _) in enumerate(rows)), key=str)


def texts():
    rng = random.Random(5)
    words = [f"Wörd{i}" if i % 3 else f"w{i}" for i in range(60)]
    rows = [(7, None), (8, ""), (9, " \t\n"), (10, "one"), (11, "One two"), (12, "\x85odd\xa0space and more"), (None, "one"), (3, "one")]
    for i in range(100, 140):
        base = [rng.choice(words) for _ in range(rng.randint(1, 400))]
        rows.append((i, " ".join(base)))
        if i % 2:
            base[rng.randrange(len(base))] = "changed"
            rows.append((i + 1000, "  ".join(base)))
        if i % 9 == 0:
            rows += [(i, rows[-1][1]), (i + 2000, " ".join(base).upper())]
    rows.append((5000, "long " + " ".join(rng.choice(words) for _ in range(30_000))))
    return rows


@pytest.mark.parametrize("block_rows", [20_000, 2])
def test_matches_all_pairs(spark, make_docs, block_rows, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (block_rows,))
    rows = texts()
    found = near_duplicates(make_docs(*rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == plain_components(rows)


def test_no_link_is_missed():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = [base]
    for _ in range(40):
        codes.append(base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)))
    codes = np.unique(np.concatenate(codes))
    codes = codes[np.argsort(gray_rank(codes))]
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if np.bitwise_count(codes[i] ^ codes[j]) <= 2}
    assert {(int(x), int(y)) for a, b in close_pairs(codes, codes, True) for x, y in zip(a, b)} == want
    half = len(codes) // 3
    across = {(i, j - half) for i, j in want if i < half <= j}
    assert {(int(x), int(y)) for a, b in close_pairs(codes[:half], codes[half:], False) for x, y in zip(a, b)} == across


def test_labels_of_a_chain():
    order = np.random.default_rng(1).permutation(500)
    assert (min_labels(500, order[:-1], order[1:]) == 0).all()


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert near_duplicates(make_docs().withColumnRenamed("lang", "code")).count() == 0
    odd = make_docs((1, "a b c"), (2, "a b c")).withColumnsRenamed({"lang": "component_id", "source": "fingerprint"})
    assert {r.component_id for r in near_duplicates(odd).collect()} == {1}
