import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import repeats
from eventloom.llm.queries import op2_repeats
from eventloom.llm.windows import gram_hashes, sliding


def plain(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(length):
    rng = random.Random(length)
    draw = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [draw(n) for n in (length, length - 1, length + 1, 2 * length, 5 * length)]
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * (3 * length)), (5, "ab" * length), (None, draw(length * 2))]
    for i in range(10, 60):
        parts = [draw(rng.randint(0, length))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, len(passage) // 2) if rng.random() < 0.5 else 0
            parts += [passage[cut:], draw(rng.randint(0, 60))]
        rows.append((i, "".join(parts)))
    base = draw(6 * length)
    for i in range(100, 130):
        at = rng.randrange(len(base))
        rows.append((i, base[:at] + "X" + base[at + rng.randint(0, 2) :]))
    rows += [(200, rows[20][1]), (200, rows[20][1]), (None, rows[21][1])]
    return rows


@pytest.mark.parametrize("length,block", [(60, 8_000_000), (60, 2_000), (400, 20_000)])
def test_matches_all_windows(spark, make_docs, length, block, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    rows = texts(length)
    docs = make_docs(*rows).withColumnsRenamed({"lang": "block", "source": "kept"})
    found = repeats.remove_repeats(docs, length).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == plain(rows, length)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in found)


def test_windows_and_hashes():
    data = np.frombuffer(b"abcdefghij" * 30, np.uint8)
    for size in (1, 2, 3, 7, 31, 32, 100, 300):
        hashes = gram_hashes(data, size)
        assert len(hashes) == 301 - size and len(np.unique(hashes)) == min(10, len(hashes))
    values = np.random.default_rng(1).integers(0, 50, 97).astype(np.uint64)
    for width in (1, 4, 97, 98):
        want = [values[i : i + width] for i in range(len(values) - width + 1)]
        assert sliding(values, width, True).tolist() == [w.min() for w in want]
        assert sliding(values, width, False).tolist() == [w.max() for w in want]


def test_empty_table_and_one_long_text(spark, make_docs):
    assert repeats.remove_repeats(make_docs()).count() == 0
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    found = {r.doc_id: r for r in repeats.remove_repeats(make_docs((1, body), (2, "zz" + body[1000:1500]))).collect()}
    assert (found[1].n_removed, found[1].n_spans) == (500, 1) and found[2].n_removed == 500


def test_a_text_longer_than_a_segment(spark, make_docs):
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefgh") for _ in range(repeats.SEGMENT + 300_000))
    at = repeats.SEGMENT
    rows = [(1, body), (2, "zz" + body[at - 700 : at + 150] + "zz"), (3, body[at - 100 : at + 900]), (4, body[:450] + "zz" + body[-420:])]
    found = {r.doc_id: r for r in repeats.remove_repeats(make_docs(*rows)).collect()}
    assert (found[1].n_removed, found[1].n_spans) == (1600 + 450 + 420, 3)
    assert [found[i].n_removed for i in (2, 3, 4)] == [850, 1000, 870]
    assert found[4].kept == b"zz"


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r)[:5] for r in op2_repeats(spark, sf).collect()), key=str) == plain(rows, 400)


def test_texts_are_shuffled_once(spark, make_docs):
    found = repeats.remove_repeats(make_docs(*texts(60)), 60)
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt_out = [line for line in plan.splitlines() if "Exchange hashpartitioning(block" in line and "kind" not in line]
    assert len(rows) == len(texts(60))
    # By block: the texts, and the answers for either reader.
    assert len([line for line in dealt_out if "Reused" not in line]) == 3, plan
    assert plan.count("ReusedExchange") >= 3, plan
