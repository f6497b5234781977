import math

import numpy as np

from eventloom.llm import ann
from eventloom.llm.queries import op4_ann

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def brute(rows, k=20, every=20):
    good = [(i, v) for i, v in rows if i is not None and v and any(v) and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            scored = {(float(np.dot(np.float64(np.float32(q)), np.float64(np.float32(v)))), j) for j, v in good if j != i and len(v) == len(q)}
            best = {}
            for s, j in scored:
                best[j] = max(s, best.get(j, -math.inf))
            out[i] = sorted(((-s, j) for j, s in best.items()))[:k]
    return out


def agree(found, wanted):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {q for q, best in wanted.items() if best}
    hits = total = 0
    for q, best in wanted.items():
        rows = sorted(got.get(q, []))
        assert [r[0] for r in rows] == list(range(1, len(best) + 1))
        assert all(abs(r[2] - (-b[0])) < 1e-6 for r, b in zip(rows, best))
        hits += len({r[1] for r in rows} & {b[1] for b in best})
        total += len(best)
    return hits / max(total, 1)


def test_edges_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]) for i in range(300, 420)]
    rows += [(500, None), (520, []), (540, [0.0] * 6), (560, [1.0, float("nan")] * 3), (580, [1.0, None] * 3), (600, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (720, [1.0, 1.0, 1.0]), (20, rows[20][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumnRenamed("label", "score")
    assert agree(ann.search(frame).collect(), brute(rows)) == 1


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 70)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 9)
    rng = np.random.default_rng(2)
    rows = [(i, np.float32(rng.standard_normal(20)).tolist()) for i in range(500)]
    assert agree(ann.search(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect(), brute(rows)) > 0.99


def test_bounds_hold():
    rng = np.random.default_rng(3)
    vectors, queries = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    guess, width = ann.estimate(*ann.encode(vectors), queries)
    inside = np.abs(guess - queries @ vectors.T) <= width
    assert inside.mean() > 0.998


def test_recall_and_empty(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert agree(op4_ann(spark, sf).collect(), brute(rows)) >= 0.99
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_share_compared_in_full():
    rng = np.random.default_rng(5)
    vectors, queries = rng.standard_normal((6000, 64)), rng.standard_normal((40, 64))
    guess, width = ann.estimate(*ann.encode(vectors), queries)
    near = ann.chosen(guess, width, np.zeros(guess.shape, bool), vectors, queries, 20)
    scores = queries @ vectors.T
    best = np.argsort(-scores, axis=1)[:, :20]
    assert near.mean() < 0.65 and np.take_along_axis(near, best, axis=1).mean() > 0.99
