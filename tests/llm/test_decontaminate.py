import random
from itertools import combinations
from math import floor

import pytest

from eventloom.llm.decontaminate import _item_masks, all_masks, leaks



def lossless(length, substitutions):
    masks = [all_masks()[i] for i in _item_masks(length)]
    size = min(length, 20)
    for changed in combinations(range(size), substitutions):
        if not any(
            all(m == "0" or at + j not in changed for j, m in enumerate(mask)) for mask in masks for at in range(size - len(mask) + 1)
        ):
            return False
    return True


@pytest.mark.parametrize("length", [*range(1, 21), 40])
def test_masks_lose_no_window(length):
    assert lossless(length, floor(0.2 * min(length, 20)) if length >= 5 else 0)


def test_substitutions_and_edges(spark, make_docs):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = {i: [rng.choice(vocabulary) for _ in range(n)] for i, n in enumerate((40, 25, 20, 12, 7, 5, 3, 1))}
    items[1] = items[1][:-1] + ["solo1"]

    def planted(item, changed, around=200):
        body = list(item)
        for i in rng.sample(range(len(body)), changed):
            body[i] = "changed"
        left, right = ([rng.choice(vocabulary) for _ in range(around)] for _ in range(2))
        return " ".join(left + body + right)

    docs, want = [], set()
    for i in range(60):
        key = i % 6
        changed = floor(0.2 * min(20, len(items[key])))
        docs.append((100 + i, planted(items[key], changed if i % 2 else 0)))
        if i % 2 == 0 or len(items[key]) <= 20:
            want.add((100 + i, key))
    for i in range(200, 260):
        docs.append((i, planted([rng.choice(vocabulary) for _ in range(30)], 0)))
        docs.append((i + 100, planted(items[2], 9)))
    docs += [(900, None), (901, ""), (902, "... !!"), (903, " ".join(items[0]).upper().replace(" ", ", ")), (903, "twice"), (None, " ".join(items[4]))]
    docs.append((904, planted(items[3], 0, 30_000)))
    want |= {(903, 0), (None, 4), (904, 3)}
    frame = spark.createDataFrame(
        [(k, " ".join(v)) for k, v in items.items() if len(v) >= 5] + [(50, " ".join(items[0])), (51, None), (52, ""), (None, "w1 w2 w3 w4 w5")],
        "item_id BIGINT, text STRING",
    )
    found = {(r.doc_id, r.item_id) for r in leaks(make_docs(*docs).withColumnRenamed("lang", "seed"), frame).collect()}
    assert want <= found
    # Longer items with four changed words somewhere leak too where a window of twenty keeps sixteen of them.
    assert {d for d, _ in found - want} <= {100 + i for i in range(60) if i % 2 and len(items[i % 6]) > 20}


def test_short_items_match_whole(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three"), (2, "solo")], "item_id BIGINT, text STRING")
    docs = make_docs((1, "zero ONE, two three four"), (2, "one two x three"), (3, "a solo b"), (4, "soloist"))
    assert {(r.doc_id, r.item_id, r.similarity) for r in leaks(docs, items).collect()} == {(1, 1, 1.0), (3, 2, 1.0)}


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three four five")], "item_id BIGINT, text STRING")
    assert leaks(make_docs(), items).count() == 0
    assert leaks(make_docs((1, "one two three four five")), items.limit(0)).count() == 0


def test_every_item_of_a_shared_passage_against_all_windows(spark, make_docs):
    rng = random.Random(11)
    words = [f"v{i}" for i in range(900)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    shared = draw(120)
    items = {1: shared + draw(30), 2: shared + draw(30), 3: draw(25), 4: draw(60), 5: shared[30:80], 6: draw(8), 7: shared[40:52], None: draw(30)}
    docs = {7: draw(50) + shared[40:70] + draw(50), 8: draw(200), 9: items[None], 10: draw(9) + items[6] + draw(9), 11: items[4][:45], 12: []}
    for i in range(20, 50):
        body = list(rng.choice([v for v in items.values()]))
        for j in range(len(body)):
            if rng.random() < 0.12:
                body[j] = rng.choice(words)
        docs[i] = draw(rng.randint(0, 30)) + body[rng.randint(0, 10) :] + draw(rng.randint(0, 30))
    want = set()
    for d, text in docs.items():
        for k, item in items.items():
            size = min(20, len(item))
            windows = [item[i : i + size] for i in range(len(item) - size + 1)]
            places = [text[i : i + size] for i in range(len(text) - size + 1)]
            best = max((sum(x == y for x, y in zip(w, p)) for w in windows for p in places), default=0)
            if best >= size * 0.8 - 1e-9:
                want.add((d, k, best, size))
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id BIGINT, text STRING")
    found = {(r.doc_id, r.item_id, r.n_equal, r.n_window) for r in leaks(make_docs(*[(d, " ".join(t)) for d, t in docs.items()]), frame).collect()}
    assert {(7, 1), (7, 2), (9, None)} <= {f[:2] for f in found}
    assert found == want
