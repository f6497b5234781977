import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.llm import toxicity
from eventloom.llm.common import remainder
from eventloom.llm.queries import op9_toxicity


def labelled(spark, n=600):
    rng = random.Random(2)
    plain = [f"word{int(rng.paretovariate(1))}" for _ in range(500)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "filth"]))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")


@pytest.fixture(scope="module")
def scorer(spark):
    return toxicity.fit(labelled(spark), labelled(spark))


def test_separates(spark, scorer):
    frame = labelled(spark).withColumnsRenamed({"toxic": "predicted"})
    found = toxicity.score(frame, scorer).join(labelled(spark), "doc_id")
    right = found.agg(F.avg((found["predicted"] == found["toxic"]).cast("int"))).head()[0]
    assert right > 0.97


def test_edges(spark, scorer, make_docs):
    long = "word1 word2 " * 20_000
    rows = [(1, None), (2, ""), (3, " !? "), (4, long), (5, long + "you vile rotten filth of a vile word1 filth"), (5, "vile"), (6, "new terms only")]
    found = toxicity.score(make_docs(*rows), scorer).orderBy("doc_id").collect()
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
    assert [r.predicted for r in found if r.doc_id in (1, 2, 3, 4, 6)] == [0] * 5
    assert [r.predicted for r in found if r.doc_id == 5][0] == 1
    assert toxicity.score(make_docs(), scorer).count() == 0


def test_without_both_classes(spark, make_docs):
    assert toxicity.fit(labelled(spark), labelled(spark).filter("toxic = 0")) is None
    assert toxicity.score(make_docs((1, "x")), None).head().score == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    before, word = (x.ravel().astype(np.uint64) for x in np.meshgrid(np.arange(1, 9), np.arange(1, 30)))
    n = [rng.integers(0, 60, len(word)) * (rng.random(len(word)) < 0.5) for _ in range(2)]
    contexts, words = np.arange(1, 9, dtype=np.uint64), np.arange(1, 30, dtype=np.uint64)
    by = lambda keys, key, f: [np.array([f(v[keys == k]) for k in key], float) for v in n]
    model = toxicity.KneserNey(
        (before, word, *n),
        (contexts, *by(before, contexts, np.sum), *by(before, contexts, lambda v: np.minimum(v, toxicity.PAIR_DISCOUNT).sum())),
        (words, *by(word, words, np.count_nonzero)),
    )
    every = np.append(words, np.uint64(999))
    for context in (1, 5, 77):
        for c in (0, 1):
            assert abs(model.probabilities(np.full(len(every), context, np.uint64), every, c).sum() - 1) < 1e-5


def test_all_ordinary_labels_are_counted(spark):
    docs = spark.createDataFrame([(i, f"only{i}", int(i % 10 == 0)) for i in range(600)], "doc_id BIGINT, text STRING, toxic INT")
    assert toxicity.fit(docs, docs).model.types[0] > 300


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(found) and found.groupby("predicted").toxic.mean().to_dict().get(1, 0) > 0.9
    toxic, other = found[found.toxic == 1].score.to_numpy(), found[found.toxic == 0].score.to_numpy()
    # These tables have some two hundred toxic texts to learn from; a table of ten times as many gives an area of 1.
    assert (toxic[:, None] > other[None, :]).mean() > 0.82
    assert (toxic >= 0.7).mean() > 0.5
    assert op9_toxicity(spark, sf).filter(F.col("held_out") != (remainder("doc_id", 3) == 1)).count() == 0


def plain_models(counted, pair_discount):
    """Per class P(word | word before) by dictionaries, from (text, toxic) rows."""
    texts_of, lefts_of, word_texts, befores_of = ([defaultdict(set) for _ in range(2)] for _ in range(4))
    for i, (text, c) in enumerate(set(counted)):
        words = ["<s>", "<s>", *plain_words(text)]
        for left, before, word in zip(words, words[1:], words[2:]):
            texts_of[c][before, word].add(i)
            lefts_of[c][before, word].add(left)
            word_texts[c][word].add(i)
            befores_of[c][word].add(before)
    pairs = [{k: min(len(v), len(lefts_of[c][k])) for k, v in texts_of[c].items()} for c in (0, 1)]
    words = [{k: min(len(v), len(befores_of[c][k])) for k, v in word_texts[c].items()} for c in (0, 1)]
    contexts = [defaultdict(list) for _ in range(2)]
    for c in (0, 1):
        for (before, _), n in pairs[c].items():
            contexts[c][before].append(n)
    every = set(words[0]) | set(words[1])
    d = toxicity.DISCOUNT
    shared_n = {w: sum(min(words[c].get(w, 0), d) for c in (0, 1)) for w in every}
    total = sum(shared_n.values())

    def p(before, word, c):
        s = toxicity.SHARED_DISCOUNT
        shared = max(shared_n.get(word, 0) - s, 0) / total + min(1, s * len(every) / total) / (len(every) + 1)
        types = sum(words[c].values())
        lower = max(words[c].get(word, 0) - d, 0) / types + sum(min(n, d) for n in words[c].values()) / types * shared
        n = contexts[c].get(before)
        if not n:
            return lower
        return max(pairs[c].get((before, word), 0) - pair_discount, 0) / sum(n) + sum(min(x, pair_discount) for x in n) / sum(n) * lower

    return p


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", low)


def plain_features(p, text):
    words = plain_words(text)
    d = [math.log(p(b, w, 1)) - math.log(p(b, w, 0)) for b, w in zip(["<s>", *words], words)]
    if not d:
        return [0.0] * (1 + len(toxicity.WINDOWS))
    out = [sum(d) / len(d)]
    for size, step in toxicity.WINDOWS:
        ends = [min(s + size, len(d)) for s in range(0, max(1, len(d) - size + step), step)]
        out.append(max(sum(d[max(e - size, 0) : e]) / size for e in ends))
    return out


@pytest.mark.parametrize("pair_discount", [20.0, 0.7])
def test_against_dictionaries(spark, pair_discount):
    docs = labelled(spark, 450)
    copies = docs.filter("doc_id < 30").select((F.col("doc_id") + 1000).alias("doc_id"), "text", "toxic")
    shared_id = spark.createDataFrame([(7, "a second text of the id", 0), (8, None, 1), (2000, "both labels", 0), (2000, "both labels", 1)], docs.schema)
    docs = docs.unionByName(copies).unionByName(shared_id)
    scorer = toxicity.fit(docs.select("doc_id", "text").distinct(), docs.select("doc_id", "toxic"), pair_discount=pair_discount)
    hashed = docs.withColumn("part", F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(3))).withColumn("name", F.xxhash64("text"))
    one = {}
    for r in hashed.filter("text IS NOT NULL").collect():
        key = (r.doc_id, r.toxic, r.part)
        if key not in one or r.name < one[key][0]:
            one[key] = (r.name, r.text)
    p = plain_models([(text, c) for (_, c, part), (_, text) in one.items() if part < 2], pair_discount)
    probe = [text for _, text in list(one.values())[::9]] + ["", "unseen words vile", "Vile, WORD1 rotten!"]
    want = np.array([plain_features(p, t) for t in probe])
    assert np.allclose(scorer.model.features(pa.array(probe)), want, rtol=1e-3, atol=1e-4)
    found = toxicity.score(spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "doc_id long, text string"), scorer).orderBy("doc_id").collect()
    x = np.column_stack([np.ones(len(want)), want])
    assert np.allclose([r.score for r in found], 1 / (1 + np.exp(-x @ scorer.weights)), atol=2e-3)
    # The weights are where the slope of the shrunk likelihood of the rows that were not counted vanishes.
    held = [(text, c) for (_, c, part), (_, text) in one.items() if part == 2]
    x = np.column_stack([np.ones(len(held)), [plain_features(p, t) for t, _ in held]])
    slope = x.T @ (np.array([c for _, c in held]) - 1 / (1 + np.exp(-x @ scorer.weights))) - 1e-2 * scorer.weights
    assert np.abs(slope).max() < 1e-2


def test_an_id_of_many_texts_brings_one(spark):
    docs = labelled(spark, 90)
    hot = spark.range(400).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("hotword"), F.col("id")).alias("text"))
    scorer = toxicity.fit(docs.select("doc_id", "text").unionByName(hot), docs.select("doc_id", "toxic"))
    plain = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert abs(scorer.model.all_words - plain.model.all_words) < 60
