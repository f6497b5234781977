import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import langid
from eventloom.llm.common import remainder
from eventloom.llm.queries import op8_langid

WORDS = {"aa": "hopa lemi sura tolin vesta".split(), "bb": "grun dreck stolz klam pfort".split(), "cc": "жук лес вода море небо".split()}


def sample(language, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[language]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark, make_docs):
    rows = [(i, sample(lang, 40, i), lang) for i in range(60) for lang in WORDS]
    return langid.fit(make_docs(*rows, (1000, None, "aa"), (1001, "text", None)))


def test_edge_texts(spark, make_docs, model):
    rows = [(1, None), (2, ""), (3, "12 — !? \n"), (4, "x"), (5, sample("bb", 1, 1)), (6, sample("cc", 60_000, 2)), (6, sample("cc", 9, 2))]
    docs = make_docs(*rows).withColumnRenamed("source", "score")
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, model).orderBy("doc_id").collect()]
    assert [f[1] for f in found[:3]] == ["und"] * 3 and found[3][1] in WORDS
    assert [f[1] for f in found[4:]] == ["bb", "cc", "cc"]
    assert all(0 <= f[2] <= 1 for f in found) and found[5][2] > 0.9 and found[3][2] == 0


def test_no_labels_and_no_rows(spark, make_docs, model):
    assert langid.fit(make_docs((1, "abc", None))) is None
    assert langid.identify(make_docs((1, "abc")), None).collect()[0].lang_pred == "und"
    assert langid.identify(make_docs(), model).count() == 0


def test_filter_returns_every_language_that_contains(model):
    keys, _, _ = langid.grams(["hopa жук"])
    for key in keys:
        mask = int(model.masks(np.array([key]))[0, 0])
        assert mask == 0 or mask.bit_count() >= 1
    many = {f"l{i:03}": np.arange(i * 100, i * 100 + 150, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(130)}
    wide = langid.LanguageFilter(many)
    key = many["l100"][10:11]
    row = wide.masks(key)
    held = {name for i, name in enumerate(wide.languages) if int(row[0, i // 64]) >> (i % 64) & 1}
    assert {"l100", "l099"} <= held and len(held) < 6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").withColumn("check", remainder("doc_id", 4) == 2)
    found = op8_langid(spark, sf).join(docs, "doc_id")
    assert found.filter("held_out <> check").count() == 0
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert right > 0.95


def test_a_language_of_one_text_and_a_hot_text(spark, make_docs, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    one, hot = sample("cc", 60, 1), sample("bb", 60, 2)
    rows = [(i, one, "cc") for i in range(600)] + [(i, hot, "bb") for i in range(600)]
    rows += [(i, sample("bb", 40, i), "bb") for i in range(100)] + [(i, sample("aa", 40, i), "aa") for i in range(200)]
    model = langid.fit(make_docs(*rows))
    found = langid.identify(make_docs((1, one), (2, hot), (3, sample("aa", 30, 999))), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["cc", "bb", "aa"] and all(r.score > 0.5 for r in found)


def plain_grams(text):
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    line = re.sub(" +", " ", f" {low} ")
    return [line[i : i + langid.GRAM] for i in range(len(line) - langid.GRAM + 1)]


def test_against_sets_of_grams(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", (remainder("doc_id", 4) == 2).alias("held_out"))
    rows = docs.collect()
    counts = defaultdict(Counter)
    for lang, text in {(r.lang, r.text) for r in rows if not r.held_out and r.lang is not None and r.text is not None}:
        counts[lang].update(plain_grams(text))
    shares = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for held in shares.values():
        for g, x in held.items():
            top[g] = max(top[g], x)
    sets = {lang: {g for g, x in held.items() if x >= langid.LEAST_SHARE and x >= langid.LEAST_PART * top[g]} for lang, held in shares.items()}
    found = {r.doc_id: r for r in op8_langid(spark, sf).collect()}
    assert len(found) == len(rows) and len(sets) > 2
    clear = 0
    for r in rows:
        grams = plain_grams(r.text)
        share = {lang: sum(g in held for g in grams) / max(len(grams), 1) for lang, held in sets.items()}
        best = sorted(share, key=lambda lang: (-share[lang], lang))
        got = found[r.doc_id]
        if not any(c.isalpha() for c in r.text or ""):
            assert (got.lang_pred, got.score) == ("und", 0)
            continue
        # A filter errs by chance in some of a text's grams, the more so the fewer there are.
        slack = 0.01 + 2 / max(len(grams), 1)
        assert abs(got.score - share[got.lang_pred]) < slack and share[got.lang_pred] > share[best[0]] - 2 * slack
        if share[best[0]] - share[best[1]] > 2 * slack:
            clear += 1
            assert got.lang_pred == best[0]
    assert clear > len(rows) * 0.8
