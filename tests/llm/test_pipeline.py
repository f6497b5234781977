import random

from pyspark.sql import functions as F

from corpus_pipeline import STAGES, drop_leaks, drop_near_duplicates, keep_languages, redact_secrets, run
from eventloom.llm.simhash import near_duplicates


def test_stages_in_order(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= before
        before = docs.count()
    pieces = STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    # Which window a piece goes to depends on how rows lie in files; the documents and their tokens don't.
    ids = ["doc_id", "doc_tokens"]
    assert set(run(spark, sf).select(*ids).collect()) == set(pieces.select(*ids).collect())


def test_odd_rows_pass_through_every_stage(spark, make_docs):
    sf = "/root/testdata/sf0.001"
    rows = [(1, "the same words here again"), (2, "the same words here again"), (2, "the same words here again"), (None, None), (3, ""), (4, "x" * 200_000)]
    docs = make_docs(*rows).withColumnsRenamed({"source": "code"})
    for _, stage in STAGES:
        stage(spark, docs, sf).count()
        stage(spark, docs.limit(0), sf).count()
    assert sorted(r.doc_id for r in drop_near_duplicates(spark, docs.filter("doc_id < 3"), sf).collect()) == [1]
    assert {r.doc_id for r in drop_leaks(spark, docs, sf).collect()} == {1, 2, 3, 4, None}
    assert redact_secrets(spark, docs, sf).count() == len(rows)
    assert None not in {r.text for r in keep_languages(spark, docs, sf).collect()}


def test_languages_kept_and_dropped(spark, make_docs):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    odd = make_docs((9001, "A."), (9002, "123 !"), (9003, "xqzjk wvqxz jjqxv kkwzx qqvjx zxqkw vjxqz"), (9004, ""))
    kept = {r.doc_id for r in keep_languages(spark, given.unionByName(odd), sf).collect()}
    assert 9001 in kept and not kept & {9002, 9003, 9004} and len(kept) == given.count() + 1


def test_rows_are_told_apart_by_row_not_by_id(spark, make_docs):
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").filter("item_id IS NOT NULL AND length(text) > 150").head().text
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    docs = make_docs((2, one), (5, one), (5, two), (None, three), (None, one))
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(spark, docs, sf).collect()]
    assert sorted(kept, key=str) == sorted([(2, one), (5, two), (None, three)], key=str)
    docs = make_docs((None, item), (None, one), (7, two), (7, f"{three} {item} {three}"), (7, two))
    left = [(r.doc_id, r.text) for r in drop_leaks(spark, docs, sf).collect()]
    assert sorted(left, key=str) == sorted([(None, one), (7, two), (7, two)], key=str)


def test_columns_of_any_name_pass_unchanged(spark, make_docs):
    sf = "/root/testdata/sf0.001"
    names = ["score", "lang_pred", "secrets", "row", "Row_", "component_id", "links_to", "number", "seed", "block"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 60")
    marked = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in STAGES[:-1]:
        out = stage(spark, marked, sf)
        assert out.columns == marked.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names), name
        assert {r.doc_id for r in rows} == {r.doc_id for r in stage(spark, docs, sf).collect()}, name
    assert STAGES[-1][1](spark, marked, sf).count() == STAGES[-1][1](spark, docs, sf).count()


def test_one_of_each_near_copy_stays(spark, make_docs):
    rng = random.Random(7)
    draw = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, other = draw(4000), draw(4000)
    near = [*base[:2000], "changed", *base[2001:]]
    docs = make_docs((9, " ".join(base)), (4, " ".join(near)), (7, " ".join(base).upper()), (5, " ".join(other)))
    groups = {}
    for r in near_duplicates(docs).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    kept = {r.doc_id for r in drop_near_duplicates(spark, docs, "/root/testdata/sf0.001").collect()}
    assert kept == {min(g) for g in groups.values()} and 5 in kept and len(kept) <= 3
