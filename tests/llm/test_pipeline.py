"""The stages of the corpus pipeline on rows whose fate is known."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from convoy.llm.tables import landed
from tests.llm.test_minhash import edited, shingles
from tests.llm.test_suffixes import expected

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(landed(stage(spark, out[-1], DATA), name))
    return out


def test_columns(stages):
    assert all(d.dtypes == stages[0].dtypes for d in stages[1:-1])
    assert "sequence_id" in stages[-1].columns


def test_toxic_rows_go_and_clean_ones_stay(stages, spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    left = {r.doc_id for r in stages[1].collect()}
    known = labels.collect()
    assert sum(r.doc_id in left for r in known if r.toxic == 0) >= 0.99 * sum(r.toxic == 0 for r in known)
    assert sum(r.doc_id in left for r in known if r.toxic == 1) <= 0.25 * sum(r.toxic == 1 for r in known)


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: r.text for r in stages[2].collect()}
    first = {}
    for i in sorted(before):
        first.setdefault(" ".join(before[i].lower().split()), i)
    assert set(after) <= set(first.values()) and len(after) > 0.8 * len(before)


def test_repeated_text_goes(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    wanted = {i: (n, gone) for i, (n, gone, _, _) in expected(before, 100).items()}
    after = {r.doc_id: r for r in stages[3].collect()}
    for i, text in before:
        size, gone = wanted[i]
        if gone == 0:
            assert after[i].text == text
        elif i in after:
            assert size - gone - 6 <= len(after[i].text.encode()) <= size - gone
            assert after[i].n_chars == len(after[i].text)
        else:
            assert size - gone < 6


def test_all_tokens_are_packed(stages):
    left = {r.doc_id for r in stages[4].collect()}
    per_doc = stages[5].groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("all")
    )
    rows = per_doc.collect()
    assert {r.doc_id for r in rows} == left and all(r.n == r.all for r in rows)


def test_odd_rows_and_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rng = random.Random(0)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.random()) for _ in range(20_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x y z", "en", "s", 5),
            (3, long, "en", "s", 1), (4, long, "en", "s", 1), (5, "a b", None, "s", 3), (5, "a b", None, "s", 3)]
    for table in (spark.createDataFrame(rows, docs.schema), docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = landed(stage(spark, table, DATA), name)
        found = {r.doc_id for r in table.collect()}
    assert found == set()


def test_near_copies_go_from_a_similarity_of_080(spark):
    rng = random.Random(12)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    rows, wanted, between = [], set(), 0
    for k in range(120):
        words = [f"v{rng.randint(0, 10**6)}" for _ in range(rng.randint(120, 300))]
        copy = edited(rng, words, max(1, round(len(words) * rng.uniform(0.01, 0.035))))
        rows += [(2 * k, " ".join(words), "en", "s", 1), (2 * k + 1, copy, "en", "s", 1)]
        one, other = shingles(rows[-2][1]), shingles(copy)
        similar = 100 * len(one & other) >= 80 * len(one | other)
        between += similar and 100 * len(one & other) < 85 * len(one | other)
        wanted |= {2 * k} if similar else {2 * k, 2 * k + 1}
    table = spark.createDataFrame(rows, docs.schema)
    left = {r.doc_id for r in corpus_pipeline.near_duplicate(spark, table, DATA).collect()}
    assert between > 10 and left == wanted


def test_rows_without_an_id_and_texts_under_one_id_stay(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    rows = [(None, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (1, "h i j k l m n", "en", "s", 13),
            (1, "a b c d e f g", "en", "s", 13), (2, "h i j k l m n", "en", "s", 13)]
    left = corpus_pipeline.near_duplicate(spark, spark.createDataFrame(rows, docs.schema), DATA)
    texts = sorted((r.doc_id or 0, r.text) for r in left.collect())
    assert texts[:2] == [(0, rows[0][1]), (1, rows[0][1])] and len(texts) == 3 and texts[2][1] == rows[2][1]
