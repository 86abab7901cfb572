"""Held-out accuracy of learned scores, and their answers to odd rows."""

import zlib

from pyspark.sql import functions as F

from convoy.llm.language import identify
from convoy.llm.quality import quality_scores
from convoy.llm.toxicity import toxicity_scores, without_toxic

DATA = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, score double, y int, x long"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "12 !? 34"), (5, "x" * 200_000), (6, "été " * 80_000),
    (None, "text"), (7, "same"), (7, "same"), (8, "中文 ǅ 😀"),
]


def odd_rows(spark):
    return spark.createDataFrame([(i, t, "en" if i != 6 else None, 0.5, 1, 2) for i, t in ODD], SCHEMA)


def test_quality_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    tested = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert sum(tested) >= 0.97 * len(tested)


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (3, None), (4, 7), (5, 1), (5, 1), (None, 1), (8, 0)], "doc_id long, quality int"
    )
    rows = quality_scores(odd_rows(spark), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = quality_scores(odd_rows(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_scores(odd_rows(spark).limit(0), labels).collect() == []


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert len(rows) == docs.count() and sum(tested) >= 0.99 * len(tested)


def test_language_odd_rows(spark):
    rows = identify(odd_rows(spark)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.lang_pred for r in rows}
    assert [by_id[i] for i in (1, 2, 3, 4)] == ["und"] * 4
    assert [by_id[i] for i in (5, 6, 7, 8, None)] == ["en"] * 5
    nothing = odd_rows(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(nothing).collect()} == {"und"}
    assert identify(odd_rows(spark).limit(0)).collect() == []


def test_toxicity_of_unseen_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    rows = toxicity_scores(docs, labels.filter(~unseen)).join(
        labels.filter(unseen).select("doc_id", "toxic"), "doc_id"
    ).collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    bad = [r.predicted for r in rows if r.toxic == 1]
    print(sum(clean), len(clean), sum(bad), len(bad))
    assert sum(clean) <= 0.01 * len(clean) and sum(bad) >= 0.85 * len(bad)


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(7, 1), (1, 0), (2, 0), (5, 0), (8, 9), (9, 1)], "doc_id long, toxic int")
    rows = toxicity_scores(odd_rows(spark), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    kept = without_toxic(odd_rows(spark), labels)
    assert kept.columns == odd_rows(spark).columns and kept.count() <= len(ODD)
    assert {r.score for r in toxicity_scores(odd_rows(spark), labels.limit(0)).collect()} == {0.0}
    assert toxicity_scores(odd_rows(spark).limit(0), labels).collect() == []
