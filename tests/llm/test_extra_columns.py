"""Further columns, whatever they are called or hold, neither break nor change a result."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from convoy.llm import (
    bestfit,
    clusters,
    codes,
    decontamination,
    language,
    licenses,
    minhash,
    packing,
    quality,
    suffixes,
    token_counts,
    toxicity,
    vectors,
)

SMALL = "/root/testdata/sf0.001"
# Names that operators and stages use inside, a dotted one, and one with a quote.
NAMES = [
    "first", "_key", "key", "a.b", "b`c", "n", "others", "row", "id", "digest", "least", "shared", "count",
    "kept", "spans", "rep", "cell", "home", "token", "band", "bucket", "words", "h", "x", "p0", "label2",
    "place", "part", "partition", "bin", "offset", "length", "ids", "point", "cluster", "seen", "score",
    "component_id", "node", "component", "links", "code", "error", "text_a", "m",
]


def widened(df):
    """``df`` with all of these columns, and a map, an array and a struct."""
    more = [F.lit("z").alias(name) for name in NAMES if name not in df.columns]
    nested = [
        F.create_map(F.lit("k"), F.lit(1)).alias("a_map"),
        F.array(F.lit(1.5)).alias("an_array"),
        F.struct(F.lit(1).alias("a.b"), F.lit(None).cast("string").alias("c")).alias("a_struct"),
    ]
    return df.select("*", *more, *nested)


@pytest.fixture(scope="module")
def tables(spark):
    names = ("documents", "labels", "benchmark", "embeddings")
    return {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in names}


OPERATORS = {
    "minhash": lambda t: minhash.near_duplicates(t["documents"]),
    "toxicity": lambda t: toxicity.toxicity_scores(t["documents"], t["labels"]),
    "licenses": lambda t: licenses.license_digest(licenses.license_scan(t["documents"])),
    "vectors": lambda t: vectors.near_vectors(t["embeddings"]),
    "suffixes": lambda t: suffixes.removal_digest(suffixes.without_repeats(t["documents"])),
    "token_counts": lambda t: token_counts.limit_table(token_counts.length_histogram(t["documents"])),
    "quality": lambda t: quality.quality_scores(t["documents"], t["labels"]),
    "packing": lambda t: packing.pack(t["documents"]),
    "decontamination": lambda t: decontamination.contaminated(t["documents"], t["benchmark"]),
    "language": lambda t: language.identify(t["documents"]),
    "clusters": lambda t: clusters.clustered(t["embeddings"]),
    "codes": lambda t: codes.coded(t["embeddings"]),
    "bestfit": lambda t: bestfit.best_fit_packed(t["documents"]).drop("sequence_id", "offset"),
}


def as_text(df):
    """A row as text, numbers of models rounded."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        shown.append(F.round(c, 6) if f.dataType.simpleString() in ("double", "float") else c)
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*shown))).collect())


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators(tables, name):
    plain = OPERATORS[name](tables)
    wide = OPERATORS[name]({n: widened(df) for n, df in tables.items()})
    assert wide.columns == plain.columns
    assert as_text(wide) == as_text(plain)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, tables, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = tables["documents"]
    plain, wide = stage(spark, docs, SMALL), stage(spark, widened(docs), SMALL)
    if name == "packing":
        assert as_text(wide) == as_text(plain)
        return
    assert wide.columns == widened(docs).columns
    assert wide.dtypes == widened(docs).dtypes
    assert as_text(wide.select(*docs.columns)) == as_text(plain)
    # Values of the further columns come through.
    values = wide.agg(F.min("a_map.k"), F.max(F.col("a_struct")["a.b"]), F.min("`a.b`"), F.min("`b``c`")).first()
    assert tuple(values) == (1, 1, "z", "z")


def test_rows_under_one_id_with_maps(spark):
    schema = "doc_id long, text string, a_map map<string, int>, `first` string"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, {"a": 1}, "x"), (1, long, {"a": 1}, "x"), (1, "another text", {"a": 2}, "x"),
            (2, long + " end", None, "y"), (None, long, {"a": 3}, "z"), (None, None, None, None)]
    left = corpus_pipeline.near_duplicate(spark, spark.createDataFrame(rows, schema), SMALL)
    assert sorted(map(str, left.collect())) == sorted(map(str, spark.createDataFrame([rows[0], *rows[2:3], *rows[4:]], schema).collect()))
