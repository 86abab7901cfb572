"""From raw documents to packed sequences, in stages that each land as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.llm.decontamination import without_benchmark
from convoy.llm.minhash import near_duplicates
from convoy.llm.packing import pack
from convoy.llm.suffixes import without_repeats
from convoy.llm.tables import documents, landed, whole_row
from convoy.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain learned from ``labels`` does not reject."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


# A row as a whole, beside which no name of its own columns can clash.
_ROW = "row"


def _comparable(docs: DataFrame) -> list[Column]:
    """The columns of ``_ROW`` in forms that can be grouped: maps as JSON text."""
    parts = []
    for field in docs.schema.fields:
        part = F.col(_ROW).getField(field.name)
        parts.append(F.to_json(F.struct(part)) if "map<" in field.dataType.simpleString() else part)
    return parts


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates.

    Shingle sets are linked from a similarity of 0.8. 32 bands of 5 miss a pair there
    with probability 3e-6. Of equal rows with an id one stays, different rows under one id
    are documents of their own, and rows without a doc_id are linked with nothing.
    """
    rows = docs.filter("doc_id IS NOT NULL")
    rows = rows.select(F.col("doc_id").cast("long").alias("id"), whole_row(docs, _ROW))
    again = rows.groupBy(F.col("id").alias("shared")).count().filter("count > 1").select("shared")
    again = landed(again, "shared")
    alone = rows.join(again, rows["id"] == again["shared"], "left_anti")
    # Only rows under a shared id are compared with each other.
    several = rows.join(again, rows["id"] == again["shared"], "left_semi")
    parts = {f"p{i}": part for i, part in enumerate(_comparable(docs))}
    several = several.select("id", _ROW, *[part.alias(p) for p, part in parts.items()])
    several = several.groupBy("id", *parts).agg(F.first(_ROW).alias(_ROW))
    several = several.select("id", _ROW, F.xxhash64(*parts).alias("digest"))
    least = several.groupBy(F.col("id").alias("shared")).agg(F.min("digest").alias("least"))
    several = several.join(least, several["id"] == least["shared"])
    # Further rows under an id get a key beyond the ids.
    other = F.shiftrightunsigned("digest", 2) + F.lit(1 << 62)
    key = F.when(F.col("digest") == F.col("least"), F.col("id")).otherwise(other)
    keyed = alone.select(F.col("id").alias("key"), _ROW)
    keyed = landed(keyed.unionByName(several.select(key.alias("key"), _ROW)), "keyed")
    texts = keyed.select(F.col("key").alias("doc_id"), F.col(_ROW).getField("text").alias("text"))
    found = near_duplicates(texts, percent=80, bands=32, rows=5)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("key"))
    left = keyed.join(gone, "key", "left_anti").select(f"{_ROW}.*")
    return left.unionByName(docs.filter("doc_id IS NULL"))


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that stand earlier; ``n_chars`` follows.

    A document all of whose text stands earlier goes; one that was empty stays, and so
    do rows without a doc_id, as they are.
    """
    trimmed = without_repeats(
        docs.select("doc_id", "text", whole_row(docs.drop("text"), _ROW)), as_text=True, carry=(_ROW,)
    )
    cut = F.size("spans") > 0
    row = F.col("others").getField(_ROW)
    columns = {c: row.getField(c) for c in docs.columns if c != "text"}
    columns["text"] = F.col("kept")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut, F.length("kept")).otherwise(columns["n_chars"])
    left = trimmed.filter(~cut | (F.length("kept") > 0))
    left = left.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in docs.schema.fields])
    return left.unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate),
    ("suffix_array", repeated_text),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Similarity of sketches, learned models and suffix sorting have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
