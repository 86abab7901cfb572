"""The registered query of every operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

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
from convoy.llm.oracles import ORACLES
from convoy.llm.tables import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_minhash": lambda spark, sf: minhash.near_duplicates(documents(spark, sf)),
    "op2_toxicity": lambda spark, sf: toxicity.toxicity_scores(
        documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    ),
    "op3_license_scan": lambda spark, sf: licenses.license_digest(
        licenses.license_scan(documents(spark, sf))
    ),
    "op5_suffix_array": lambda spark, sf: suffixes.removal_digest(
        suffixes.without_repeats(documents(spark, sf))
    ),
    "op6_token_counts": lambda spark, sf: token_counts.limit_table(
        token_counts.length_histogram(documents(spark, sf))
    ),
    "op8_packing": lambda spark, sf: packing.pack(documents(spark, sf)).drop("ids"),
    "op4_embedding_dedup": lambda spark, sf: vectors.near_vectors(
        spark.read.parquet(f"{sf}/embeddings.parquet")
    ),
    "op7_quality": lambda spark, sf: quality.quality_scores(
        documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    ),
    "op10_language": lambda spark, sf: language.identify(documents(spark, sf)),
    "op9_decontamination": lambda spark, sf: decontamination.contaminated(
        documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    ),
    "op11_clusters": lambda spark, sf: clusters.clustered(
        spark.read.parquet(f"{sf}/embeddings.parquet")
    ),
    "op12_codes": lambda spark, sf: codes.coded(spark.read.parquet(f"{sf}/embeddings.parquet")),
    "op13_best_fit": lambda spark, sf: bestfit.best_fit_packed(documents(spark, sf)).drop("ids"),
}

__all__ = ["ORACLES", "QUERIES"]
