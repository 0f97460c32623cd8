"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import (
    collocations,
    exact_dedup,
    fingerprints,
    jaccard_join,
    language_model,
    license_scan,
    line_dedup,
    mixing,
    packing,
    pii,
    sharding,
    target_resampling,
    toxicity,
)
from corpusloom.llm.tables import documents


def over_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(documents(spark, folder))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.op4(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    return target_resampling.op11(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {
    "op1_pii": over_documents(pii.op1),
    "op2_exact_dedup": over_documents(exact_dedup.op2),
    "op3_lm_scoring": over_documents(language_model.op3),
    "op4_toxicity": op4,
    "op5_license_scan": over_documents(license_scan.op5),
    "op6_mixing": over_documents(mixing.op6),
    "op7_packing": over_documents(packing.op7),
    "op8_fingerprints": over_documents(fingerprints.op8),
    "op9_sharding": over_documents(sharding.op9),
    "op10_jaccard_join": over_documents(jaccard_join.op10),
    "op11_target_resampling": op11,
    "op12_collocations": over_documents(collocations.op12),
    "op13_line_dedup": over_documents(line_dedup.op13),
}
ORACLES = {
    "op1_pii": pii.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op5_license_scan": license_scan.SQL,
    "op6_mixing": mixing.SQL,
    "op11_target_resampling": target_resampling.SQL,
    "op12_collocations": collocations.SQL,
    "op13_line_dedup": line_dedup.SQL,
}
