"""Token counts that are kept: added to per delivery, bound to the vocabulary that made them.

Counts of a delivery come from its distinct words, each encoded once, and add up with
those of other deliveries, so an audit of weights and budgets reads a few stored rows and
encodes nothing again.  Counts under one vocabulary say nothing about another, whose
digest finds none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators.audit import token_audit, weighted_tokens
from corpusloom.operators.bpe import Vocabulary, token_counts

SCHEMA = "source string, docs long, tokens long, vocabulary string, delivery string"


class OtherVocabulary(RuntimeError):
    """The stored counts were made with another vocabulary."""


def vocabulary_digest(vocab: Vocabulary) -> str:
    """Equal for vocabularies with the same tokens, merges and special token."""
    state = hashlib.sha256(settings.SPECIAL_TOKEN.encode())
    for merge in vocab.merges:
        state.update(",".join(map(str, merge)).encode() + b"\n")
    return state.hexdigest()


def add_delivery(docs: DataFrame, vocab: Vocabulary, store: str, delivery: str) -> None:
    """Count the tokens of a delivery's ``docs`` per source; a delivery that is counted again replaces itself."""
    sources = docs.groupBy("source").agg(F.count("*").alias("docs"))
    counts = sources.join(token_counts(docs, vocab), "source", "left").select("source", "docs", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    counts.write.mode("overwrite").parquet(f"{store}/vocabulary={vocabulary_digest(vocab)}/delivery={delivery}")


def stored_counts(spark: SparkSession, store: str, vocab: Vocabulary) -> DataFrame:
    """``source, docs, tokens`` over all deliveries counted with ``vocab``."""
    wanted = vocabulary_digest(vocab)
    rows = spark.read.schema(SCHEMA).parquet(store)
    known = [r["vocabulary"] for r in rows.select("vocabulary").distinct().limit(20).collect()]
    if known and wanted not in known and rows.filter(F.col("vocabulary") == wanted).isEmpty():
        raise OtherVocabulary(f"{store} holds counts of {', '.join(sorted(v[:12] for v in known))}, not of {wanted[:12]}")
    return rows.filter(F.col("vocabulary") == wanted).groupBy("source").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def stored_audit(spark: SparkSession, store: str, vocab: Vocabulary, weights: dict[str, int],
                 budget: int = settings.TOKEN_BUDGET) -> tuple[DataFrame, DataFrame]:
    """Weighted tokens per source, and the audit against the budget."""
    weighted = weighted_tokens(stored_counts(spark, store, vocab).select("source", "tokens"), weights)
    return weighted, token_audit(weighted, budget)
