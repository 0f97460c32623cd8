"""Token audit against a budget, and training-log enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.text import perplexity, python_round
from corpusloom.operators.joins import with_weights


def weighted_tokens(counts: DataFrame, weights: dict[str, int]) -> DataFrame:
    """``(source, tokens, weight, weighted_tokens)``; a source without a weight counts once."""
    return with_weights(counts, weights).select(
        "source", "tokens", "weight", (F.col("tokens") * F.col("weight")).alias("weighted_tokens")
    )


def token_audit(weighted: DataFrame, budget: int = settings.TOKEN_BUDGET) -> DataFrame:
    """One row: unique and weighted tokens, repeat factor, gap to the budget."""
    totals = weighted.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("unique_tokens"),
        F.coalesce(F.sum("weighted_tokens"), F.lit(0)).alias("effective_tokens_with_weights"),
    )
    effective = F.col("effective_tokens_with_weights")
    limit = F.lit(budget).cast("bigint")
    return totals.select(
        "*",
        limit.alias("token_budget"),
        python_round(F.lit(float(budget)) / F.nullif(F.col("unique_tokens"), F.lit(0)), 2).alias("repeat_factor"),
        (effective >= limit).alias("enough_for_budget"),
        (effective - limit).alias("budget_gap_or_surplus"),
    )


def with_perplexity(log: DataFrame) -> DataFrame:
    """Add perplexities for the losses a log row has."""
    return log.withColumn("train_perplexity", perplexity(F.col("loss"))).withColumn(
        "eval_perplexity", perplexity(F.col("eval_loss"))
    )


def best_evaluation(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Step with the smallest evaluation loss (the earliest on a tie)."""
    best = F.min(F.struct("eval_loss", "step"))
    return log.filter(F.col("eval_loss").isNotNull()).groupBy(*(by or [])).agg(best.alias("best")).select(
        *(by or []), F.col("best.step").alias("best_step"), F.col("best.eval_loss").alias("best_eval_loss")
    )
