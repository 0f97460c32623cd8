"""Weighted mixture, reproducible shuffle, split, and their leakage report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators.joins import with_weights
from corpusloom.operators.order import shuffle_key
from corpusloom.operators.selection import split_by_key


def weighted_mixture(docs: DataFrame, weights: dict[str, int], seed: int = settings.SEED) -> DataFrame:
    """Every row of ``docs(source, ord, ...)`` ``weight`` times, at least once.

    Adds ``replica`` (1..weight) and ``order_key``; sorting by ``order_key`` is
    the shuffle.  Narrow: replicas are made where the row is.
    """
    replicas = F.explode(F.sequence(F.lit(1), F.greatest(F.col("weight"), F.lit(1))))
    return (
        with_weights(docs, weights).withColumn("replica", replicas).drop("weight")
        .withColumn("order_key", shuffle_key(seed, F.col("ord"), F.col("replica")))
    )


def split_mixture(mixture: DataFrame, ratio: float = settings.EVAL_RATIO, mode: str = "faithful",
                  seed: int = settings.SEED) -> DataFrame:
    """Add ``split``.

    ``faithful`` splits the weighted rows, so copies of one document can fall
    on both sides; ``by_document`` splits documents and keeps copies together.
    """
    if mode == "faithful":
        return split_by_key(mixture, F.col("order_key"), ratio)
    # One row per document decides; the copies follow its key.
    key = shuffle_key(seed, F.col("ord"))
    firsts = mixture.filter("replica = 1").select("ord")
    sides = split_by_key(firsts, key, ratio)
    limit = sides.filter("split = 'test'").agg(F.max(key).alias("k")).collect()[0]["k"]
    test = key <= F.lit(limit) if limit is not None else F.lit(False)
    return mixture.withColumn("split", F.when(test, "test").otherwise("train"))


def split_leakage(split: DataFrame) -> DataFrame:
    """Documents, and documents with copies on both sides of the split."""
    sides = split.groupBy("source", "ord").agg(
        F.count_if(F.col("split") == "test").alias("test"),
        F.count_if(F.col("split") == "train").alias("train"),
    )
    both = (F.col("test") > 0) & (F.col("train") > 0)
    return sides.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("test") > 0).alias("in_test"),
        F.count_if(both).alias("in_both"),
    )
