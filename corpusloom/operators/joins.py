"""Equi-joins by key; adaptive execution splits what a frequent key makes large."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def not_yet_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``todo`` whose key is absent from ``done``; null keys stay."""
    return todo.join(done.select(key), key, "left_anti")


def with_weights(counts: DataFrame, weights: dict[str, int], key: str = "source") -> DataFrame:
    """Add ``weight`` per source, 1 where the mixture names none.

    The weights are the job's configuration (one entry per source), so they
    become a literal map instead of a join.
    """
    if not weights:
        return counts.withColumn("weight", F.lit(1))
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return counts.withColumn("weight", F.coalesce(F.try_element_at(table, F.col(key)), F.lit(1)))
