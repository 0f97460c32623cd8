"""First occurrence of a key in corpus order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole rows that come first within their key.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a
    key that holds a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def first_order(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """``keys`` with their smallest ``order``; hash aggregation with map-side
    partials, nothing but keys and order is shuffled."""
    return df.groupBy(*keys).agg(F.min(order).alias(order))
