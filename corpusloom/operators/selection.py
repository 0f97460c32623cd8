"""Exact "first n rows in key order" and global ranks without a global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4  # hex digits per level: at most 65,536 groups
SMALL = 100_000  # keys one task may sort


def cutoff(df: DataFrame, key: Column, n: int) -> str | None:
    """The ``n``-th smallest hex ``key`` (fixed width, text order).

    Radix selection: count keys per leading-digits group (one aggregation with
    at most 65,536 groups, so the running total over groups is small), descend
    into the group that holds the n-th key, and stop once that group fits one
    task.  Exact for any key distribution; moves counts, never rows.
    """
    if n <= 0:
        return None
    keys = df.select(key.alias("k"))
    prefix, left = "", n
    while True:
        group = F.substring("k", len(prefix) + 1, DIGITS)
        inside = keys.filter(F.startswith("k", F.lit(prefix))) if prefix else keys
        totals = inside.groupBy(group.alias("g")).agg(F.count("*").alias("c"))
        running = totals.withColumn("upto", F.sum("c").over(Window.orderBy("g")))
        hit = running.filter(F.col("upto") >= left).orderBy("g").limit(1).collect()
        if not hit:  # fewer than n keys
            top = keys.agg(F.max("k")).collect()[0][0]
            return top
        left -= hit[0]["upto"] - hit[0]["c"]
        prefix += hit[0]["g"]
        if hit[0]["c"] <= SMALL or len(hit[0]["g"]) < DIGITS:
            break
    group = keys.filter(F.startswith("k", F.lit(prefix)))
    return group.orderBy("k").limit(left).agg(F.max("k")).collect()[0][0]


def smallest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``key`` (unique, hex, fixed width)."""
    limit = cutoff(df, key, n)
    return df.filter(key <= F.lit(limit)) if limit is not None else df.filter(F.lit(False))


def split_by_key(df: DataFrame, key: Column, ratio: float) -> DataFrame:
    """Add ``split``: the ``ceil(ratio * rows)`` smallest keys are ``test``."""
    rows = df.count()
    limit = cutoff(df, key, math.ceil(rows * ratio))
    test = (key <= F.lit(limit)) if limit is not None else F.lit(False)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def with_rank(df: DataFrame, key: str, within: list[str], target: str = "rank") -> DataFrame:
    """Add the 0-based rank of every row by ``key`` (an evenly spread hash in
    hex) inside the few groups ``within``.

    Rows are numbered inside small key ranges in parallel; the size of all
    earlier ranges (at most 65,536 per group) is added as an offset.
    """
    ranged = df.withColumn("__g", F.substring(key, 1, DIGITS))
    sizes = ranged.groupBy(*within, "__g").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*within).orderBy("__g").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *within, "__g", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before")
    )
    inner = F.row_number().over(Window.partitionBy(*within, "__g").orderBy(key))
    return (
        ranged.withColumn("__n", inner)
        .join(F.broadcast(offsets), [*within, "__g"])
        .withColumn(target, F.col("__before") + F.col("__n") - 1)
        .drop("__g", "__n", "__before")
    )
