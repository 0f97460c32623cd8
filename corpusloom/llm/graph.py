"""Connected components by large-star and small-star rounds.

Each round sends an edge only to the smallest node next to it, so a node with very
many neighbours costs one aggregation with map-side partials and one join; paths
shorten by half or more a round.  Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import stored

MAX_ROUNDS = 60  # more than twice the logarithm of any number of nodes


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a, b``; label: the smallest node it is connected with."""
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        # Large star: larger neighbours of u go to the smallest node around u.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: u and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    labels = now.groupBy("u").agg(F.min("v").alias("label"))
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.select(F.col("u").alias("node"), "label").unionByName(roots)
