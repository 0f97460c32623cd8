"""Row filters and explodes that evaluate costly columns once.

The optimizer moves a filter below the projection it reads and repeats the
projected expression there; for an explode it infers such a filter.  With a
chain of regular expressions or a Python step in the projection that doubles
the work.  A generator with outer semantics is not subject to either rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)`` over columns that are costly to compute."""
    flag = F.explode_outer(F.when(condition, F.array(F.lit(True)))).alias("__keep")
    return df.select("*", flag).filter("__keep is not null").drop("__keep")


def explode_items(df: DataFrame, columns: list[str | Column], items: Column, item: str,
                  place: str | None = None) -> DataFrame:
    """``columns`` plus one row per element of ``items``; none for an empty array."""
    at = place or "__place"
    rows = df.select(*columns, F.posexplode_outer(items).alias(at, item)).filter(F.col(at).isNotNull())
    return rows if place else rows.drop(at)
