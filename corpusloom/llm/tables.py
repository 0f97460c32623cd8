"""Shared pieces: reading, cutting a lineage, places inside large groups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import BATCH_BYTES, bounded_batches, shared_folder  # noqa: F401

CELL_ROWS = 20_000  # rows that one group of a window has on average


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/documents.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """``df`` as a table in the folder that the cluster shares, read back; one folder per value of ``folders``.

    Cuts the lineage: what follows neither repeats the work nor depends on the
    executors that did it.
    """
    path = f"{shared_folder(df.sparkSession)}/corpusloom-llm/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as the struct ``row`` and ``columns`` beside it, so that no other name can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, *columns)


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The ``columns`` of a ``packed`` frame."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def uniform(seed: int, *parts: Column | str) -> Column:
    """A pseudo-random LONG in [0, 2^60) from the values; null counts as a value."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("#", F.lit(str(seed)), *texts).cast("binary")), 1, 15), 16, 10).cast("long")


def with_places(df: DataFrame, group: list[Column | str], order: Column, rows: int, place: str) -> DataFrame:
    """Add ``place``: the row's number, from 0, in its group by ``order``, a
    ``uniform`` LONG.

    A group may hold any part of all rows, so it is dealt to cells, which are
    ranges of the hash (``rows``, the number of all rows, decides how many), and
    numbered per cell; the sizes of earlier cells, one row per cell, are added.
    """
    cells = max(1, -(-rows // CELL_ROWS))
    keys = [f"__g{i}" for i in range(len(group))]
    dealt = df.select(
        "*", *[(F.col(g) if isinstance(g, str) else g).alias(k) for g, k in zip(group, keys)],
        order.alias("__order"),
    ).withColumn("__cell", F.shiftright(F.shiftright("__order", 30) * cells, 30))
    within = Window.partitionBy(*keys, "__cell").orderBy("__order")
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "__cell").agg(F.count("*").alias("__n")).select(
        *keys, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = dealt.withColumn("__inner", F.row_number().over(within))
    return numbered.join(sizes, [*keys, "__cell"]).select(
        *df.columns, (F.col("__before") + F.col("__inner") - 1).alias(place))
