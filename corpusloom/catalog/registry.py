"""Registered queries and, where SQL can state the result, their SQL.

A query takes ``(spark, folder)`` and reads the whole tables in ``folder``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WS_CHARS
from corpusloom.operators.order import ROW_BITS, order_key
from corpusloom.sources.readers import fill_cores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, key: str, task_rows: int | None = None) -> DataFrame:
    """A table whose texts are worth one task per core, or per ``task_rows`` rows where that is more."""
    rows = table(spark, folder, name)
    tasks = 0 if task_rows is None else -(-rows.count() // task_rows)
    return rows.repartition(tasks) if tasks > spark.sparkContext.defaultParallelism else fill_cores(rows, key)


def documents(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """``(source, ord, text, ...)``; order = (source number, doc_id)."""
    number = F.substring("source", 4, 10).cast("int")
    rows = table(spark, folder, "documents").select(
        "source", order_key(number, F.col("doc_id")).alias("ord"), "text", *extra
    )
    return fill_cores(rows, "ord")


def doc_id(ord_: str = "ord") -> Column:
    """Row position inside the source, which is ``doc_id`` for documents."""
    return F.col(ord_).bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("doc_id")


def source_name(source_ord: Column) -> Column:
    return F.concat(F.lit("src"), source_ord.cast("string"))


# --- shared SQL ---
SQL_WS = "'" + WS_CHARS + "'"
SQL_DOCS = """docs AS (
  SELECT source, CAST(substring(source, 4) AS INTEGER) AS so, doc_id, text FROM documents)"""
