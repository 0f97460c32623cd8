"""Writers: Parquet per source, JSON lines, CSV append, nested JSON report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_by_source(rows: DataFrame, path: str, sources: Iterable[str]) -> None:
    """One Parquet folder ``source=<name>`` per source, overwriting; a source
    without rows still gets an (empty, typed) file.

    The rebalance hint lets adaptive execution split the rows of a large
    source over many files and merge the rows of small ones.
    """
    rows.select("source", "text").hint("rebalance", "source").write.mode("overwrite").partitionBy(
        "source"
    ).option("compression", "snappy").parquet(path)
    spark = rows.sparkSession
    written = {
        r[0] for r in spark.read.schema("text string, source string").parquet(path)
        .select("source").distinct().collect()
    }
    for name in sources:
        if name not in written:
            spark.createDataFrame([], schemas.TEXT).write.mode("overwrite").parquet(f"{path}/source={name}")


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; Spark keeps non-ASCII characters as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append to a folder of CSV part files; every part has its own header, so
    a header never turns up among the rows of a reader."""
    df.write.mode("append").option("header", True).option("escape", '"').csv(path)


def report_document(report: DataFrame, totals: DataFrame, audit_sources: DataFrame | None = None,
                    audit: DataFrame | None = None) -> DataFrame:
    """One ``value`` row: the nested JSON report.

    ``report`` and ``audit_sources`` have one row per source (the configured
    list), which bounds the collected map.
    """

    def by_source(rows: DataFrame, name: str) -> DataFrame:
        fields = [c for c in rows.columns if c not in ("source", "source_ord")]
        entry = F.struct("source", F.struct(*fields))
        return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))

    # Every part is a single row, so these joins pair one row with one row.
    document = by_source(report, "sources").crossJoin(totals)
    if audit is not None and audit_sources is not None:
        nested = by_source(audit_sources, "sources").crossJoin(audit)
        document = document.crossJoin(nested.select(F.struct("*").alias("token_audit")))
    return document.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_report(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)
