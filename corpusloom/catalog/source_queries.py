"""Readers, writers and ingest on files that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.catalog.registry import documents, query, table
from corpusloom.functions.text import format_size
from corpusloom.session import shared_folder
from corpusloom.sources import readers, writers
from corpusloom.sources.csv_ranges import read_csv_ranges
from corpusloom.streaming.ingest import UnsafeResume, ingest, ingest_counts


def _fresh(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("ordered_scan", """SELECT 'documents' AS source, 0 AS source_ord, row_number() OVER (ORDER BY doc_id) - 1 AS row_ord, text FROM documents
UNION ALL SELECT 'benchmark', 2, row_number() OVER (ORDER BY item_id) - 1, text FROM benchmark
UNION ALL SELECT 'conversations', 3, row_number() OVER (ORDER BY conv_id, turn) - 1, text FROM conversations""")
def ordered_scan(spark, folder):
    """Ordered scan of a source list; the second source does not exist."""
    names = ["documents", "absent", "benchmark", "conversations"]
    rows = readers.read_corpora(spark, [(n, f"{folder}/{n}.parquet") for n in names])
    from corpusloom.operators.order import ROW_BITS, source_of

    return rows.select("source", source_of(F.col("ord")).alias("source_ord"),
                       F.col("ord").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row_ord"), "text")


@query("source_prefix", """SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT (SELECT count(*) * 3 // 5 FROM documents)""")
def source_prefix(spark, folder):
    """The first rows of a source in many files, of which only those that hold them are read."""
    path = _fresh(spark, "many-files")
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    docs.repartitionByRange(16, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return readers.first_rows(spark, path, docs.count() * 3 // 5).select("doc_id", "source")


@query("parquet_by_source", """SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source
UNION ALL SELECT 'none', 0, 0""")
def parquet_by_source(spark, folder):
    """Written per source, read back; a source without rows is empty, not absent."""
    docs = documents(spark, folder)
    path = _fresh(spark, "by-source")
    names = [r["source"] for r in docs.select("source").distinct().collect()]
    writers.write_by_source(docs, path, [*names, "none"])
    counted = spark.read.schema("text string, source string").parquet(path).groupBy("source").agg(
        F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars")
    )
    empty = spark.read.parquet(f"{path}/source=none").agg(
        F.lit("none").alias("source"), F.count("*").alias("docs"), F.lit(0).cast("bigint").alias("chars")
    )
    return counted.unionByName(empty)


@query("jsonl_tolerant", """SELECT doc_id AS id, source AS title, text, CASE WHEN doc_id % 3 = 0 THEN 'u' END AS url FROM documents
WHERE doc_id % 5 <> 0""")
def jsonl_tolerant(spark, folder):
    """JSON lines between blank and broken lines; every fifth record is cut off."""
    return readers.valid_rows(_jsonl(spark, folder))


@query("jsonl_counts", """SELECT count(*) AS total_read, count(*) FILTER (doc_id % 5 <> 0) AS kept,
  count(*) FILTER (doc_id % 5 = 0) AS malformed FROM documents""")
def jsonl_counts(spark, folder):
    return readers.read_counts(_jsonl(spark, folder))


def _jsonl(spark, folder):
    n = F.col("doc_id")
    record = F.to_json(F.struct(n.alias("id"), F.col("source").alias("title"), "text", F.when(n % 3 == 0, "u").alias("url")))
    line = F.when(n % 5 == 0, F.concat(F.lit('{"id": '), n.cast("string"), F.lit(', "text": "cut'))).otherwise(
        F.concat(F.lit("\n  \n"), record)
    )
    path = _fresh(spark, "jsonl")
    documents(spark, folder, "doc_id").select(line.alias("value")).write.text(path)
    return readers.read_jsonl(spark, path, schemas.ARTICLE)


@query("jsonl_sink", "SELECT doc_id AS id, text FROM documents")
def jsonl_sink(spark, folder):
    path = _fresh(spark, "jsonl-sink")
    writers.write_jsonl(documents(spark, folder, "doc_id").select(F.col("doc_id").alias("id"), "text"), path)
    return spark.read.schema("id bigint, text string").json(path)


_CSV = """SELECT 'q "' || source || '", x' AS title, text AS content, source, CAST(doc_id AS VARCHAR) AS url, 'Unknown' AS author FROM documents"""
_CSV_DEFAULTS = {"title": "", "content": None, "source": None, "url": None, "author": "Unknown"}


def _csv(spark, folder):
    """Multi-line cells with quotes, appended in two writes."""
    rows = documents(spark, folder, "doc_id").select(
        F.concat(F.lit('q "'), "source", F.lit('", x')).alias("title"), F.col("text").alias("content"), "source",
        F.col("doc_id").cast("string").alias("url"),
    )
    path = _fresh(spark, "csv")
    even = F.col("url").cast("bigint") % 2 == 0
    writers.append_csv(rows.filter(even), path)
    writers.append_csv(rows.filter(~even), path)
    return path


@query("csv_multiline", _CSV)
def csv_multiline(spark, folder):
    """A missing column takes its default."""
    return readers.read_csv(spark, _csv(spark, folder), _CSV_DEFAULTS)


@query("csv_ranges", _CSV)
def csv_ranges(spark, folder):
    """The same files cut into ranges, which do not wait for one another."""
    cells = read_csv_ranges(spark, _csv(spark, folder))
    return cells.select(*[c for c in _CSV_DEFAULTS if c in cells.columns], F.lit("Unknown").alias("author"))


@query("table_stats", "SELECT count(*) AS rows, true AS has_bytes FROM documents")
def table_stats(spark, folder):
    stats = readers.table_stats(table(spark, folder, "documents"))
    return stats.select("rows", (F.col("bytes") > 0).alias("has_bytes"))


@query("size_format", """SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024)
  WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576) WHEN b < 1099511627776 THEN printf('%.2f GB', b / 1073741824)
  ELSE printf('%.2f TB', b / 1099511627776) END AS size
FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) * power(4, doc_id % 20) AS b FROM documents)""")
def size_format(spark, folder):
    n = F.col("n_chars") * F.pow(F.lit(4), F.col("doc_id") % 20).cast("bigint")
    return documents(spark, folder, "doc_id", "n_chars").select("doc_id", format_size(n).alias("size"))


def _ingested(spark, folder):
    """The documents arrive as JSON lines in three overlapping deliveries; the
    stream runs after each and stores every key once, as delivered first.

    Every seventh record lacks its text in the first two deliveries; the third
    brings it, next to a cut line for every fifth and a record without an id for
    every eleventh document.
    """
    n = F.col("doc_id")

    def records(number):
        bare = (n % 7 == 0) & F.lit(number < 3)
        return documents(spark, folder, "doc_id").select(
            n.alias("id"), F.concat("source", F.lit(f" {number}")).alias("title"),
            F.when(~bare, F.col("text")).alias("text"), F.concat(F.lit("u"), n.cast("string")).alias("url"))

    source, sink, state = _fresh(spark, "in"), _fresh(spark, "sink"), _fresh(spark, "state")
    third = F.col("id") % 3
    for number, part in ((1, third != 0), (2, third != 1), (3, F.lit(True))):
        records(number).filter(part).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(source)
        if number == 3:
            docs = documents(spark, folder, "doc_id")
            cut = docs.filter(n % 5 == 0).select(F.concat(F.lit('{"id": '), n.cast("string"), F.lit(', "text": "cut')).alias("value"))
            nameless = docs.filter(n % 11 == 0).select(F.to_json(F.struct("text")).alias("value"))
            cut.unionByName(nameless).write.mode("append").text(source)
        ingest(spark, source, sink, state, schemas.ARTICLE, "id", "text").awaitTermination()
    return source, sink


@query("ingest_stream", """SELECT doc_id AS id, source || CASE WHEN doc_id % 7 = 0 THEN ' 3' WHEN doc_id % 3 = 0 THEN ' 2' ELSE ' 1' END AS title,
  text, 'u' || doc_id AS url FROM documents""")
def ingest_stream(spark, folder):
    return spark.read.parquet(_ingested(spark, folder)[1]).drop("batch")


@query("ingest_rejected", """SELECT 'stored' AS outcome, count(*) AS lines FROM documents
UNION ALL SELECT 'malformed', count(*) FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT 'no key', count(*) FROM documents WHERE doc_id % 11 = 0
UNION ALL SELECT 'no content', count(*) FILTER (doc_id % 3 <> 0) + count(*) FILTER (doc_id % 3 <> 1) FROM documents WHERE doc_id % 7 = 0""")
def ingest_rejected(spark, folder):
    return ingest_counts(spark, _ingested(spark, folder)[1])


@query("ingest_refused", "SELECT count(*) AS rows, true AS refused FROM documents")
def ingest_refused(spark, folder):
    """A sink whose checkpoint is lost is left alone."""
    source, sink = _ingested(spark, folder)
    try:
        ingest(spark, source, sink, _fresh(spark, "lost"), schemas.ARTICLE, "id", "text")
        refused = False
    except UnsafeResume:
        refused = True
    return spark.read.parquet(sink).agg(F.count("*").alias("rows"), F.lit(refused).alias("refused"))
