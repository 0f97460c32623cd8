"""Whole jobs, from files that Spark derives from the tables to files."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.dedup_queries import _CHAIN
from corpusloom.catalog.registry import doc_id, documents, query
from corpusloom.catalog.source_queries import _fresh
from corpusloom.catalog.verse_queries import _STANZAS, _verse_pages
from corpusloom.catalog.wiki_queries import _BASE, _WHOLE, _base, _marked_article
from corpusloom.operators import dedup
from corpusloom.plans.verse_corpus import build_verse_corpus
from corpusloom.plans.wiki_corpus import build_wiki_corpus
from corpusloom.sources import writers


@query("wiki_job", _BASE + f"SELECT doc_id AS id, source AS title, {_WHOLE} AS text, 'u' AS url FROM base")
def wiki_job(spark, folder):
    """Article lines between broken ones, cleaned, written as lines and Parquet."""
    rows = _base(spark, folder).select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), _marked_article().alias("text"), F.lit("u").alias("url"))
    lines, jsonl, parquet = (_fresh(spark, n) for n in ("articles", "clean-lines", "clean-table"))
    whole = F.concat(F.to_json(F.struct("*")), F.when(F.col("id") % 4 == 0, '\n{"id": 1, "te').otherwise(""))
    rows.select(whole.alias("value")).write.text(lines)
    build_wiki_corpus(spark, lines, jsonl, parquet)
    return spark.read.parquet(parquet)


@query("wiki_job_counts", "SELECT 2 * count(*) AS total_read, 0::BIGINT AS kept, 2 * count(*) AS malformed, false AS has_table FROM documents")
def wiki_job_counts(spark, folder):
    """No valid line: the counters say so and no table is written."""
    lines, jsonl, parquet = (_fresh(spark, n) for n in ("articles", "clean-lines", "clean-table"))
    documents(spark, folder, "doc_id").select(
        F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit("\n\n[broken")).alias("value")).write.text(lines)
    counts = build_wiki_corpus(spark, lines, jsonl, parquet)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(parquet)
    written = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return counts.withColumn("has_table", F.lit(bool(written)))


@query("verse_job", _STANZAS + "SELECT DISTINCT text FROM stanzas")
def verse_job(spark, folder):
    """Verse pages as CSV to the lines of distinct stanzas."""
    pages = _verse_pages(spark, folder).select(
        F.lit("t").alias("title"), "content", F.lit("s").alias("source"), F.col("ord").cast("string").alias("url"))
    table, jsonl = _fresh(spark, "verse-pages"), _fresh(spark, "verse-lines")
    writers.append_csv(pages, table)
    build_verse_corpus(spark, table, jsonl)
    return spark.read.schema("text string").json(jsonl)


@query("dedup_blank_lines", _CHAIN.replace("chr(10)", "chr(10) || chr(10)").replace(
    "doc_id, text FROM documents", "doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents")
    + "SELECT doc_id, text, changed FROM decided WHERE status = 'kept'")
def dedup_blank_lines(spark, folder):
    """The default paragraph separator, on texts whose lines are blank-line paragraphs."""
    docs = documents(spark, folder).select("ord", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return dedup.deduplicate(docs).filter(F.col("status") == dedup.KEPT).select(doc_id(), "text", "changed")
