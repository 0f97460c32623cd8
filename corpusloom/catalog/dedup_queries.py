"""Deduplication: documents, paragraphs, the staged decisions, the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog.registry import (
    SQL_DOCS, SQL_WS, doc_id, documents, query, source_name, table,
)
from corpusloom.operators import dedup
from corpusloom.operators.order import source_of
from corpusloom.session import shared_folder
from corpusloom.sources import writers

SEPARATOR = "\n"  # the tables have no blank line, so lines are the paragraphs

# The sequential rule as three nested first-occurrence steps.
_CHAIN = f"""WITH {SQL_DOCS},
hashed AS (SELECT *, row_number() OVER (PARTITION BY sha256(nfc_normalize(text)) ORDER BY so, doc_id) AS raw_rn
           FROM docs WHERE text <> ''),
firsts AS (SELECT * FROM hashed WHERE raw_rn = 1),
split AS (SELECT source, so, doc_id, string_split(text, chr(10)) AS parts FROM firsts),
pieces AS (SELECT source, so, doc_id, trim(unnest(parts), {SQL_WS}) AS para,
                  generate_subscripts(parts, 1) AS pos FROM split),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, nfc_normalize(para) ORDER BY doc_id, pos) AS rn
           FROM pieces WHERE para <> ''),
cleaned AS (SELECT doc_id, string_agg(para, chr(10) ORDER BY pos) AS clean
            FROM ranked WHERE length(para) < 50 OR rn = 1 GROUP BY doc_id),
staged AS (SELECT f.source, f.so, f.doc_id, f.text, trim(coalesce(c.clean, ''), {SQL_WS}) AS clean
           FROM firsts f LEFT JOIN cleaned c USING (doc_id)),
finals AS (SELECT *, CASE WHEN length(clean) >= 20 THEN row_number() OVER (
             PARTITION BY length(clean) >= 20, sha256(nfc_normalize(clean)) ORDER BY so, doc_id) END AS final_rn
           FROM staged),
decided AS (
  SELECT d.source, d.so, d.doc_id, coalesce(f.clean, d.text) AS text,
         coalesce(f.clean <> trim(d.text, {SQL_WS}), false) AS changed,
         CASE WHEN d.text = '' THEN 'empty' WHEN f.doc_id IS NULL THEN 'raw_duplicate'
              WHEN f.final_rn IS NULL THEN 'short' WHEN f.final_rn = 1 THEN 'kept'
              ELSE 'final_duplicate' END AS status
  FROM docs d LEFT JOIN finals f USING (doc_id)),
report AS (
  SELECT source, count(*) AS original_docs,
         count(*) FILTER (status IN ('raw_duplicate', 'final_duplicate')) AS removed_by_doc_dedup,
         count(*) FILTER (changed) AS removed_by_paragraph_dedup,
         count(*) FILTER (status IN ('empty', 'short')) AS removed_as_too_short,
         count(*) FILTER (status = 'kept') AS deduped_docs,
         count(*) FILTER (status <> 'kept') AS removed_docs,
         round(count(*) FILTER (status <> 'kept') / count(*), 4) AS duplicate_rate
  FROM decided GROUP BY source)
"""


def decided(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.deduplicate(documents(spark, folder).select("ord", "text"), separator=SEPARATOR)


def named_report(rows: DataFrame) -> DataFrame:
    return dedup.dedup_report(rows).withColumn("source", source_name(F.col("source_ord"))).drop("source_ord")


@query("doc_dedup_exact", f"""WITH {SQL_DOCS}
SELECT doc_id, source FROM docs WHERE text <> ''
QUALIFY row_number() OVER (PARTITION BY sha256(nfc_normalize(text)) ORDER BY so, doc_id) = 1""")
def doc_dedup_exact(spark, folder):
    firsts = dedup.exact_duplicates(documents(spark, folder))
    return firsts.select(doc_id(), source_name(source_of(F.col("ord"))).alias("source"))


@query("para_dedup", _CHAIN + "SELECT doc_id, text, changed FROM decided WHERE status NOT IN ('raw_duplicate', 'empty')")
def para_dedup(spark, folder):
    rows = decided(spark, folder).filter(~F.col("status").isin(dedup.RAW_DUPLICATE, dedup.EMPTY))
    return rows.select(doc_id(), "text", "changed")


@query("dedup_decisions", _CHAIN + "SELECT doc_id, changed, status FROM decided")
def dedup_decisions(spark, folder):
    return decided(spark, folder).select(doc_id(), "changed", "status")


@query("dedup_corpus", _CHAIN + "SELECT doc_id, source, text FROM decided WHERE status = 'kept'")
def dedup_corpus(spark, folder):
    kept = dedup.kept_texts(decided(spark, folder))
    return kept.select(doc_id(), source_name(source_of(F.col("ord"))).alias("source"), "text")


@query("dedup_report", _CHAIN + "SELECT * FROM report")
def dedup_report(spark, folder):
    return named_report(decided(spark, folder))


@query("dedup_totals", _CHAIN + """SELECT CAST(sum(original_docs) AS BIGINT) AS total_original_docs,
  CAST(sum(deduped_docs) AS BIGINT) AS total_deduped_docs, CAST(sum(removed_docs) AS BIGINT) AS total_removed_docs,
  round(sum(removed_docs) / sum(original_docs), 4) AS duplicate_rate FROM report""")
def dedup_totals(spark, folder):
    return dedup.dedup_totals(dedup.dedup_report(decided(spark, folder)))


# Sources with an even number opt in to the paragraph stage; the others are
# only stripped.
@query("dedup_selected_sources", f"""WITH {SQL_DOCS},
firsts AS (SELECT * FROM docs WHERE text <> ''
           QUALIFY row_number() OVER (PARTITION BY sha256(nfc_normalize(text)) ORDER BY so, doc_id) = 1),
split AS (SELECT source, so, doc_id, string_split(text, chr(10)) AS parts FROM firsts WHERE so % 2 = 0),
pieces AS (SELECT source, doc_id, trim(unnest(parts), {SQL_WS}) AS para, generate_subscripts(parts, 1) AS pos FROM split),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, para ORDER BY doc_id, pos) AS rn FROM pieces WHERE para <> ''),
cleaned AS (SELECT doc_id, string_agg(para, chr(10) ORDER BY pos) AS clean
            FROM ranked WHERE length(para) < 50 OR rn = 1 GROUP BY doc_id),
staged AS (SELECT f.so, f.doc_id, CASE WHEN so % 2 = 0 THEN trim(coalesce(c.clean, ''), {SQL_WS})
                                       ELSE trim(f.text, {SQL_WS}) END AS clean
           FROM firsts f LEFT JOIN cleaned c USING (doc_id))
SELECT doc_id, clean AS text FROM staged WHERE length(clean) >= 20
QUALIFY row_number() OVER (PARTITION BY sha256(nfc_normalize(clean)) ORDER BY so, doc_id) = 1""")
def dedup_selected_sources(spark, folder):
    docs = documents(spark, folder).select("ord", "text")
    sources = docs.select(source_of(F.col("ord")).alias("n")).distinct().collect()
    chosen = [r["n"] for r in sources if r["n"] % 2 == 0]
    rows = dedup.deduplicate(docs, separator=SEPARATOR, paragraph_sources=chosen)
    return dedup.kept_texts(rows).select(doc_id(), "text")


# Every second document is written with combining accents, and every third a
# second time with composed ones: the copies meet only after normalization.
@query("nfc_dedup", f"""WITH {SQL_DOCS},
written AS (
  SELECT so, doc_id, 0 AS copy, CASE WHEN doc_id % 2 = 1 THEN replace(replace(text, 'é', 'e' || chr(769)), 'è', 'e' || chr(768))
         ELSE text END AS text FROM docs
  UNION ALL SELECT so, doc_id, 1 AS copy, text FROM docs WHERE doc_id % 3 = 0)
SELECT doc_id, copy, length(text) AS written_length, length(nfc_normalize(text)) AS nfc_length FROM written
QUALIFY row_number() OVER (PARTITION BY nfc_normalize(text) ORDER BY so, doc_id, copy) = 1""")
def nfc_dedup(spark, folder):
    from corpusloom.functions.text import digest, with_nfc
    from corpusloom.operators.firsts import first_rows

    docs = documents(spark, folder, "doc_id")
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("é")), F.lit("è"), F.lit("è"))
    written = docs.withColumn("copy", F.lit(0)).withColumn(
        "text", F.when(F.col("doc_id") % 2 == 1, apart).otherwise(F.col("text"))
    ).unionByName(docs.filter(F.col("doc_id") % 3 == 0).withColumn("copy", F.lit(1)))
    light = with_nfc(written, "text", "nfc").select(
        "ord", "doc_id", "copy", F.length("text").alias("written_length"),
        F.length("nfc").alias("nfc_length"), digest(F.col("nfc")).alias("hash"),
    )
    return first_rows(light, ["hash"], ["ord", "copy"]).drop("ord", "hash")


@query("report_json", _CHAIN + """SELECT source, original_docs, removed_by_doc_dedup, removed_by_paragraph_dedup,
  removed_as_too_short, deduped_docs, removed_docs, duplicate_rate,
  (SELECT CAST(sum(deduped_docs) AS BIGINT) FROM report) AS total_deduped_docs FROM report""")
def report_json(spark, folder):
    """The nested JSON report, written as text and parsed back."""
    import uuid

    report = named_report(decided(spark, folder))
    document = writers.report_document(report, dedup.dedup_totals(report))
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    writers.write_report(document, path)
    entry = ", ".join(f"{c} BIGINT" for c in report.columns if c.endswith("docs") or c.startswith("removed"))
    schema = f"sources MAP<STRING, STRUCT<{entry}, duplicate_rate DOUBLE>>, total_deduped_docs BIGINT"
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("r"))
    return parsed.select(F.explode("r.sources").alias("source", "s"), "r.total_deduped_docs").select(
        "source", "s.*", "total_deduped_docs"
    )
