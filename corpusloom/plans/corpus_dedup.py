"""Deduplicate the corpora of a source list, audit tokens, write the report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators.audit import token_audit, weighted_tokens
from corpusloom.operators.bpe import Vocabulary, token_counts
from corpusloom.operators.dedup import dedup_totals, deduplicate, kept_texts, observed_report
from corpusloom.operators.order import source_of
from corpusloom.functions.text import format_size
from corpusloom.session import cut_lineage
from corpusloom.sources.readers import existing, read_corpora, table_stats
from corpusloom.sources.writers import report_document, write_by_source, write_report


def with_source_names(rows: DataFrame, names: dict[int, str]) -> DataFrame:
    """Add ``source`` from the position in ``source_ord``; the list of sources
    is configuration and becomes a literal map."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return rows.withColumn("source", F.element_at(table, F.col("source_ord")))


def build_dedup_corpus(spark: SparkSession, sources: Sequence[tuple[str, str]], out: str,
                       vocab: Vocabulary, weights: dict[str, int], paragraph_sources: set[str],
                       budget: int = settings.TOKEN_BUDGET) -> DataFrame:
    """Write ``<out>/corpus/source=<name>`` and ``<out>/report``; return the
    report document.

    Decisions and kept texts are written once; the counters are gathered while the
    decisions are written, sizes and tokens are then read from stored tables.
    """
    names = {position: name for position, name, _ in existing(spark, sources)}
    positions = [p for p, n in names.items() if n in paragraph_sources]
    docs = read_corpora(spark, sources)
    decided_path = f"{out}/decisions"
    decisions, report_of = observed_report(
        deduplicate(docs.select("ord", "text"), paragraph_sources=positions), list(names))
    decisions.write.mode("overwrite").parquet(decided_path)
    decided = spark.read.parquet(decided_path)

    kept = with_source_names(kept_texts(decided).withColumn("source_ord", source_of(F.col("ord"))), names)
    corpus_path = f"{out}/corpus"
    write_by_source(kept, corpus_path, names.values())
    corpus = spark.read.schema("text string, source string").parquet(corpus_path)

    stats = with_source_names(report_of(), names)
    blank = spark.createDataFrame([(n,) for n in names.values()], "source string")
    counted = blank.join(stats.drop("source_ord"), "source", "left").fillna(0)
    report = counted.withColumn("output_path", F.concat(F.lit(f"{corpus_path}/source="), "source"))
    sizes = None
    for name in names.values():
        one = table_stats(spark.read.schema("text string").parquet(f"{corpus_path}/source={name}"))
        one = one.select(F.lit(name).alias("source"), format_size(F.col("bytes")).alias("output_size"))
        sizes = one if sizes is None else sizes.unionByName(one)
    report = cut_lineage(report.join(sizes, "source"))

    tokens = blank.join(token_counts(corpus, vocab), "source", "left").fillna(0)
    weighted = cut_lineage(weighted_tokens(tokens, weights))
    document = report_document(report, dedup_totals(report), weighted, token_audit(weighted, budget))
    write_report(document, f"{out}/report")
    return document
