"""Exact document and paragraph deduplication with first-wins semantics.

The sequential rule keeps three growing sets (raw texts, paragraphs of a
source, cleaned texts).  Nothing a later stage decides feeds back into an
earlier set, so each set is the first-occurrence relation over the previous
stage, and three distributed stages give the identical result:

1. raw text     digest of the NFC text, over all sources
2. paragraphs   digest of long paragraphs of raw survivors, within a source
3. final text   digest of the cleaned text, over all sources

Stages 1 and 2 move digests and positions only.  The text itself is shuffled
once, by its unique ``ord``, where it meets its decisions; no step gathers
the copies of a hot text or paragraph in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.text import digest, let, python_round, split_paragraphs, strip, with_nfc
from corpusloom.operators.firsts import first_order, first_rows
from corpusloom.operators.order import source_of
from corpusloom.operators.rows import keep

KEPT, EMPTY, SHORT, RAW_DUPLICATE, FINAL_DUPLICATE = (
    "kept", "empty", "short", "raw_duplicate", "final_duplicate",
)


def _uses_paragraphs(ord_: Column, paragraph_sources: list[int] | None) -> Column:
    if paragraph_sources is None:
        return F.lit(True)
    return source_of(ord_).isin(paragraph_sources) if paragraph_sources else F.lit(False)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``(ord, first_ord)`` of every non-empty document: stage 1 on its own."""
    hashed = (
        with_nfc(docs.select("ord", "text").filter(F.col("text") != ""), "text", "nfc")
        .select("ord", digest(F.col("nfc")).alias("raw_hash"))
    )
    return first_order(hashed, ["raw_hash"])


def _fingerprints(docs: DataFrame, separator: str, min_paragraph: int,
                  paragraph_sources: list[int] | None) -> DataFrame:
    """One light row per document: raw digest, digests of its long paragraphs
    (null in the place of a short one)."""
    docs = with_nfc(docs, "text", "nfc")
    def long_only(written: Column, nfc: Column) -> Column:
        return F.when(F.length(written) >= min_paragraph, digest(nfc))

    # Length is measured on the text as written, identity on its NFC form.
    # Empty and white-space pieces coincide in both, so their places line up.
    nfc_pieces = split_paragraphs(F.col("nfc"), separator)
    long_digests = F.when(
        F.col("nfc") == F.col("text"), F.transform(nfc_pieces, lambda p: long_only(p, p))
    ).otherwise(F.zip_with(split_paragraphs(F.col("text"), separator), nfc_pieces, long_only))
    return docs.select(
        "ord",
        digest(F.col("nfc")).alias("raw_hash"),
        F.when(_uses_paragraphs(F.col("ord"), paragraph_sources), long_digests).alias("paragraphs"),
    )


def paragraph_removals(survivors: DataFrame) -> DataFrame:
    """``(ord, removed)``: places of paragraphs seen earlier in the source.

    A paragraph's first occurrence *owns* it.  Owners are found by aggregation
    and returned to their documents by ``ord``; there is no join on the
    paragraph, so boilerplate repeated everywhere stays one aggregation key
    with map-side partials.
    """
    pieces = survivors.select(
        "ord", F.posexplode("paragraphs").alias("place", "paragraph")
    ).filter(F.col("paragraph").isNotNull())
    owners = pieces.groupBy(source_of(F.col("ord")).alias("source_ord"), "paragraph").agg(
        F.min(F.struct("ord", "place")).alias("owner")
    )
    owned = owners.groupBy(F.col("owner.ord").alias("ord")).agg(
        F.collect_list("owner.place").alias("owned")
    )
    places = F.filter(
        F.transform("paragraphs", lambda p, i: F.when(p.isNotNull(), i)), lambda i: i.isNotNull()
    )
    return (
        survivors.select("ord", F.coalesce(places, F.array().cast("array<int>")).alias("places"))
        .join(owned, "ord", "left")
        .select(
            "ord",
            F.array_except(
                "places", F.coalesce("owned", F.array().cast("array<int>"))
            ).alias("removed"),
        )
    )


def deduplicate(docs: DataFrame, *, separator: str = "\n\n",
                min_paragraph: int = settings.MIN_PARAGRAPH_CHARS,
                min_document: int = settings.MIN_DOCUMENT_CHARS,
                paragraph_sources: list[int] | None = None) -> DataFrame:
    """Decide every document of ``docs(ord, text)``.

    Returns ``(ord, text, changed, status)``; ``text`` is the cleaned text for
    documents past stage 1 and ``changed`` tells whether the paragraph stage
    altered it.  ``paragraph_sources`` lists the source positions that opt in
    to the paragraph stage (``None`` = all).
    """
    texts = docs.select("ord", F.coalesce("text", F.lit("")).alias("text"))
    written = texts.filter(F.col("text") != "")

    prints = _fingerprints(written, separator, min_paragraph, paragraph_sources)
    removals = paragraph_removals(first_rows(prints, ["raw_hash"], ["ord"]))

    def without_removed(paragraphs: Column) -> Column:
        # Set difference by hashing: a lookup per paragraph would be quadratic.
        places = F.when(F.size(paragraphs) > 0, F.sequence(F.lit(0), F.size(paragraphs) - 1)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(F.array_except(places, "removed"), lambda i: F.get(paragraphs, i))

    by_paragraph = F.array_join(let(split_paragraphs(F.col("text"), separator), without_removed), separator)
    cleaned = F.when(_uses_paragraphs(F.col("ord"), paragraph_sources), strip(by_paragraph)).otherwise(
        strip(F.col("text"))
    )
    joined = (
        written.join(removals, "ord", "left")
        .withColumn("clean", F.when(F.col("removed").isNotNull(), cleaned))
    )
    candidates = keep(joined.select("ord", "clean"), F.length("clean") >= min_document)
    winners = first_order(
        with_nfc(candidates, "clean", "nfc").select("ord", digest(F.col("nfc")).alias("final_hash")),
        ["final_hash"],
    ).select("ord", F.lit(True).alias("wins"))

    status = (
        F.when(F.col("clean").isNull(), RAW_DUPLICATE)
        .when(F.length("clean") < min_document, SHORT)
        .when(F.col("wins"), KEPT)
        .otherwise(FINAL_DUPLICATE)
    )
    decided = joined.join(winners, "ord", "left").select(
        "ord",
        F.coalesce("clean", "text").alias("text"),
        F.coalesce(F.col("clean") != strip(F.col("text")), F.lit(False)).alias("changed"),
        status.alias("status"),
    )
    empty = texts.filter(F.col("text") == "").select(
        "ord", "text", F.lit(False).alias("changed"), F.lit(EMPTY).alias("status")
    )
    return decided.unionByName(empty)


def kept_texts(decided: DataFrame) -> DataFrame:
    return decided.filter(F.col("status") == KEPT).select("ord", "text")


def _rate(removed: Column, original: Column) -> Column:
    return F.coalesce(python_round(removed / F.nullif(original, F.lit(0)), 4), F.lit(0.0))


def _counters() -> dict[str, Column]:
    """What each counter counts."""
    status = F.col("status")
    return {
        "original_docs": status.isNotNull(),
        "removed_by_doc_dedup": status.isin(RAW_DUPLICATE, FINAL_DUPLICATE),
        "removed_by_paragraph_dedup": F.col("changed"),
        "removed_as_too_short": status.isin(EMPTY, SHORT),
        "deduped_docs": status == KEPT,
    }


def _with_rates(counted: DataFrame) -> DataFrame:
    removed = F.col("original_docs") - F.col("deduped_docs")
    return counted.select(
        "source_ord", *_counters(), removed.alias("removed_docs"), _rate(removed, F.col("original_docs")).alias("duplicate_rate"))


def dedup_report(decided: DataFrame) -> DataFrame:
    """Counters per source position."""
    return _with_rates(decided.groupBy(source_of(F.col("ord")).alias("source_ord")).agg(
        *[F.count_if(condition).alias(name) for name, condition in _counters().items()]))


def observed_report(decided: DataFrame, positions: list[int]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``decided``, and its report over the sources at ``positions`` as gathered by the job that writes it.

    The counters ride along with the tasks of that write, so the decisions are not read once more;
    of a task that runs again only the run that counts is counted.  The sources are a list of the
    configuration, and so are the counters.  Asking for the report waits for the job."""
    observation, conditions = Observation(), _counters()
    source = source_of(F.col("ord"))

    def report() -> DataFrame:
        seen = observation.get if positions else {}
        rows = [(p, *(seen[f"{name}@{p}"] for name in conditions)) for p in positions]
        schema = "source_ord int, " + ", ".join(f"{name} long" for name in conditions)
        return _with_rates(decided.sparkSession.createDataFrame(rows, schema))

    counts = [F.count_if((source == p) & condition).alias(f"{name}@{p}") for p in positions for name, condition in conditions.items()]
    return (decided.observe(observation, *counts) if counts else decided), report


def dedup_totals(report: DataFrame) -> DataFrame:
    """Grand totals over the sources of a report."""
    totals = report.agg(
        F.coalesce(F.sum("original_docs"), F.lit(0)).alias("total_original_docs"),
        F.coalesce(F.sum("deduped_docs"), F.lit(0)).alias("total_deduped_docs"),
    )
    removed = F.col("total_original_docs") - F.col("total_deduped_docs")
    return totals.select(
        "*", removed.alias("total_removed_docs"),
        _rate(removed, F.col("total_original_docs")).alias("duplicate_rate"),
    )
