"""Verse pages to the ordered, distinct table of valid stanzas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.entities import with_unescaped
from corpusloom.functions.text import strip, with_nfc
from corpusloom.functions.verse import clean_source_note, has_line_words, stanza_lines, with_plain_verse
from corpusloom.operators.firsts import first_order
from corpusloom.operators.rows import explode_items, keep
from corpusloom.sources.readers import read_csv
from corpusloom.sources.writers import write_jsonl


def clean_pages(pages: DataFrame) -> DataFrame:
    """Plain content, source note and title; rows without content are dropped."""
    rows = keep(with_plain_verse(pages, "content"), F.col("content") != "")
    rows = with_unescaped(rows.withColumn("title", F.coalesce("title", F.lit(""))), "title")
    return rows.withColumn("source", clean_source_note(F.col("source"))).withColumn(
        "title", strip(F.col("title"))
    )


def valid_stanzas(pages: DataFrame, lines: int = settings.VERSE_LINES,
                  words: int = settings.VERSE_WORDS_PER_LINE, content: str = "content") -> DataFrame:
    """``(ord, stanza_ord, text)``: stanzas of exactly ``lines`` x ``words``.

    Line count is checked before normalization, so only plausible stanzas
    reach Python.
    """
    stanzas = explode_items(pages, ["ord"], stanza_lines(F.col(content)), "__lines", "stanza_ord")
    shaped = stanzas.filter(F.size("__lines") == lines).select(
        "ord", "stanza_ord", F.array_join("__lines", "\n").alias("text")
    )
    return keep(with_nfc(shaped, "text"), has_line_words(F.col("text"), words))


def distinct_stanzas(stanzas: DataFrame) -> DataFrame:
    """First occurrence of every stanza; ``(ord, stanza_ord)`` keeps the order."""
    place = F.struct("ord", "stanza_ord")
    firsts = first_order(stanzas.select("text", place.alias("place")), ["text"], "place")
    return firsts.select("place.ord", "place.stanza_ord", "text")


def verse_corpus(pages: DataFrame, lines: int = settings.VERSE_LINES,
                 words: int = settings.VERSE_WORDS_PER_LINE) -> DataFrame:
    return distinct_stanzas(valid_stanzas(clean_pages(pages), lines, words))


def build_verse_corpus(spark: SparkSession, csv_path: str, jsonl_path: str) -> DataFrame:
    """Poem pages in CSV to JSON lines of distinct stanzas; returns their count.

    A CSV scan has no row numbers, so URL and place in the page give the order;
    which copy of a stanza is first has no influence on its text.
    """
    columns = {"title": "", "content": None, "source": None, "url": "", "author": settings.UNKNOWN_AUTHOR}
    pages = read_csv(spark, csv_path, columns).withColumn("ord", F.coalesce("url", F.lit("")))
    write_jsonl(verse_corpus(pages).orderBy("ord", "stanza_ord").select("text"), jsonl_path)
    return spark.read.schema("text string").json(jsonl_path).agg(F.count("*").alias("stanzas"))
