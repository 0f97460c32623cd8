"""Verse pages: HTML to lines, lines to stanzas, pages to poems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.elements import TOKEN, class_value, element_blocks, start_tag, visible
from corpusloom.functions.entities import with_unescaped
from corpusloom.functions.text import (
    BLANK_SET, WS, contains_any, squeeze_newlines, strip,
)

# Fixed patterns: quotes and separators trimmed from a verse line.
LEADING_MARKS = '"“”‘’'
TRAILING_MARKS = r'''"“”‘’:;,\-–—'''
# Punctuation that separates words, as white space does.
BETWEEN_WORDS = rf"""{BLANK_SET}.,!?;:"'“”‘’\-–—()"""
TITLE = rf"(?diu)<b>(.*?)</b>{WS}*\n{{2,}}"


def break_tags(html: Column) -> Column:
    return F.regexp_replace(html, rf"<(?iu:br{WS}*/?>)", "\n")


def with_plain_verse(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Add ``target`` = text of a verse page; italic notes go with their content."""
    target = target or source
    c = F.coalesce(F.col(source), F.lit(""))
    # Fixed patterns, in order.  All begin with a bracket, so a text without one goes through none of them.
    plain = c
    for pattern in (r"<(?iu:img[^>]*>)", r"<(?iu:/img>)", r"<(?ius:i>.*?</i>)", r"<(?iu:/?b>)",
                    r"<(?iu:/?div[^>]*>)", r"<(?iu:/?p>)"):
        plain = F.regexp_replace(plain, pattern, "")
    c = F.when(contains_any(c, "<"), break_tags(plain)).otherwise(c)
    df = with_unescaped(df.withColumn(target, c), target)
    blanks = F.regexp_replace(F.replace(F.col(target), F.lit("\xa0"), F.lit(" ")), " {2,}", " ")
    return df.withColumn(target, blanks).withColumn(target, strip(squeeze_newlines(F.col(target))))


def clean_source_note(c: Column) -> Column:
    """Source note without the comment counter that follows it."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?diu)Bình luận nhanh.*", ""))


def stanza_lines(content: Column) -> Column:
    """Array of stanzas, each an array of its non-empty lines, with single blanks and
    without surrounding marks (before NFC).

    Each step goes over the whole text at once, as a pattern per line costs more than the
    line.  When white space is single blanks, U+001E is free to stand between stanzas."""
    blank = f"[{BLANK_SET}]"
    content = F.concat(F.lit("\n"), strip(content))  # the first line begins like the others
    for pattern, replacement in (
        (rf"{blank}(?:(?<! ){blank}*+|{blank}++)", " "),  # all but single blanks
        (r"\n(?: *+\n)++", "\n\x1e\n"),
        (rf"\n[ {LEADING_MARKS}][{LEADING_MARKS}]*+ ?", "\n"),
        (rf"(?dm)[ {TRAILING_MARKS}][{TRAILING_MARKS}]*+ ?$", ""),
    ):
        content = F.regexp_replace(content, pattern, replacement)
    return F.transform(F.split(content, "\x1e", -1), lambda s: F.array_remove(F.split(s, "\n", -1), ""))


def has_line_words(text: Column, words: int) -> Column:
    """Whether every line of the text has exactly so many words."""
    between, word = f"[{BETWEEN_WORDS}]", rf"[^\n{BETWEEN_WORDS}]++"
    line = rf"{between}*+" + (rf"{word}(?:{between}++{word}){{{words - 1}}}{between}*+" if words else "")
    return text.rlike(rf"\A{line}(?:\n{line})*+\z")


def poems_of_page(html: Column, default_title: Column) -> Column:
    """Array of ``(title, content)``: one per bold title followed by a blank
    line, or the whole page under ``default_title`` when there is none.
    ``html`` must be the output of :func:`break_tags`."""
    titles = F.regexp_extract_all(html, F.lit(TITLE), F.lit(1))
    bodies = F.split(html, TITLE, -1)
    cut = F.zip_with(
        titles,
        F.slice(bodies, 2, F.size(bodies)),
        lambda t, b: F.struct(
            strip(t).alias("title"), F.trim(b, F.lit("\n")).alias("content")
        ),
    )
    whole = F.array(F.struct(default_title.alias("title"), html.alias("content")))
    return F.when(html.rlike(TITLE), cut).otherwise(whole)


def first_container(html: Column, tag: str, name: str | None = None) -> Column:
    """Outer HTML of the first matching element, null when there is none."""
    start = start_tag(tag, "class", class_value(name)) if name else start_tag(tag)
    present = F.contains(html, F.lit(name)) if name else html.rlike(rf"(?i)<{tag}\b")
    return F.when(present, F.get(element_blocks(html, start), F.lit(0)))


def with_element_text(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add ``target`` = text nodes of ``source``, each stripped, joined without
    a separator; NUL keeps the nodes apart while entities are decoded."""
    nodes = F.regexp_replace(visible(F.coalesce(F.col(source), F.lit(""))), TOKEN, "\u0000")
    df = with_unescaped(df.withColumn(target, nodes), target)
    return df.withColumn(
        target, F.array_join(F.transform(F.split(F.col(target), "\u0000"), strip), "")
    )


def is_marked(page: Column, markers: list[str]) -> Column:
    """True where the page contains any of the marker texts."""
    found = F.lit(False)
    for marker in markers:
        found = found | F.contains(page, F.lit(marker))
    return found


def total_pages(page: Column) -> Column:
    """Number of listing pages: stated total, else "n / total", else the
    largest linked page number, else 1."""
    stated = F.regexp_extract(page, r"(?U)tổng số (\d+) trang", 1)
    counter = F.regexp_extract(page, rf"(?U)Trang{WS}+\d+{WS}*/{WS}*(\d+)", 1)
    linked = F.regexp_extract_all(
        page, F.lit(r"""(?i)<a\b[^>]*?\shref\s*=\s*(?:"[^"]*?|'[^']*?|[^\s"'>]*?)Page=(\d+)"""), F.lit(1)
    )
    return F.coalesce(
        F.nullif(stated, F.lit("")).cast("bigint"),
        F.nullif(counter, F.lit("")).cast("bigint"),
        F.array_max(F.transform(linked, lambda n: n.cast("bigint"))),
        F.lit(1).cast("bigint"),
    )


def capped_pages(total: Column, cap: int = settings.MAX_LISTING_PAGES) -> Column:
    return F.least(total, F.lit(cap))
