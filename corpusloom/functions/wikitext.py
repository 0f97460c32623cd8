"""Wikitext to plain text as an ordered list of column steps.

Each step is a pure expression; :func:`clean_wikitext` applies them one
projection after the other, so a text is evaluated once per step.  Entity
decoding is the single Python step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.nesting import drop_regions, map_regions
from corpusloom.functions.entities import with_unescaped
from corpusloom.functions.text import (
    OTHER_BREAK, WS, WS_SET, contains_any, let, lstrip, rstrip, split_lines, squeeze_newlines,
    strip, strip_lines,
)

# Marks of two characters; the first is looked for alone, an alternative at every character would cost more.
TABLE_MARKS = r"[{|](?:(?<=\{)\||(?<=\|)\})"
TEMPLATE_MARKS = r"[{}](?:(?<=\{)\{|(?<=\})\})"
LINK_MARKS = r"[\[\]](?:(?<=\[)\[|(?<=\])\])"


def _chain(c: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _guarded(c: Column, needed: list[str], rules: list[tuple[str, str]]) -> Column:
    """The rules, for texts that contain any of the ``needed`` parts."""
    return F.when(contains_any(c, *needed), _chain(c, rules)).otherwise(c)


def _guarded_each(c: Column, needed: str, rules: list[tuple[str, str]]) -> Column:
    """The rules, each for texts that still contain the part that it needs."""
    for pattern, replacement in rules:
        c = let(c, lambda t: F.when(F.contains(t, F.lit(needed)), F.regexp_replace(t, pattern, replacement)).otherwise(t))
    return c


def strip_tags(c: Column) -> Column:
    # Fixed patterns, in order; case is ignored behind the bracket only, which has none.
    c = _guarded(c, ["<!--"], [(r"(?s)<!--.*?-->", "")])
    return _guarded_each(c, "<", [
        (rf"<(?iu:ref[^>]*/{WS}*>)", ""),
        (r"<(?ius:ref[^>]*>.*?</ref>)", ""),
        (rf"<(?iu:(?:{'|'.join(settings.BLANKED_TAGS)})[^>]*>)", " "),
        (r"<(?iu:/[a-z]+>)", " "),
        (r"<[^>]+>", ""),
    ])


def drop_tables(c: Column) -> Column:
    return F.when(
        F.contains(c, F.lit("{|")), drop_regions(c, TABLE_MARKS, "{|", "|}", keep_stray_closer=True)
    ).otherwise(c)


def drop_templates(c: Column) -> Column:
    return F.when(
        F.contains(c, F.lit("{{")) | F.contains(c, F.lit("}}")),
        drop_regions(c, TEMPLATE_MARKS, "{{", "}}", keep_stray_closer=False),
    ).otherwise(c)


def drop_orphan_rows(c: Column) -> Column:
    # Fixed patterns: separator, caption or multi-cell row, then a cell row.
    return _guarded(c, ["|"], [
        (rf"(?dm)^{WS}*\|[-+|].*\n?", ""),
        (rf"(?dm)^{WS}*\| [^\n]*\n?", ""),
    ])


def _begins_with_any(c: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.startswith(c, F.lit(part))
    return found


def _link_label(inner: Column) -> Column:
    longest = max(map(len, settings.DROPPED_NAMESPACES))

    def names_dropped(head: Column) -> Column:
        """Every namespace ends with a colon, so a head without one is not lower-cased."""
        lower = F.lower(F.replace(head, F.lit("_"), F.lit(" ")))
        return F.contains(head, F.lit(":")) & let(lower, lambda low: _begins_with_any(low, settings.DROPPED_NAMESPACES))

    dropped = let(F.substring(inner, 1, longest), names_dropped)
    return F.when(dropped, "").otherwise(F.regexp_replace(inner, r"^[^|]*\|", ""))


def resolve_links(c: Column) -> Column:
    return F.when(
        F.contains(c, F.lit("[[")), map_regions(c, LINK_MARKS, "[[", "]]", _link_label)
    ).otherwise(c)


def resolve_brackets(c: Column, mode: str = "faithful") -> Column:
    """Single-bracket links; ``fixed`` lets the external rules run first."""
    interwiki = [
        (r"\[[a-z][a-z0-9_-]*:[^\]|]*\|([^\]]+)\]", "$1"),
        (r"\[[a-z]{2}:[^\]]+\]", ""),
        (r"\[[a-z][a-z0-9_-]*:([^\]]+)\]", "$1"),
    ]
    external = [
        (rf"\[https?://[^{WS_SET}\]]+{WS}+([^\]]+)\]", "$1"),
        (r"\[https?://[^\]]+\]", ""),
    ]
    return _guarded(c, ["["], external + interwiki if mode == "fixed" else interwiki + external)


def unwrap_headers(c: Column) -> Column:
    return _guarded(c, ["="], [
        (rf"(?dm)^=+{WS}*(.+?){WS}*=+{WS}*$", "$1"),
        (rf"(?dm)^=+{WS}*=+{WS}*$", ""),
    ])


def drop_emphasis(c: Column) -> Column:
    c = _guarded(c, ["''", "----"], [(r"['-](?:(?<=')''?|(?<=-)---+)", "")])
    return _guarded(c, ["__"], [(r"__[A-Z_]+__", "")])


def plain_blanks(c: Column) -> Column:
    return F.replace(c, F.lit("\xa0"), F.lit(" "))


def _list_line(line: Column) -> Column:
    marker = rf"^[*#;:]+{WS}?"

    def definition(body: Column) -> Column:
        at = F.position(F.lit(": "), body)
        meaning = strip(F.substring(body, at + 2, F.length(body)))
        return F.concat(
            strip(F.substring(body, F.lit(1), at - 1)),
            F.when(meaning != "", F.concat(F.lit(": "), meaning)).otherwise(""),
        )

    def item(bare: Column) -> Column:
        body = F.regexp_replace(bare, marker, "")
        has_term = F.regexp_extract(bare, r"^[*#:]*;", 0) != ""
        text = F.when(has_term & F.contains(body, F.lit(": ")), definition(body)).otherwise(body)
        return F.when(F.substring(bare, 1, 1).isin(*"*#;:"), F.regexp_replace(text, rf"^[{WS_SET}:]+", "")).otherwise(line)

    return let(lstrip(line), item)


def strip_list_marks(c: Column) -> Column:
    # Only a list line, another line break or a final break changes the text.
    concerned = F.endswith(c, F.lit("\n")) | c.rlike(rf"(?dm)^{WS}*+[*#;:]") | c.rlike(OTHER_BREAK)
    lines = F.array_join(F.transform(split_lines(c), _list_line), "\n")
    return F.when(concerned, lines).otherwise(c)


def cut_terminal_sections(c: Column) -> Column:
    titles = "|".join(t.replace(" ", f"{WS}+") for t in settings.TERMINAL_SECTIONS)
    pattern = rf"(?dium)^{WS}*=*{WS}*(?:{titles}){WS}*=*{WS}*$"
    return F.when(c.rlike(pattern), rstrip(F.regexp_replace(c, rf"{pattern}(?s:.*)", ""))).otherwise(c)


def tidy(c: Column) -> Column:
    blanks = F.when(contains_any(c, "  ", "\t"), F.regexp_replace(c, r"[ \t]+", " ")).otherwise(c)
    return let(blanks, lambda b: let(squeeze_newlines(b), strip_lines))


# (name, column step); ``None`` marks the entity step, which needs the frame.
STEPS: list[tuple[str, Callable[[Column], Column] | None]] = [
    ("tags", strip_tags),
    ("tables", drop_tables),
    ("templates", drop_templates),
    ("orphan_rows", drop_orphan_rows),
    ("links", resolve_links),
    ("brackets", resolve_brackets),
    ("headers", unwrap_headers),
    ("emphasis", drop_emphasis),
    ("entities", None),
    ("lists", strip_list_marks),
    ("terminal", cut_terminal_sections),
    ("tidy", tidy),
]


def clean_wikitext(df: DataFrame, source: str = "text", target: str = "text",
                   mode: str = "faithful", lengths: str | None = None) -> DataFrame:
    """Add ``target`` = plain text of the wikitext in ``source``.

    With ``lengths`` an extra array column holds the text length before the
    first and after every step, for the audit.
    """
    work, sizes = "__wiki", []
    df = df.withColumn(work, F.coalesce(F.col(source), F.lit("")))

    def note(frame: DataFrame, name: str) -> DataFrame:
        if lengths is None:
            return frame
        sizes.append(f"__len_{name}")
        return frame.withColumn(sizes[-1], F.length(work))

    df = note(df, "raw")
    for name, step in STEPS:
        if step is None:
            df = with_unescaped(df, work)
            df = df.withColumn(work, plain_blanks(F.col(work)))
        elif step is resolve_brackets:
            df = df.withColumn(work, resolve_brackets(F.col(work), mode))
        else:
            df = df.withColumn(work, step(F.col(work)))
        df = note(df, name)
    df = df.withColumn(target, F.col(work)).drop(work)
    if lengths is not None:
        df = df.withColumn(lengths, F.array(*sizes)).drop(*sizes)
    return df
