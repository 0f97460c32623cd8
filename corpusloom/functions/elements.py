"""Elements of HTML pages, as one fold over their tags.

A page is cut at its tokens.  Comments, declarations, scripts and styles are one
token each, and a tag is one token with its quoted attribute values, so nothing that
stands inside them is taken for a tag.  The fold carries the stack of open elements
of all names: an end tag closes the nearest open element of its name and whatever is
open inside it, and is ignored where none is open; void elements and ``<x/>`` never
open.  So an element ends at its own end tag, at the end tag of an element around it,
or with the page.  The fold marks the tokens as for nested regions, and with ``4`` the end
tag around an element that ends there and with ``5`` an element that never opens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.nesting import folded_marks
from corpusloom.functions.text import let

# Elements that have no end tag.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]

# Possessive throughout: a loop that gives nothing back needs no stack.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_REST = rf"(?:[^>=]++|{_VALUE})*+>"  # of a tag, behind its name
OPAQUE = (rf"<!--(?:-?>|(?s:.*?)(?:--!?>|\z))|<[!?][^>]*+>|<(?i:script)(?=[\s/>]){_REST}(?s:.*?)(?:</(?i:script)\s*+>|\z)"
          rf"|<(?i:style)(?=[\s/>]){_REST}(?s:.*?)(?:</(?i:style)\s*+>|\z)")
TOKEN = rf"{OPAQUE}|</?[a-zA-Z][^\s/>=]*+{_REST}"
OTHER, START, END = 0, 1, 2


def start_tag(tag: str, attribute: str | None = None, value: str = "") -> str:
    """Java pattern of the start tags of ``tag``, if given with an ``attribute`` whose whole value matches ``value``
    (a pattern without quotes); what other attributes hold does not count."""
    name = rf"(?is)^<{tag}(?=[\s/>])"
    if attribute is None:
        return name
    other = rf"""(?:[\s/]++(?!{attribute}\s*+=)[^\s=>/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+"""
    return rf"""{name}{other}[\s/]++{attribute}\s*+=\s*+(?:"{value}"|'{value}'|{value}(?=[\s>/]))"""


def attribute_of(token: Column, tag: str, attribute: str) -> Column:
    """Value of an attribute of a start tag, as written; empty where there is none."""
    pattern = start_tag(tag, attribute, "__")
    both, single, bare = pattern.rpartition("(?:")[0], r"'([^']*+)'", r"""((?!["'])[^\s>]*+)"""
    pattern = rf"""{both}(?:"([^"]*+)"|{single}|{bare})"""
    return F.concat(*[F.regexp_extract(token, pattern, n) for n in (1, 2, 3)])


def class_value(name: str) -> str:
    """Pattern of an attribute value whose list of words contains ``name``."""
    return rf"""(?:[^"'>]*\s)?{name}(?:\s[^"'>]*)?"""


def _element_marks(tokens: Column, starts: str, depth: int | None) -> Column:
    kind = _kinds(starts)
    begin = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("at"))

    def move(state: Column, t: Column) -> Column:
        opened, at = state["open"], state["at"]

        def to(stack: Column, place: Column, mark: Column | str) -> Column:
            mark = F.lit(mark) if isinstance(mark, str) else mark
            return F.struct(F.struct(stack.alias("open"), place.alias("at")).alias("state"), mark.alias("mark"))

        outside = at == 0
        hit = outside & t["hit"] if depth is None else outside & t["hit"] & (F.size(opened) == depth)
        stays = F.when(outside, "0").otherwise("2")
        begun = to(F.concat(opened, F.array(t["name"])),
                   F.when(hit, F.size(opened) + 1).otherwise(at), F.when(hit, "1").otherwise(stays))
        # Place of the nearest open element of that name, 0 where none is open.
        from_top = F.array_position(F.reverse(opened), t["name"]).cast("int")

        def ended(n: Column) -> Column:
            place = F.when(n > 0, F.size(opened) - n + 1).otherwise(0)
            closes = (at > 0) & (place > 0) & (place <= at)
            return F.when(place == 0, to(opened, at, stays)).otherwise(to(
                F.slice(opened, F.lit(1), F.greatest(place - 1, F.lit(0))), F.when(closes, 0).otherwise(at),
                F.when(closes & (place == at), "3").when(closes, "4").otherwise(stays)))

        return (F.when(t["kind"] == START, begun).when(t["kind"] == END, let(from_top, ended))
                .otherwise(to(opened, at, F.when(hit, "5").otherwise(stays))))

    return folded_marks(F.transform(tokens, kind), begin, move)


def _kinds(starts: str):
    """What the fold needs to know of a token."""

    def kind(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>=]*)", 1))
        empty = name.isin("", "script", "style", *VOID) | F.endswith(token, F.lit("/>"))
        closing = F.startswith(token, F.lit("</"))
        which = F.when(closing & (name != ""), END).when(empty, OTHER).otherwise(START)
        hit = ~closing & (name != "") & token.rlike(starts)
        return F.struct(name.alias("name"), which.alias("kind"), hit.alias("hit"))

    return kind


def element_blocks(html: Column, starts: str, depth: int | None = None) -> Column:
    """Array of the outer HTML of every outermost element whose start tag matches ``starts``,
    if ``depth`` is given of those inside as many elements."""

    def with_flags(tokens: Column) -> Column:
        return let(F.struct(tokens.alias("tokens"), F.split(html, TOKEN, -1).alias("texts"),
                            F.split(_element_marks(tokens, starts, depth), "").alias("flags")), blocks)

    def blocks(cut: Column) -> Column:
        tokens, texts, flags = cut["tokens"], cut["texts"], cut["flags"]

        def places(marks: str) -> Column:
            """1-based places of the tokens with one of the ``marks``."""
            return F.filter(F.transform(flags, lambda f, i: F.when(f.isin(*marks), i + 1)), lambda i: i.isNotNull())

        def block(first: Column, last: Column) -> Column:
            """From token ``first`` up to token ``last``, and with it if it is the element's own end."""
            inner = F.coalesce(last, F.size(tokens) + 1) - first
            body = F.zip_with(F.slice(tokens, first, inner), F.slice(texts, first + 1, inner), lambda t, x: F.concat(t, x))
            own = F.get(flags, last - 1) == "4"
            return F.concat(F.array_join(body, ""), F.when(last.isNull() | own, "").otherwise(F.get(tokens, last - 1)))

        # Regions do not overlap: the first to open is the first to close, the last may stay open.
        return F.zip_with(places("15"), places("345"), block)

    return let(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), with_flags)


def visible(html: Column) -> Column:
    """The page without comments, declarations, scripts and styles."""
    return F.when(html.rlike(r"(?i)<(?:[!?]|script|style)"), F.regexp_replace(html, OPAQUE, "")).otherwise(html)
