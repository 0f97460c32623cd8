"""HTML entities decoded inside the JVM, by the rules of the HTML standard.

Names are looked up in the public table of the standard, dealt to small maps by their
CRC so that a lookup reads a few names and not all; a name the table lacks gives the longest name
it begins with.  Numbers become characters by arithmetic.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let

ENTITY = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32};?)"
CELLS = 1_024
LONGEST = 34  # characters of a match behind the ampersand, at most
# Names that count without a semicolon, and so in front of other text.
OPEN_LENGTHS = sorted({len(name) for name in html5 if not name.endswith(";")}, reverse=True)
REPLACEMENT = "�"
LAST = 0x10FFFF


@lru_cache(None)
def _cells() -> str:
    cells: list[dict[str, str]] = [{} for _ in range(CELLS)]
    for name, text in html5.items():
        cells[zlib.crc32(name.encode()) % CELLS][name] = text
    return json.dumps(cells)


def _named(table: Column, name: Column) -> Column:
    return F.try_element_at(F.get(table, (F.crc32(name.cast("binary")) % CELLS).cast("int")), name)


def _character(n: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _instead() -> dict[int, str]:
    """Numbers that stand for another character: the C1 controls are read as Windows-1252."""
    western = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    return {0: REPLACEMENT, 0x0D: "\r"} | western


def _number(digits: Column) -> Column:
    """Text of a reference by number, given with its ``#`` and without the semicolon."""
    hexadecimal = F.lower(F.substring(digits, 2, 1)) == "x"
    plain = F.regexp_replace(digits, r"^#[xX]?0*", "")
    value = F.when(F.length(plain) > 9, F.lit(LAST + 1)).when(
        hexadecimal, F.conv(plain, 16, 10).cast("bigint")).otherwise(F.coalesce(plain.try_cast("bigint"), F.lit(0)))
    table = F.create_map(*[F.lit(x) for item in _instead().items() for x in item])

    def text(n: Column) -> Column:
        dropped = (n.between(1, 8) | (n == 0x0B) | n.between(0x0E, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF)
                   | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
        return (F.when(n < 0xA0, F.coalesce(F.try_element_at(table, n.cast("int")), F.when(dropped, F.lit("")).otherwise(_character(n))))
                .when(n.between(0xD800, 0xDFFF) | (n > LAST), REPLACEMENT).when(dropped, "").otherwise(_character(n)))

    return let(F.coalesce(value, F.lit(0)), text)


def _decoded(entity: Column, table: Column) -> Column:
    def begins_with(size: Column) -> Column:
        """Text of the name of ``size`` characters and what follows it; null where there is no such name."""
        name = F.substring(entity, F.lit(2), size)
        return F.concat(_named(table, name), F.substring(entity, size + 2, F.lit(LONGEST)))

    found = F.filter(F.transform(F.array(*[F.lit(n) for n in OPEN_LENGTHS]), begins_with), lambda t: t.isNotNull())
    number = _number(F.rtrim(F.substring(entity, F.lit(2), F.length(entity)), F.lit(";")))
    whole = _named(table, F.substring(entity, F.lit(2), F.lit(LONGEST)))
    return F.when(F.startswith(entity, F.lit("&#")), number).otherwise(F.coalesce(whole, F.get(found, F.lit(0)), entity))


def unescaped(c: Column) -> Column:
    """The text with its entities decoded once, from left to right."""

    def rebuilt(both: Column) -> Column:
        texts, table = both["texts"], both["table"]
        entities = F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0))
        parts = F.zip_with(entities, F.slice(texts, F.lit(2), F.size(texts)), lambda e, t: F.concat(_decoded(e, table), t))
        return F.concat(F.element_at(texts, 1), F.array_join(parts, ""))

    table = F.from_json(F.lit(_cells()), "array<map<string,string>>")  # a constant: read once
    return F.when(F.contains(c, F.lit("&")), let(
        F.struct(F.split(c, ENTITY, -1).alias("texts"), table.alias("table")), rebuilt)).otherwise(c)


def with_unescaped(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Add ``target`` = ``source`` with entities decoded, as a step of its own, so that it is computed once."""
    return df.withColumn(target or source, unescaped(F.col(source)))
