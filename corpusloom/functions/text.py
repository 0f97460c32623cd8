"""Text expressions with Python string semantics, evaluated inside the JVM.

NFC, which Spark has no built-in for, is an Arrow UDF.  A ``CASE`` does not keep
rows out of a Python UDF, so the *argument* is made null for rows that cannot
change: Arrow then carries only the texts that really need Python.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import bounded_batches

# The 29 characters Python's str.strip()/split() treat as white space.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a Java character class.
# Single characters below U+0100 share one bit table, which is the cheap way to test them.
BLANK_SET = r"\t\x0b\f\r\x1c\x1d\x1e\x1f \x{85}\p{Z}"  # without the newline
WS_SET = rf"\n{BLANK_SET}"
WS = f"[{WS_SET}]"
# Line breaks other than a newline.
# A pattern that begins with one character, and no alternative, passes over the others fastest.
OTHER_BREAK = r"[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}](?:(?<=\r)\n)?+"
LINE_BREAK = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}](?:(?<=\r)\n)?+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WS_CHARS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def split_words(c: Column) -> Column:
    """``str.split()``: runs of white space separate, no empty items."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def split_lines(c: Column) -> Column:
    """``str.splitlines()``: a final line break adds no empty line."""
    return let(
        F.split(c, LINE_BREAK, -1),
        lambda parts: F.when(
            F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)
        ).otherwise(parts),
    )


def split_paragraphs(c: Column, separator: str = "\n\n") -> Column:
    """Paragraphs in order, stripped, without the empty ones."""
    quoted = "\\Q" + separator + "\\E"
    return F.filter(F.transform(F.split(c, quoted, -1), strip), lambda p: p != "")


def contains_any(c: Column, *parts: str) -> Column:
    """Cheap guard in front of a regular expression that needs one of ``parts``."""
    found = F.contains(c, F.lit(parts[0]))
    for part in parts[1:]:
        found = found | F.contains(c, F.lit(part))
    return found


def squeeze_newlines(c: Column) -> Column:
    return F.when(contains_any(c, "\n\n\n"), F.regexp_replace(c, r"\n{3,}", "\n\n")).otherwise(c)


def strip_lines(c: Column) -> Column:
    """Lines stripped and joined by newlines, then the whole text stripped."""
    blank = f"[{BLANK_SET}]*+"
    return strip(F.regexp_replace(F.regexp_replace(c, OTHER_BREAK, "\n"), rf"{blank}\n{blank}", "\n"))


def digest(c: Column) -> Column:
    """SHA-256 as 32 bytes; the caller passes NFC text."""
    return F.unhex(F.sha2(c, 256))


@F.arrow_udf(T.StringType())
def _nfc_udf(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def with_nfc(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Add ``target`` = NFC form of ``source``; null becomes the empty text."""
    target = target or source
    df = bounded_batches(df).withColumn(target, F.coalesce(F.col(source), F.lit("")))
    # ASCII texts are NFC; both lengths are cheap, a regular expression over the
    # text costs more than the Arrow transfer it would save.
    changed = f"__{target}_changed"
    beyond_ascii = F.octet_length(target) != F.length(target)
    df = df.withColumn(changed, _nfc_udf(F.when(beyond_ascii, F.col(target))))
    return df.withColumn(target, F.coalesce(F.col(changed), F.col(target))).drop(changed)


def word_count(line: Column) -> Column:
    """Words of a verse line; punctuation separates words."""
    # Fixed set of punctuation characters.
    return F.size(split_words(F.regexp_replace(line, r"""[.,!?;:"'“”‘’\-–—()]""", " ")))


def format_size(n: Column) -> Column:
    """Bytes as text with a unit, two decimals, steps of 1024.

    Integer arithmetic with ties to even: the quotients are exact binary
    fractions, so this equals correctly rounded floating-point formatting.
    """
    n = n.cast("bigint")

    def scaled(power: int) -> Column:
        unit = 1 << power
        floor = F.floor(n / unit)
        rest = (n - floor * unit) * 100
        cents = F.shiftright(rest, power) if power else rest
        twice = (rest - cents * unit) * 2
        up = (twice > unit) | ((twice == unit) & (cents % 2 == 1))
        cents = floor * 100 + cents + F.when(up, 1).otherwise(0)
        return F.format_string("%d.%02d", F.floor(cents / 100), cents % 100)

    out = F.concat(scaled(40), F.lit(" TB"))
    for power, unit in ((30, "GB"), (20, "MB"), (10, "KB"), (0, "B")):
        out = F.when(n < (1 << power) * 1024, F.concat(scaled(power), F.lit(f" {unit}"))).otherwise(out)
    return out


def python_round(c: Column, digits: int) -> Column:
    """``round(x, digits)`` on the exact binary value, for small report tables;
    the built-ins round the printed decimal instead."""

    def rounded(values: pd.Series) -> pd.Series:
        return values.map(lambda v: round(v, digits), na_action="ignore")

    return F.pandas_udf(rounded, T.DoubleType())(c)


def perplexity(loss: Column) -> Column:
    return F.exp(loss)


def remove_prefix(c: Column, prefix: str) -> Column:
    """Text after ``prefix`` (stripped) where it starts with it, else the text."""
    return F.when(
        F.startswith(c, F.lit(prefix)), strip(F.substring(c, len(prefix) + 1, 2**31 - 1))
    ).otherwise(c)
