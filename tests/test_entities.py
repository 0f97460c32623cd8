"""Entities against the standard library's decoder."""

import html
import random
from html.entities import html5

from corpusloom.functions.entities import unescaped

NUMBERS = [*range(0, 0x100), 0x2028, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600,
           0x1FFFE, 0x1FFFF, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 10**9, 10**10, 2**63, 10**40]


def agree(column, texts):
    wrong = [(t, got, html.unescape(t)) for t, got in zip(texts, column(unescaped, texts)) if got != html.unescape(t)]
    assert wrong == []


def test_all_names(column):
    agree(column, [f"a&{name}b" for name in html5] + [f"&{name.rstrip(';')}" for name in html5] + [f"&{name};;" for name in html5])


def test_prefixes_of_names(column):
    names = sorted(html5)[::5]
    agree(column, [f"&{name[:k]}{tail}" for name in names for k in (1, 2, 3, 5, 7) for tail in ("", ";", "x;", " y", "&amp;")])


def test_numbers(column):
    forms = ["&#{0};", "&#{0}", "&#{0}x", "&#x{0:x};", "&#X{0:X}", "&#x{0:x}g", "&#000{0};", "&#x00000000000000{0:x};"]
    agree(column, [f.format(n) for n in NUMBERS for f in forms])


def test_texts(column):
    rng = random.Random(2)
    parts = ["&", "#", ";", "amp", "lt", "x", "41", " ", "é", "&nbsp;", "&notin;", "&notit;", "&#", "&#x", "\n", "&amp;lt;", "𝔸", "&" + "a" * 40 + ";", "not", "&CounterClockwiseContourIntegral;"]
    agree(column, ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2_000)] + ["", "no entity", "&", "&;", "&#;", "&#x;", "&#xg;"])


def test_null_and_long(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(None,), ("&amp;" * 30_000,)], "t string").select(unescaped(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in rows] == [None, "&" * 30_000]
