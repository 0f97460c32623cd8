"""URL expressions (percent-encoding with the safe sets of the workload)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import settings


def _quote(c: Column, safe: str) -> Column:
    """Percent-encode UTF-8; letters, digits, ``_.-~`` and ``safe`` stay."""
    out = F.url_encode(c)
    for encoded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    for ch in safe:
        out = F.replace(out, F.lit(f"%{ord(ch):02X}"), F.lit(ch))
    return out


def article_url(title: Column, base: str = settings.ARTICLE_URL) -> Column:
    slug = F.replace(title, F.lit(" "), F.lit("_"))
    return F.concat(F.lit(base), _quote(slug, "/:"))


def listing_url(sort: Column, order: Column, page: Column, base: str = settings.LISTING_URL) -> Column:
    return F.concat(
        F.lit(base + settings.LISTING_COUNTRY),
        F.when(sort != "", F.concat(F.lit("&Sort="), sort)).otherwise(""),
        F.when(order != "", F.concat(F.lit("&SortOrder="), order)).otherwise(""),
        F.lit("&Page="),
        page.cast("string"),
    )


def author_listing_url(author: Column, page: Column, base: str = settings.LISTING_URL) -> Column:
    return F.concat(
        F.lit(base + "&Author="), _quote(author, "/"), F.lit("&Page="), page.cast("string")
    )
