"""Pages: containers, listings, resume and lookup joins, caps, URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.catalog.registry import documents, query, table, texts
from corpusloom.functions.urls import article_url
from corpusloom.functions.verse import first_container, total_pages
from corpusloom.operators import pages as P
from corpusloom.operators.joins import not_yet_done
from corpusloom.operators.rows import keep


@query("page_extract", r"""SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>.*?</article>') AS body FROM pages
WHERE regexp_matches(html, '<article')""")
def page_extract(spark, folder):
    rows = texts(spark, folder, "pages", "page_id").withColumn("body", first_container(F.col("html"), "article"))
    return keep(rows, F.col("body").isNotNull()).select("page_id", "body")


# Every 7th page carries one of the four block notices.
@query("page_block_filter", "SELECT page_id FROM pages WHERE page_id % 7 <> 0")
def page_block_filter(spark, folder):
    markers = F.array(*[F.lit(m) for m in settings.BLOCKED_LISTING_MARKERS])
    notice = F.get(markers, (F.col("page_id") % 4).cast("int"))
    rows = table(spark, folder, "pages").withColumn(
        "html", F.when(F.col("page_id") % 7 == 0, F.concat("html", notice)).otherwise(F.col("html"))
    )
    return P.readable_pages(rows, settings.BLOCKED_LISTING_MARKERS).select("page_id")


_LISTING = r"""WITH h AS (SELECT page_id, url, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS title FROM pages),
items AS (
  SELECT page_id, 0 AS item_ord, trim(replace(title, '&amp;', '&')) AS title, url, 'A ' || page_id % 10 AS author FROM h
  UNION ALL SELECT page_id, 1, 'plain', '/p/' || page_id, 'Unknown' FROM h
  UNION ALL SELECT page_id, 2, 'both', '/shared/' || page_id % 50, 'B & ' || page_id % 3 FROM h)
"""


PAGES_OF_A_TASK = 1_000  # reading a page for its items is some ten milliseconds


def _listing_pages(spark, folder):
    """Listing pages: the real page plus four list items, one without a URL."""
    title = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    number = F.col("page_id").cast("string")

    def item(link, name, by):
        return F.concat(
            F.lit('<div class="list-item"><div>x</div><h4 class="list-item-header"> <a href="'), link,
            F.lit('">'), name, F.lit("</a></h4>"), by, F.lit("</div>"),
        )

    def author(name):
        return F.concat(F.lit('<p><a href="/author-1"> '), name, F.lit("</a></p>"))

    return texts(spark, folder, "pages", "page_id", PAGES_OF_A_TASK).select(
        "page_id", "url", title.alias("title"),
        F.concat(
            "html",
            item(F.replace("url", F.lit("&"), F.lit("&amp;")), title, author(F.concat(F.lit("A "), (F.col("page_id") % 10).cast("string")))),
            item(F.concat(F.lit("/p/"), number), F.lit("<b>plain</b>"), F.lit('<a href="/x">n</a>')),
            item(F.concat(F.lit("/shared/"), (F.col("page_id") % 50).cast("string")), F.lit(" both "),
                 author(F.concat(F.lit("B &amp; "), (F.col("page_id") % 3).cast("string")))),
            item(F.lit(""), F.lit("none"), F.lit("")),
            F.lit('<a href="/author-9">outside</a>'),
        ).alias("html"),
    )


def _items(spark, folder):
    return P.listing_items(_listing_pages(spark, folder).select("page_id", "html"))


@query("listing_items", _LISTING + "SELECT * FROM items")
def listing_items(spark, folder):
    return _items(spark, folder)


@query("listing_authors", _LISTING + "SELECT DISTINCT author FROM items WHERE author <> 'Unknown'")
def listing_authors(spark, folder):
    return P.known_authors(_items(spark, folder))


# Phase 1 lists every page; phase 2 lists pages again under a searched author
# and adds one URL per page that phase 1 has not.
@query("url_first_wins", _LISTING + r""", merged AS (
  SELECT 1 AS phase, page_id AS listing_ord, 1 AS page, item_ord, title, url, author FROM items
  UNION ALL SELECT 2, page_id, 2, item_ord, title,
    CASE WHEN item_ord = 1 THEN '/new/' || page_id % 20 ELSE url END, 'S ' || page_id % 4 FROM items)
SELECT title, url, author, phase FROM merged
QUALIFY row_number() OVER (PARTITION BY url ORDER BY phase, listing_ord, page, item_ord) = 1""")
def url_first_wins(spark, folder):
    items = _items(spark, folder).withColumnRenamed("page_id", "listing_ord")
    again = items.withColumn("page", F.lit(2)).withColumn(
        "url", F.when(F.col("item_ord") == 1, F.concat(F.lit("/new/"), (F.col("listing_ord") % 20).cast("string")))
        .otherwise(F.col("url")),
    ).withColumn("searched", F.concat(F.lit("S "), (F.col("listing_ord") % 4).cast("string")))
    return P.merged_listings(items.withColumn("page", F.lit(1)), again)


@query("listing_total_pages", r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN page_id + 1 WHEN 1 THEN page_id
  WHEN 2 THEN page_id + 11 ELSE coalesce((SELECT max(CAST(n AS BIGINT)) FROM (
    SELECT unnest(regexp_extract_all(html, '<a\s[^>]*?href="[^"]*?Page=(\d+)', 1)) AS n)), 1) END AS total FROM pages""")
def listing_total_pages(spark, folder):
    n = F.col("page_id")

    def number(c):
        return c.cast("string")

    extra = (
        F.when(n % 4 == 0, F.concat(F.lit("có tổng số "), number(n + 1), F.lit(" trang. Trang 3 / 9")))
        .when(n % 4 == 1, F.concat(F.lit('<a href="?Page=99">x</a> Trang 1 / '), number(n)))
        .when(n % 4 == 2, F.concat(F.lit('<a class="u" href="?q=1&amp;Page='), number(n + 11),
                                   F.lit('">l</a> <a href="?Page=2">2</a> Page=99999')))
        .otherwise("")
    )
    return table(spark, folder, "pages").select("page_id", total_pages(F.concat("html", extra)).alias("total"))


@query("sort_frontier", r"""WITH c AS (SELECT c_nationkey % 9 AS k, count(*) AS total FROM customer GROUP BY 1),
s AS (SELECT * FROM (VALUES (0, '', ''), (1, 'Author', 'asc'), (2, 'Author', 'desc'), (3, 'Views', 'desc'), (4, 'Views', 'asc'),
  (5, 'Date', 'asc'), (6, 'Date', 'desc'), (7, 'Poster', 'asc'), (8, 'Poster', 'desc')) AS t(k, sort, "order"))
SELECT sort, "order", page, 'https://www.thivien.net/search-poem.php?PoemType=16&Country=2'
  || CASE WHEN sort <> '' THEN '&Sort=' || sort ELSE '' END
  || CASE WHEN "order" <> '' THEN '&SortOrder=' || "order" ELSE '' END || '&Page=' || page AS url
FROM (SELECT sort, "order", unnest(range(1, least(total, 10) + 1)) AS page FROM c JOIN s USING (k))""")
def sort_frontier(spark, folder):
    """The customers of a group of nations stand in for one sorted listing."""
    sorts = F.array(*[F.struct(F.lit(s).alias("sort"), F.lit(o).alias("order")) for s, o in settings.LISTING_SORTS])
    group = (F.col("c_nationkey") % len(settings.LISTING_SORTS)).cast("int")
    totals = table(spark, folder, "customer").groupBy(group.alias("k")).agg(F.count("*").alias("total"))
    listings = totals.withColumn("s", F.get(sorts, F.col("k")))
    return P.sort_frontier(listings.select("s.sort", "s.order", "total"))


@query("author_frontier", r"""SELECT author, page, 'https://www.thivien.net/search-poem.php?PoemType=16&Author='
  || replace(url_encode(author), '%2F', '/') || '&Page=' || page AS url
FROM (SELECT c_name || ' / ' || c_mktsegment || ' ấy' AS author, unnest(range(1, least(c_custkey % 14 + 1, 10) + 1)) AS page FROM customer)""")
def author_frontier(spark, folder):
    name = F.concat("c_name", F.lit(" / "), "c_mktsegment", F.lit(" ấy"))
    rows = table(spark, folder, "customer").select(
        name.alias("author"), (F.col("c_custkey") % 14 + 1).cast("bigint").alias("total")
    )
    return P.author_frontier(rows)


@query("article_urls", r"""SELECT page_id, 'https://vi.wikipedia.org/wiki/' || replace(replace(url_encode(
  replace(t, ' ', '_')), '%2F', '/'), '%3A', ':') AS url
FROM (SELECT page_id, url || ' ~*+()' || regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS t FROM pages)""")
def article_urls(spark, folder):
    title = F.concat("url", F.lit(" ~*+()"), F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1))
    return table(spark, folder, "pages").select("page_id", article_url(title).alias("url"))


# --- joins and caps ---

@query("resume_pending", r"""SELECT page_id, CASE WHEN page_id % 10 = 9 THEN NULL ELSE url END AS url FROM pages
WHERE page_id % 10 = 9 OR page_id NOT IN (SELECT doc_id FROM labels)""")
def resume_pending(spark, folder):
    """Pages whose URL is not done; a page without a URL stays, and so do no
    null URLs of the done side matter."""
    meta = table(spark, folder, "pages").select(
        "page_id", F.when(F.col("page_id") % 10 != 9, F.col("url")).alias("url")
    )
    done = table(spark, folder, "labels").join(
        table(spark, folder, "pages"), F.col("doc_id") == F.col("page_id")
    ).select(F.when(F.col("page_id") % 10 != 9, F.col("url")).alias("url"))
    return not_yet_done(meta, done, "url").select("page_id", "url")


@query("incremental_ids", "SELECT doc_id AS pageid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_ids(spark, folder):
    listed = table(spark, folder, "documents").select(F.col("doc_id").alias("pageid"))
    return P.new_ids(listed, table(spark, folder, "labels").select(F.col("doc_id").alias("pageid")))


@query("capped_new", """SELECT doc_id AS pageid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
ORDER BY doc_id LIMIT greatest((SELECT count(*) FROM documents) * 3 // 4 - (SELECT count(*) FROM labels), 0)""")
def capped_new(spark, folder):
    """New ids until three quarters of the listing are stored in total."""
    listed = table(spark, folder, "documents").select(F.col("doc_id").alias("pageid"))
    seen = table(spark, folder, "labels").select(F.col("doc_id").alias("pageid"))
    return P.capped_new(listed, seen, listed.count() * 3 // 4)


@query("source_cap", """SELECT doc_id, source FROM documents
ORDER BY CAST(substring(source, 4) AS INTEGER), doc_id LIMIT (SELECT count(*) * 3 // 5 FROM documents)""")
def source_cap(spark, folder):
    docs = documents(spark, folder, "doc_id")
    return P.first_rows_of_source(docs, docs.count() * 3 // 5).select("doc_id", "source")


@query("page_eligibility", "SELECT doc_id AS pageid FROM documents WHERE lang = 'en' AND source <> 'src3'")
def page_eligibility(spark, folder):
    entries = table(spark, folder, "documents").select(
        F.col("doc_id").alias("pageid"), F.when(F.col("lang") == "en", 0).otherwise(1).alias("ns"),
        (F.col("source") == "src3").alias("is_redirect"),
    )
    return P.eligible_pages(entries).select("pageid")


@query("page_content_join", r"""SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE source || ' ' || lang END AS title, text,
  'https://vi.wikipedia.org/wiki/' || CASE WHEN doc_id % 4 = 0 THEN '' ELSE source || '_' || lang END AS url
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id % 6 <> 0 AND doc_id % 5 <> 0 AND text <> ''""")
def page_content_join(spark, folder):
    """Wanted ids = labelled documents; contents in the nested response shape,
    every 6th without a revision, every 5th without text."""
    n = F.col("doc_id")
    content = F.when(n % 5 != 0, F.col("text"))
    main = F.struct(content.alias("content"))
    revision = F.struct(F.struct(main.alias("main")).alias("slots"))
    contents = table(spark, folder, "documents").select(
        n.alias("pageid"),
        F.when(n % 4 != 0, F.concat("source", F.lit(" "), "lang")).alias("title"),
        F.filter(F.array(revision), lambda _r: n % 6 != 0).alias("revisions"),
    )
    ids = table(spark, folder, "labels").select(F.col("doc_id").alias("pageid"))
    return P.articles(ids, contents)


@query("verse_pages", r"""WITH meta AS (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'M' || page_id END AS title,
    CASE WHEN page_id % 4 = 0 THEN 'Unknown' ELSE 'A' || page_id % 10 END AS author FROM pages),
d AS (SELECT doc_id, text AS t FROM documents),
p AS (SELECT m.*, t FROM meta m JOIN d ON doc_id = page_id WHERE page_id % 11 <> 0 AND page_id % 13 <> 0)
SELECT url, author, 'TừA & B' || page_id AS source, 0 AS piece, 'One' AS title, t || chr(10) || 'x' AS content FROM p WHERE page_id % 2 = 0
UNION ALL SELECT url, author, 'TừA & B' || page_id, 1, 'Two <i>', t || chr(10) || '</div>' FROM p WHERE page_id % 2 = 0
UNION ALL SELECT url, author, 'TừA & B' || page_id, 0, coalesce(title, ''),
  '<div class="a poem-content">' || t || chr(10) || '<div>n</div></div>' FROM p WHERE page_id % 2 = 1""")
def verse_pages(spark, folder):
    """Fetched verse pages around the documents; some are blocked or lack the
    container, half of them hold two titled poems."""
    n = F.col("page_id")
    pages = table(spark, folder, "pages").select("page_id", "url")
    meta = pages.select(
        "url", F.when(n % 3 != 0, F.concat(F.lit("M"), n.cast("string"))).alias("title"),
        F.when(n % 4 != 0, F.concat(F.lit("A"), (n % 10).cast("string"))).alias("author"),
    )
    poems = table(spark, folder, "documents").select("doc_id", F.col("text").alias("t"))
    two = F.concat(F.lit("intro<b> One</b><br/><br>\n"), "t", F.lit("<br>x\n<B>Two <i></B><BR />\n\n"), "t", F.lit("\n"))
    one = F.concat("t", F.lit("<br/><div>n</div>"))
    body = F.concat(
        F.lit('<html><div class="top">a<div class="poem-contents">no</div></div>'),
        F.when(n % 11 == 0, F.lit('<div id="poem-content">')).otherwise(F.lit('<div class="a poem-content">')),
        F.when(n % 2 == 0, two).otherwise(one),
        F.lit("</div><div class='small'> <b>Từ </b>\n A &amp; B<i>"), n.cast("string"), F.lit("</i></div>"),
        F.when(n % 13 == 0, F.lit(settings.BLOCKED_PAGE_MARKERS[0])).otherwise(""), F.lit("</html>"),
    )
    html = pages.join(poems, n == F.col("doc_id")).select("url", body.alias("html"))
    return P.verse_pages(html, meta)
