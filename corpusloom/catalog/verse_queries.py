"""Verse: splitting, cleaning and stanzas on pages built from the documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.catalog.registry import doc_id, documents, query
from corpusloom.functions.text import remove_prefix, split_lines, split_paragraphs, strip
from corpusloom.functions.verse import break_tags, poems_of_page
from corpusloom.operators.rows import keep
from corpusloom.plans import verse_corpus as V


@query("poem_split", r"""WITH d AS (SELECT doc_id, source, text AS t FROM documents)
SELECT doc_id, 0 AS piece, 'First' AS title, t AS content FROM d WHERE doc_id % 3 <> 0
UNION ALL SELECT doc_id, 1, 'Second', 'l1' || chr(10) || t FROM d WHERE doc_id % 3 <> 0
UNION ALL SELECT doc_id, 0, source, t || chr(10) || '<b>inline</b> x' FROM d WHERE doc_id % 3 = 0""")
def poem_split(spark, folder):
    rows = documents(spark, folder, "doc_id").withColumnRenamed("text", "t")
    titled = F.concat(F.lit("lost <b>First </b>\n\n\n"), "t", F.lit("<br><B> Second</B> <br/>\n\nl1<BR />"), "t", F.lit("\n\n"))
    plain = F.concat("t", F.lit("<br><b>inline</b> x"))
    page = break_tags(F.when(F.col("doc_id") % 3 != 0, titled).otherwise(plain))
    # A document that starts or ends with a line break would lose it; none does.
    return rows.withColumn("page", page).select(
        "doc_id", F.posexplode(poems_of_page(F.col("page"), F.col("source"))).alias("piece", "poem")
    ).select("doc_id", "piece", "poem.title", "poem.content")


@query("poem_clean", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(replace(t, chr(10), chr(10) || chr(10)),
    ' +', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) || ' < é' AS content,
  'Book ' || source AS source, 'T & ' || doc_id AS title
FROM (SELECT doc_id, source, text AS t FROM documents)""")
def poem_clean(spark, folder):
    content = F.concat(
        F.lit("<DIV class=x><p><img src='a'></img><I>note\nlost</I>"), F.replace("text", F.lit("\n"), F.lit("<br/>\n")),
        F.lit("</p> &nbsp; &lt;<b> &eacute;</b></div>  "),
    )
    pages = documents(spark, folder, "doc_id").select(
        "ord", "doc_id", F.concat(F.lit(" T &amp; "), F.col("doc_id").cast("string")).alias("title"),
        F.when(F.lit(True), content).alias("content"),
        F.concat(F.lit("Book "), "source", F.lit(" BÌNH luận nhanh 3")).alias("source"),
    )
    return V.clean_pages(pages).select("doc_id", "content", "source", "title")


def _verse_pages(spark, folder):
    """All words of a document in lines of five and stanzas of four lines; every
    third stanza gets a sixth word, the last one may be short."""
    words = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))

    def chunks(items: Column, size: int, each):
        starts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(size))
        return F.transform(starts, lambda s, i: each(F.slice(items, s + 1, size), i))

    rows = keep(documents(spark, folder, "doc_id").withColumn("w", words), F.size("w") > 0)
    rows = rows.withColumn("lines", chunks(F.col("w"), 5, lambda ws, _i: F.concat(F.lit(' "'), F.array_join(ws, "  "), F.lit(',- '))))
    stanza = lambda ls, i: F.concat(F.when(i % 3 == 2, "sixth ").otherwise(""), F.array_join(ls, "\n"))
    rows = rows.withColumn("stanzas", chunks(F.col("lines"), 4, stanza))
    return rows.select("ord", "doc_id", F.array_join("stanzas", "\n \n\n").alias("content"))


_STANZAS = r"""WITH d AS (SELECT doc_id, CAST(substring(source, 4) AS INTEGER) AS so, regexp_extract_all(text, '\p{L}+') AS w FROM documents),
s AS (SELECT doc_id, so, w, unnest(range(0, len(w) // 20)) AS stanza_ord FROM d),
stanzas AS (SELECT doc_id, so, CAST(stanza_ord AS INTEGER) AS stanza_ord,
  array_to_string(list_transform([0, 5, 10, 15], lambda k: array_to_string(w[stanza_ord * 20 + k + 1 : stanza_ord * 20 + k + 5], ' ')), chr(10)) AS text
  FROM s WHERE stanza_ord % 3 <> 2)
"""


@query("poem_stanzas", _STANZAS + "SELECT doc_id, stanza_ord, text FROM stanzas")
def poem_stanzas(spark, folder):
    return V.valid_stanzas(_verse_pages(spark, folder)).select(doc_id(), "stanza_ord", "text")


@query("poem_unique", _STANZAS + """SELECT doc_id, stanza_ord, text FROM stanzas
QUALIFY row_number() OVER (PARTITION BY text ORDER BY so, doc_id, stanza_ord) = 1""")
def poem_unique(spark, folder):
    stanzas = V.valid_stanzas(_verse_pages(spark, folder))
    return V.distinct_stanzas(stanzas).select(doc_id(), "stanza_ord", "text")


@query("text_shape", r"""SELECT doc_id, length(text) AS n_stripped, len(string_split(text, chr(10))) + 1 AS n_lines,
  len(list_filter(string_split(text, chr(10)), lambda p: trim(p) <> '')) + 1 AS n_paragraphs FROM documents""")
def text_shape(spark, folder):
    """Strip, line and paragraph functions on texts with mixed white space."""
    framed = F.concat(F.lit(" \x1c\t"), "text", F.lit(" 　\x85"))
    pieces = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit(" x\x0b"))
    blocks = F.concat(F.replace("text", F.lit("\n"), F.lit("\n\n \t\n\n")), F.lit("\n\nx"))
    return documents(spark, folder, "doc_id").select(
        "doc_id", F.length(strip(framed)).alias("n_stripped"), F.size(split_lines(pieces)).alias("n_lines"),
        F.size(split_paragraphs(blocks)).alias("n_paragraphs"),
    )


@query("prefix_strip", """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN trim(text, ' ' || chr(10)) ELSE ' ' || text END AS text FROM conversations""")
def prefix_strip(spark, folder):
    from corpusloom.catalog.registry import table

    prefix = settings.VERSE_PREFIX
    raw = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(prefix), "text", F.lit(" \n"))).otherwise(F.concat(F.lit(" "), "text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", remove_prefix(raw, prefix).alias("text"))
