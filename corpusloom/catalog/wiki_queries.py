"""Wikitext cleaning by construct-and-invert: markup is put around the whole
documents, and the SQL states the text that has to come back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.catalog.registry import documents, query, table
from corpusloom.functions import wikitext as W
from corpusloom.functions.entities import with_unescaped
from corpusloom.plans.wiki_corpus import cleaning_audit

# The documents keep all their characters; where some have a meaning in a step, the SQL states it.
_BASE = "WITH base AS (SELECT doc_id, source, text AS t FROM documents) "


def _base(spark, folder):
    return documents(spark, folder, "doc_id").withColumnRenamed("text", "t")


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _marked_lines(each: str) -> Column:
    """The base text with ``each`` before every line break."""
    return F.replace("t", F.lit("\n"), F.lit(each + "\n"))


@query("wiki_tags", _BASE + r"""SELECT doc_id, replace(t, chr(10), ' x ' || chr(10)) || '  !' AS clean FROM base""")
def wiki_tags(spark, folder):
    raw = _cat(
        _marked_lines("<B class='c'>x</b>"), "<!-- a\n<b> -->", '<ref name="n" />', "<ref>cited\ntext</REF>",
        "<span style=x>", "</span>", "<custom-tag a>", "!",
    )
    return _base(spark, folder).select("doc_id", W.strip_tags(raw).alias("clean"))


@query("wiki_templates", _BASE + "SELECT doc_id, '}' || t || '!' AS clean FROM base")
def wiki_templates(spark, folder):
    raw = _cat("{{Info|a={{x}}\n|b}c={}}}", _marked_lines("{{ref|{{q}} z}}"), "}}!", "{{open ", F.col("t"))
    return _base(spark, folder).select("doc_id", W.drop_templates(raw).alias("clean"))


@query("wiki_tables", _BASE + "SELECT doc_id, t || '|}|-!' AS clean FROM base")
def wiki_tables(spark, folder):
    raw = _cat("{| class=w\n|-\n| a {| nested |} b\n|}", _marked_lines("{|r|}"), "|}|-!", "{| open ", F.col("t"))
    return _base(spark, folder).select("doc_id", W.drop_tables(raw).alias("clean"))


@query("wiki_orphan_rows", _BASE + "SELECT doc_id, t || chr(10) || '|keep' AS clean FROM base")
def wiki_orphan_rows(spark, folder):
    raw = _cat("|- row\n || cells\n|+ caption\n| cell\n", F.col("t"), "\n|keep")
    return _base(spark, folder).select("doc_id", W.drop_orphan_rows(raw).alias("clean"))


@query("wiki_links", _BASE + r"""SELECT doc_id, replace(t, chr(10), 'labelpage' || chr(10)) || 'b [[c]] d' || ']]' ||
  CASE WHEN length(t) > 2 THEN regexp_replace(left(t, length(t) - 2), '^[^|]*\|', '') ELSE '' END AS clean FROM base""")
def wiki_links(spark, folder):
    raw = _cat(
        _marked_lines("[[page|label]][[Tập_tin:x.jpg|thumb|a [[b]] c]][[page]][[CATEGORY:x]]"),
        "[[a|b [[c]] d]]]][[", F.col("t"),
    )
    return _base(spark, folder).select("doc_id", W.resolve_links(raw).alias("clean"))


@query("wiki_single_brackets", _BASE + r"""SELECT doc_id,
  replace(t, chr(10), 'label word //u l' || chr(10)) || '//u' AS faithful,
  replace(t, chr(10), 'label word l' || chr(10)) AS fixed FROM base""")
def wiki_single_brackets(spark, folder):
    raw = _cat(_marked_lines("[wikt:w|label] [wikt:word][fr:Article] [http://u l]"), "[https://u]")
    return _base(spark, folder).select(
        "doc_id", W.resolve_brackets(raw).alias("faithful"), W.resolve_brackets(raw, "fixed").alias("fixed")
    )


@query("wiki_headers", _BASE + r"""SELECT doc_id, 'Top' || chr(10) || replace(t, chr(10), chr(10) || 'Part' || chr(10))
  || chr(10) || 'End' AS clean FROM base""")
def wiki_headers(spark, folder):
    raw = _cat("= Top =\n", F.replace("t", F.lit("\n"), F.lit("\n==  Part == \n")), "\n===End===")
    return _base(spark, folder).select("doc_id", W.unwrap_headers(raw).alias("clean"))


@query("wiki_emphasis", _BASE + r"""SELECT doc_id, replace(t, chr(10), 'bi' || chr(10)) || 'x--' AS clean FROM base""")
def wiki_emphasis(spark, folder):
    raw = _cat("__NOTOC__", _marked_lines("'''b'''''i''"), "----__TOC__-----", "x--")
    return _base(spark, folder).select("doc_id", W.drop_emphasis(raw).alias("clean"))


# Lines get one of four list forms in turn; a line of blanks only stays a line.
@query("wiki_lists", _BASE + r""", lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
    generate_subscripts(string_split(t, chr(10)), 1) AS i FROM base)
SELECT doc_id, string_agg(CASE i % 4 WHEN 0 THEN 'term: ' || trim(line) WHEN 1 THEN ltrim(line)
    WHEN 2 THEN ltrim(line) ELSE line END, chr(10) ORDER BY i) AS clean FROM lines
WHERE trim(line) <> '' GROUP BY doc_id""")
def wiki_lists(spark, folder):
    lines = F.transform(F.split("t", "\n"), lambda line, i: F.struct(line.alias("line"), (i + 1).alias("i")))
    solid = F.filter(lines, lambda x: F.trim(x["line"]) != "")
    raw = F.array_join(F.transform(solid, lambda x: (
        F.when(x["i"] % 4 == 0, F.concat(F.lit(" ; term : "), x["line"]))
        .when(x["i"] % 4 == 1, F.concat(F.lit("** "), x["line"]))
        .when(x["i"] % 4 == 2, F.concat(F.lit("* : "), x["line"]))
        .otherwise(x["line"])
    )), "\n")
    return _base(spark, folder).filter(F.size(solid) > 0).select("doc_id", W.strip_list_marks(raw).alias("clean"))


@query("wiki_terminal", _BASE + r"""SELECT doc_id, rtrim(t, ' ' || chr(10)) AS clean FROM base""")
def wiki_terminal(spark, folder):
    raw = _cat(F.col("t"), " \n\n == LIÊN  KẾT ngoài ==\t\nrefs\n== Notes ==\n", F.col("t"))
    return _base(spark, folder).select("doc_id", W.cut_terminal_sections(raw).alias("clean"))


@query("wiki_entities", "SELECT doc_id, text AS clean FROM documents")
def wiki_entities(spark, folder):
    raw = F.col("text")
    for plain, entity in (("&", "&amp;"), ("e", "&#101;"), ("<", "&lt;"), ("é", "&eacute;"), ("\n", "&#xA;")):
        raw = F.replace(raw, F.lit(plain), F.lit(entity))
    rows = documents(spark, folder, "doc_id").select("doc_id", raw.alias("clean"))
    return with_unescaped(rows, "clean")


def _marked_article() -> Column:
    return _cat(
        "{{Info|{{x}}}}{| t |}\n", F.col("t"),
        "\n== Part ==\n* '''bold''' [[p|link]]\n&lt;x&gt;&nbsp;y<ref>r</ref>\n== Tham khảo ==\nrefs",
    )


_TIDY = """array_to_string(list_transform(string_split(regexp_replace(regexp_replace(
  t, '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), chr(10)), lambda l: trim(l)), chr(10))"""
_WHOLE = f"trim({_TIDY} || chr(10) || 'Part' || chr(10) || 'bold link' || chr(10) || '<x> y', ' ' || chr(10))"


@query("wiki_clean", _BASE + f"SELECT doc_id, {_WHOLE} AS text FROM base")
def wiki_clean(spark, folder):
    rows = _base(spark, folder).select("doc_id", _marked_article().alias("text"))
    return W.clean_wikitext(rows, "text")


@query("wiki_clean_audit", _BASE + f"""SELECT source, count(*) AS rows_in, count(*) AS rows_changed,
  0::BIGINT AS rows_empty, CAST(12 * count(*) AS BIGINT) AS cut_tags, CAST(7 * count(*) AS BIGINT) AS cut_tables,
  CAST(sum(length(t) + 107 - length({_WHOLE})) AS BIGINT) AS cut_total FROM base GROUP BY source""")
def wiki_clean_audit(spark, folder):
    rows = _base(spark, folder).select("source", _marked_article().alias("text"))
    audit = cleaning_audit(rows, "source")
    steps = [c for c in audit.columns if c.startswith("cut_")]
    total = sum((F.col(c) for c in steps[1:]), F.col(steps[0]))
    return audit.select("source", "rows_in", "rows_changed", "rows_empty", "cut_tags", "cut_tables",
                        total.alias("cut_total"))
