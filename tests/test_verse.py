import json
import random
import re

from pyspark.sql import functions as F

from corpusloom.functions import verse as V
from corpusloom.functions.text import WS_CHARS
from corpusloom.operators import pages as P
from corpusloom.plans import verse_corpus as C


def test_split_and_notes(column):
    split = lambda c: F.to_json(V.poems_of_page(V.break_tags(c), F.lit("D")))
    assert column(split, ["x<b>T1</b>\n\nl1\n\n<b>T2</b>\n\nm1", "<b>t</b> x"]) == [
        '[{"title":"T1","content":"l1"},{"title":"T2","content":"m1"}]', '[{"title":"D","content":"<b>t</b> x"}]',
    ]
    assert column(V.clean_source_note, ["Book X Bình luận nhanh 3", "a BÌNH LUẬN NHANH\nb", None]) == ["Book X", "a \nb", ""]


def test_plain_verse(spark):
    df = spark.createDataFrame([("a<i>note</i>b<br/>&lt;p&gt;<P>c</p>&nbsp; d",)], "t string")
    assert V.with_plain_verse(df, "t").first()[0] == "ab\n<p>c d"


def test_containers(column):
    page = '<div class="a">q</div><div class="x poem-content y">a<div>b</div>c</div>d<div class=poem-content>z</div>'
    first = lambda c: V.first_container(c, "div", "poem-content")
    assert column(first, [page, '<div class="poem-contents">x</div>', "<DIV Class='poem-content'>a"]) == [
        '<div class="x poem-content y">a<div>b</div>c</div>', None, "<DIV Class='poem-content'>a",
    ]


def test_total_pages_and_cap(column):
    pages = ["tổng số 12 trang", "Trang 1 / 7", '<a href="?Page=3">3</a><a class="u" href="?q&Page=11">', "none"]
    assert column(V.total_pages, pages) == [12, 7, 11, 1]
    assert column(lambda c: V.capped_pages(V.total_pages(c)), pages) == [10, 7, 10, 1]


def test_stanzas(spark):
    good = "“a b c d e,\n f  g h i j-\n k l m n o\np q, r s t;"
    rows = [(1, good + "\n \n" + "a b c\nd\ne\nf"), (2, "a b c d e f\n1 2 3 4 5\n1 2 3 4 5\n1 2 3 4 5\n\n" + good), (3, "a\nb\nc")]
    pages = spark.createDataFrame(rows, "ord long, content string")
    got = C.valid_stanzas(pages).orderBy("ord").collect()
    text = "a b c d e\nf g h i j\nk l m n o\np q, r s t"
    assert [(r["ord"], r["stanza_ord"], r["text"]) for r in got] == [(1, 0, text), (2, 1, text)]
    assert [(r["ord"], r["text"]) for r in C.distinct_stanzas(C.valid_stanzas(pages)).collect()] == [(1, text)]


def test_verse_corpus_from_raw_pages(spark):
    html = "<div class='poem-content'><b>T</b><br><br>" + "<br>".join(["a b c d e"] * 4) + "</div><div class=small>N</div>"
    pages = spark.createDataFrame([("u1", html), ("u2", "<p>no container</p>"), ("u3", html + "Xác nhận không phải máy")],
                                  "url string, html string")
    meta = spark.createDataFrame([("m", "u1", None), ("m", "u2", "A"), ("m", "u3", "A")], "title string, url string, author string")
    poems = P.verse_pages(pages, meta)
    row = poems.first()
    assert poems.count() == 1
    assert (row["title"], row["source"], row["url"], row["author"]) == ("T", "N", "u1", "Unknown")
    stanzas = C.verse_corpus(poems.withColumn("ord", F.col("piece").cast("long"))).collect()
    assert [r["text"] for r in stanzas] == ["\n".join(["a b c d e"] * 4)]


def test_merged_listings(spark):
    first = spark.createDataFrame([(0, 1, 0, "t", "u1", "A"), (1, 1, 0, "t2", "u1", "B")],
                                  "listing_ord int, page int, item_ord int, title string, url string, author string")
    second = spark.createDataFrame([(0, 1, 0, "t", "u1", "A", "S"), (0, 1, 1, "n", "u2", "Unknown", "S")],
                                   "listing_ord int, page int, item_ord int, title string, url string, author string, searched string")
    got = {r["url"]: (r["author"], r["phase"]) for r in P.merged_listings(first, second).collect()}
    assert got == {"u1": ("A", 1), "u2": ("S", 2)}


def test_lines_are_cleaned_as_one_by_one(column):
    """Whole-text patterns against the steps line by line, and no pattern per line."""
    rng = random.Random(3)
    pool = ["a", "b", "é", " ", " ", "\n", "\n", "\n \n", "\t", '"', "“", "’", ",", "-", ":", "\x1e", "\x85", " ", "\xa0", "\r"]

    def line(t):
        t = " ".join(t.split())
        return re.sub("[\"“”‘’:;,\\-–—]+$", "", re.sub("^[\"“”‘’]+", "", t).strip()).strip()

    texts = ["", " ", '" "x" "\n,- -\n\n" \n\n', *["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(500)]]
    space = "[" + "".join(map(re.escape, WS_CHARS)) + "]"
    expected = [[[x for x in map(line, s.strip(WS_CHARS).split("\n")) if x] for s in re.split(rf"\n{space}*\n", t.strip(WS_CHARS))] for t in texts]
    assert [json.loads(x) for x in column(lambda c: F.to_json(V.stanza_lines(c)), texts)] == expected
    assert "regexp_replace(namedlambda" not in str(V.stanza_lines(F.col("t"))).replace("trim(", "")


def test_words_of_lines(column):
    texts = ["a b\nc d", "a b\nc", "a, b\n“c”-d", "a b\n\nc d", "", "a b\n", "(a)\xa0b!"]
    assert column(lambda c: V.has_line_words(c, 2).cast("string"), texts) == ["true", "false", "true", "false", "false", "false", "true"]
    assert column(lambda c: V.has_line_words(c, 0).cast("string"), ["", "a", " \n!"]) == ["true", "false", "true"]
