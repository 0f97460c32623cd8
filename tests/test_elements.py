"""Containers of pages against a tree built with the standard library's parser."""

import random
from html.parser import HTMLParser

import pytest

from corpusloom.functions import elements as E
from corpusloom.functions import verse as V
from corpusloom.operators import pages as P


class Tree(HTMLParser):
    """Outer HTML of the outermost elements that ``wanted(tag, attributes)`` picks."""

    def __init__(self, html, wanted):
        super().__init__(convert_charrefs=False)
        self.html, self.wanted, self.open, self.found, self.at, self.begin = html, wanted, [], [], None, 0
        lines = [0]
        for line in html.split("\n"):
            lines.append(lines[-1] + len(line) + 1)
        self.lines = lines
        self.feed(html)
        self.close()
        if self.at is not None:
            self.found.append(html[self.begin:])

    def place(self):
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        hit = self.at is None and self.wanted(tag, dict(attrs))
        if tag in E.VOID:
            if hit:
                self.found.append(self.get_starttag_text())
            return
        if hit:
            self.at, self.begin = len(self.open), self.place()
        self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        if self.at is None and self.wanted(tag, dict(attrs)):
            self.found.append(self.get_starttag_text())

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        place = len(self.open) - 1 - self.open[::-1].index(tag)
        self.open = self.open[:place]
        if self.at is not None and place <= self.at:
            end = self.html.index(">", self.place()) + 1 if place == self.at else self.place()
            self.found.append(self.html[self.begin:end])
            self.at = None


def has_class(tag, name):
    return lambda t, attrs: t == tag and name in (attrs.get("class") or "").split()


HARD = [
    'a<!-- </div> --><div class="c">x<!-- </div> -->y</div>z',
    '<div class="c"><script>var a = "<div>";</script>x</div><div class="c">2</div>',
    '<div class=c><style>p > a { content: "</div>" }</style>x</div>',
    '<div class="c" title="a > b </div>">x<div title=\'</div>\'>y</div>z</div>w',
    '<div title=\' class="c" \'>no</div><div class="b c d">yes</div>',
    '<div class="c"><br><img src="x"><p>open<p>open too</div>after',
    '<section><div class="c">ends with the section</section>after</div>',
    '<div class="c">ends with the page <b>x',
    '<div class="c">a</span></p>b</div>', '<div class="c"/>x<div class="c">y</div>', '<DIV CLASS="c">A<Div>b</DIV>c</div >d',
    "<div class='c'>a</div><p class=\"c\"><div class=c>b</div></p>", '<div data-class="c">n</div><div\nclass = "c"\n>y</div>',
    '<!-- <div class="c">old</div> --><div class="c">new</div>', '<script>document.write("<div class=\'c\'>no</div>")</script>',
    '<div class="c"><script>unclosed <div>', "<!doctype html><div class=c><!-- unclosed </div>", '<div class="cc">n</div>', "", "no tags",
    '<div class="c"><a href=x?a=1&b="2">t</a></div>', '<div class="c"><ul><li>1<li>2</ul><table><tr><td>x</table></div>end',
]


@pytest.mark.parametrize("k", range(len(HARD)))
def test_containers(column, k):
    blocks = lambda c: E.element_blocks(c, E.start_tag("div", "class", E.class_value("c")))
    assert column(blocks, [HARD[k]]) == [Tree(HARD[k], has_class("div", "c")).found]


def test_random_pages(column):
    rng = random.Random(8)
    parts = ["<div>", "<div class='c'>", "</div>", "<p>", "</p>", "<span class=c>", "</span>", "<br>", "<br/>", "<hr class='c'>", "t", " u\n",
             "<!-- </div> -->", "<script>'<div class=c>'</script>", "<a title='</div>'>", "</a>", "<style></p></style>", "<section>", "</section>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)]
    for tag in ("div", "span", "hr"):
        blocks = lambda c: E.element_blocks(c, E.start_tag(tag, "class", E.class_value("c")))  # noqa: E731, B023
        assert column(blocks, pages) == [Tree(p, has_class(tag, "c")).found for p in pages]


def test_long_pages(column):
    """Many attributes, elements that never close, and one long script."""
    pages = ["<div " + " ".join(f'a{i}="{i}>"' for i in range(5_000)) + ' class="c">x</div>', "<div class=c>" + "<p>t" * 3_000 + "</div>e",
             "<div class=c><script>" + "<div>" * 20_000 + "</script></div>", "<div class=c>" + "a='" * 20_000 + "</div>"]
    blocks = lambda c: E.element_blocks(c, E.start_tag("div", "class", E.class_value("c")))
    assert column(blocks, pages) == [[p.removesuffix("e")] for p in pages]


def test_attributes(column):
    tokens = ['<a href="x">', "<a title='href=\"no\"' href='y'>", "<A HREF=z>", "<a>", '<a data-href="n">', '<a\nhref = "a>b" id=1>', "<area href=q>"]
    assert column(lambda c: E.attribute_of(c, "a", "href"), tokens) == ["x", "y", "z", "", "", "a>b", ""]
    assert column(lambda c: c.rlike(E.start_tag("a", "href", "[xyz]")), tokens) == [True, True, True, False, False, False, False]


def test_depth(column):
    page = "<h4><span><a>1</a></span><a>2</a><b></b><a>3</a></h4><a>4</a>"
    assert column(lambda c: E.element_blocks(c, E.start_tag("a"), depth=1), [page]) == [["<a>2</a>", "<a>3</a>"]]


def test_list_items_among_comments_and_scripts(spark):
    item = '<div class="list-item">{}<h4 class="list-item-header">{}<a href="{}">{}</a></h4>{}</div>'
    old = '<!-- <h4 class="list-item-header"><a href="/old">old</a></h4> -->'
    page = (
        '<script>var t = \'<div class="list-item"><h4 class="list-item-header"><a href="/s">s</a></h4></div>\';</script>'
        + item.format(old, '<span title="</h4>"></span>', "/1", "one", '<p><a title="x" href="/author-7">A</a></p>')
        + item.format("", "<span><a href='/no'>nested</a></span>", "/2", "<!-- x -->two <b>b</b>", '<p title=\'href="/author-1"\'><a href="/b">n</a></p>')
        + "<!--" + item.format("", "", "/3", "three", "") + "-->" + item.format("", "", "", "no url", "")
        + '<div class="list-item"><h4 class="list-item-header"><b><a href="/4">not a child</a></b></h4></div>'
    )
    rows = P.listing_items(spark.createDataFrame([(1, page)], "page_id long, html string")).orderBy("item_ord").collect()
    assert [(r["title"], r["url"], r["author"]) for r in rows] == [("one", "/1", "A"), ("two b", "/2", "Unknown")]


def test_element_text(spark):
    html = "<div class=small> a <!-- no --><b title='>'>b</b><script>var x = '<i>';</script> &amp; c</div>"
    assert V.with_element_text(spark.createDataFrame([(html,)], "h string"), "h", "t").first()["t"] == "ab& c"


def test_visible(column):
    assert column(E.visible, ["a<!-- b --><SCRIPT x='>'>c</script >d<style>e</style><!doctype f>g<p>"]) == ["adg<p>"]


def test_first_container_of_a_hard_page(column):
    page = "<!-- <div class='poem-content'>no</div> --><div class='poem-content'>x<script>'</div>'</script><div>y</div></div>z"
    assert column(lambda c: V.first_container(c, "div", "poem-content"), [page, "<article>a<!-- </article> -->b</article>"]) == [
        "<div class='poem-content'>x<script>'</div>'</script><div>y</div></div>", None]
    assert column(lambda c: V.first_container(c, "article"), ["<article>a<!-- </article> -->b</article>c"]) == ["<article>a<!-- </article> -->b</article>"]
