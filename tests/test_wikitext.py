import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import wiki_queries
from corpusloom.functions import wikitext as W

GOLDEN = [
    (W.resolve_links, "[[a|b]]", "b"), (W.resolve_links, "[[a]]", "a"),
    (W.resolve_links, "[[Tập_tin:x.jpg|thumb]]", ""), (W.resolve_links, "[[THỂ LOẠI:x]]y", "y"),
    (W.resolve_links, "[[a|b [[c]] d]]", "b [[c]] d"), (W.resolve_links, "[[abcd", "ab"),
    (W.resolve_links, "[[", ""), (W.resolve_links, "[[x", ""), (W.resolve_links, "a]]b", "a]]b"),
    (W.drop_templates, "x{{a{{b}}c}}y", "xy"), (W.drop_templates, "x}}y", "xy"), (W.drop_templates, "x{{y", "x"),
    (W.drop_tables, "a{| x {| y |} z |}b", "ab"), (W.drop_tables, "a|}b", "a|}b"),
    (W.resolve_brackets, "[http://u label]", "//u label"), (W.resolve_brackets, "[http://u]", "//u"),
    (lambda c: W.resolve_brackets(c, "fixed"), "[http://u label]", "label"),
    (lambda c: W.resolve_brackets(c, "fixed"), "[http://u]", ""),
    (W.resolve_brackets, "[wikt:word|label]", "label"), (W.resolve_brackets, "[wikt:word]", "word"),
    (W.resolve_brackets, "[fr:Article]", ""),
    (W.strip_list_marks, "; Apple : A fruit", "Apple: A fruit"), (W.strip_list_marks, "* : text", "text"),
    (W.strip_list_marks, "  ** a\r\nb\n", "a\nb"), (W.strip_list_marks, "plain\nlines", "plain\nlines"),
    (W.unwrap_headers, "== Foo == ", "Foo"),
    (W.cut_terminal_sections, "body\n== Tham khảo ==\nrefs", "body"),
    (W.cut_terminal_sections, "body\n\nREFERENCE\nrefs", "body"),
    (W.cut_terminal_sections, "my references here", "my references here"),
    (W.strip_tags, "a<references>b</ref>c<body>d", "ac d"),
    (W.drop_orphan_rows, "|- x\na\n | y\n|z", "a\n|z"),
]


@pytest.mark.parametrize("fn, raw, want", GOLDEN)
def test_golden(column, fn, raw, want):
    assert column(fn, [raw]) == [want]


def regions(text, opener, closer):
    """Plain statement of the scan: (kind, piece) with kind out / stray / in."""
    depth, i = 0, 0
    while i < len(text):
        two = text[i:i + 2]
        if two == opener:
            depth += 1
            yield "in", two
            i += 2
        elif two == closer:
            yield ("in" if depth else "stray"), two
            depth = max(depth - 1, 0)
            i += 2
        else:
            yield ("in" if depth else "out"), text[i]
            i += 1


def link_model(text):
    """The rule on the pieces between delimiters: an opener and its matching
    closer, found by recursion, give way to what the link shows."""
    pieces = re.split(r"(\[\[|\]\])", text)

    def end_of(k):
        if k >= len(pieces):
            return 0
        if pieces[k] == "]]":
            return k + 1
        if pieces[k] == "[[":
            nested = end_of(k + 1)
            return end_of(nested) if nested else 0
        return end_of(k + 1)

    def shown(inner):
        label = inner.split("|", 1)[-1]
        return "" if inner.lower().replace("_", " ").startswith(("file:", "image:")) else label

    def render(k):
        if k >= len(pieces):
            return ""
        if pieces[k] != "[[":
            return pieces[k] + render(k + 1)
        end = end_of(k + 1)
        if end:
            return shown("".join(pieces[k + 1:end - 1])) + render(end)
        return shown("".join(pieces[k + 1:])[:-2])  # open to the end, less the width of a closer

    return render(0)


def noise(alphabet, seed, n=600):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(18))) for _ in range(n)]


def test_regions_against_scan(column):
    texts = noise("{}|a\n", 1)
    want = ["".join(p for k, p in regions(t, "{{", "}}") if k == "out") for t in texts]
    assert column(W.drop_templates, texts) == want
    want = ["".join(p for k, p in regions(t, "{|", "|}") if k != "in") for t in texts]
    assert column(W.drop_tables, texts) == want
    texts = noise(["[", "[[", "]", "]]", "|", "a", "File:"], 2)
    assert column(W.resolve_links, texts) == [link_model(t) for t in texts]


def test_whole_chain_and_lengths(spark):
    raw = "'''A''' &amp;&nbsp;[[b|c]] {{x}}\n\n\n\n* {{f}}: d <ref>r</ref>\n== Ghi chú ==\nz"
    df = spark.createDataFrame([(raw,), (None,)], "text string")
    rows = W.clean_wikitext(df, lengths="n").collect()
    assert [r["text"] for r in rows] == ["A & c\n\nd", ""]
    assert rows[0]["n"][0] == len(raw) and rows[0]["n"][-1] == len("A & c\n\nd")
    assert len(rows[0]["n"]) == len(W.STEPS) + 1


def test_namespaces_are_lower_cased_once(column):
    raw = ["[[TẬP_TIN:x|y]]a", "[[File x|File: y]]", "[[a:b|c]]", "[[Media:x]]", "{{|}}{|a|}{{|", "a]]]b[[[c]d]]"]
    assert column(W.resolve_links, raw) == ["a", "File: y", "c", "", "{{|}}{|a|}{{|", "a]]]b[c]d"]
    assert str(W._link_label(F.col("t"))).count("lower(") == 1


def test_tags_of_any_case(column):
    raw = ["<ſpan>x</ſpan><REF a/ >y<Ref>z</rEF>", "<DIV>a<!-- <b> -->b</Div><q>", "''''a'''''b----- --"]
    assert column(W.strip_tags, raw[:2]) == [" x y", " ab "]
    assert column(W.drop_emphasis, raw[2:]) == ["'ab --"]


def bracket_model(text):
    """The five rules in their order: interwiki with label, between languages, interwiki, external with label, external."""
    for pattern, to in ((r"\[([a-z][a-z0-9_-]*):([^\]\|]*)\|([^\]]+)\]", r"\3"), (r"\[[a-z]{2}:[^\]]+\]", ""), (r"\[[a-z][a-z0-9_-]*:([^\]]+)\]", r"\1"),
                        (r"\[https?://[^\s\]]+\s+([^\]]+)\]", r"\1"), (r"\[https?://[^\]]+\]", "")):
        text = re.sub(pattern, to, text)
    return text


def list_model(text):
    out = []
    for line in text.splitlines():
        bare = line.lstrip()
        m = re.match(r"([*#;:]+)\s?", bare)
        if m:
            body = bare[m.end():]
            if ";" in m.group(1) and ": " in body:
                term, _, meaning = body.partition(": ")
                body = term.strip() + (": " + meaning.strip() if meaning.strip() else "")
            line = re.sub(r"^[\s:]+", "", body)
        out.append(line)
    return "\n".join(out)


def test_queries_clean_the_markup_of_the_documents(spark, tmp_path):
    """The documents come with all their characters, and their own markup is cleaned with that put around them."""
    texts = ["it's a-b; c: d = e * f # g_h [i] <j> & k", "[http://u own] [fr:X] [wikt:w|own] '''own''' ---- __OWN__\n* own\n ;t : own\nend",
             "own -- [n] ''x''\n== Notes ==\n* gone", "* a\n# b\n: c\n; d : e\n** f: g"]
    rows = [(i, "src0", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def got(name, column="clean"):
        return [r[column] for r in sorted(getattr(wiki_queries, name)(spark, str(tmp_path)).collect())]

    def marked(text, each):
        return text.replace("\n", each + "\n")

    assert got("wiki_single_brackets", "faithful") == [
        bracket_model(marked(t, "[wikt:w|label] [wikt:word][fr:Article] [http://u l]") + "[https://u]") for t in texts]
    assert got("wiki_emphasis") == [re.sub(r"__[A-Z_]+__", "", re.sub(r"'''|''|----+", "", "__NOTOC__" + marked(t, "'''b'''''i''") + "----__TOC__-----x--"))
                                    for t in texts]
    forms = (" ; term : ", "** ", "* : ", "")
    assert got("wiki_lists") == [list_model("\n".join(forms[i % 4] + line for i, line in enumerate(t.split("\n"), 1))) for t in texts]
    assert got("wiki_terminal") == [texts[0], texts[1], "own -- [n] ''x''", texts[3]]
