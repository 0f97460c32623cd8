import random
import sys
import unicodedata
from decimal import ROUND_HALF_EVEN, Decimal

import pytest

from corpusloom.functions import text as X
from corpusloom.functions.entities import with_unescaped
from corpusloom.functions.urls import article_url

ALPHABET = list("ab \t\n\r\x0b\x0c\x1c\x1e\x1f\x85\xa0é　  .") + ["\r\n", "ế"]


def noise(seed, n=300, size=14):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(size))) for _ in range(n)]


def test_white_space_is_pythons():
    assert set(X.WS_CHARS) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


@pytest.mark.parametrize("name", ["strip", "lstrip", "rstrip"])
def test_strip(column, name):
    texts = noise(1)
    assert column(getattr(X, name), texts) == [getattr(t, name)() for t in texts]


def test_split(column):
    texts = noise(2)
    assert column(X.split_lines, texts) == [t.splitlines() for t in texts]
    assert column(X.split_words, texts) == [t.split() for t in texts]
    paragraphs = [[p.strip() for p in t.split("\n\n") if p.strip()] for t in texts]
    assert column(X.split_paragraphs, texts) == paragraphs
    assert column(X.strip_lines, texts) == ["\n".join(x.strip() for x in t.splitlines()).strip() for t in texts]


def test_nfc_and_entities(spark):
    rows = ["abc", "é", "ậ", "한", " ́x", "", None, ";"]
    df = X.with_nfc(spark.createDataFrame(list(enumerate(rows)), "i int, t string"), "t", "n")
    got = {r["i"]: r["n"] for r in df.collect()}
    assert got == {i: unicodedata.normalize("NFC", t or "") for i, t in enumerate(rows)}
    df = with_unescaped(spark.createDataFrame([("&lt;&eacute;&#x2014;&nbsp;&bogus;",), (None,)], "t string"), "t")
    assert [r[0] for r in df.collect()] == ["<é—\xa0&bogus;", None]


def python_size(n):
    """The largest unit that fits, from the number's bits; two decimals of the exact quotient."""
    step = min(max(n.bit_length() - 1, 0) // 10, 4)
    exact = Decimal(n) / Decimal(2 ** (10 * step))
    return f"{exact.quantize(Decimal('0.01'), ROUND_HALF_EVEN)} {['B', 'KB', 'MB', 'GB', 'TB'][step]}"


def test_format_size(column):
    sizes = [0, 1, 1023, 1024, 1152, 1536, 1664, 2**20 - 1, 2**20, 2**30 + 2**22, 2**40, 5 * 2**41 + 123456789]
    sizes += [random.Random(3).randrange(2**45) for _ in range(200)]
    assert column(lambda c: X.format_size(c.cast("bigint")), list(map(str, sizes))) == list(map(python_size, sizes))


def test_python_round(column):
    values = [0.03125, 0.00015, 2.675, 0.5, 1 / 3]
    assert column(lambda c: X.python_round(c.cast("double"), 4), list(map(repr, values))) == [round(v, 4) for v in values]


def test_word_count_prefix_perplexity(column):
    assert column(X.word_count, ["a, b-c “d” e", "", "(x)"]) == [5, 0, 1]
    assert column(lambda c: X.remove_prefix(c, "thơ:\n"), ["thơ:\n a\n", "thơ: a"]) == ["a", "thơ: a"]
    assert column(lambda c: X.perplexity(c.cast("double")), ["0.0", "1000.0"]) == [1.0, float("inf")]


def test_article_url(column):
    from urllib.parse import quote

    titles = ["Việt Nam", "a/b:c ~*+()!'\"%", "x_y-z.1", "日本"]
    want = ["https://h/" + quote(t.replace(" ", "_"), safe="/:") for t in titles]
    assert column(lambda c: article_url(c, "https://h/"), titles) == want
