"""Small corpora with the awkward rows, and plain Python readings of the contracts."""

import os
import random

import pyarrow.parquet as pq
import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, run int, slot string"


def awkward_rows():
    """Nulls, empty, blank and long texts, repeated rows, ties and columns with clashing names."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = prose(200)
    near = base.replace(base.split()[100], "changed", 1)
    rows = [
        (1, base, "en", "a"), (2, near, "en", "a"), (3, base, None, "b"), (3, base, None, "b"), (4, None, "en", None),
        (5, "", "en", "a"), (6, " \t\n ", "en", "b"), (None, prose(30), None, None), (7, "one two", "en", "a"),
        (8, "ONE  two", "en", "a"), (9, "a b c d e f", "en", "c"), (10, "a b c d e g", "en", "c"),
        (11, "x" * 50_000, "en", "a"), (12, prose(5_000), "en", "a"), (13, base.replace(" ", "\n"), "en", "c"),
        (14, "mail bob@x.example.org or +1 (555) 010-2345, card 4111 1111 1111 1111, host 10.0.0.1, "
             "iban DE89370400440532013000, social security 123-45-6789", "en", "a"),
        (15, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "en", "a"),
        (16, "é" * 70 + " " + prose(40), "fr", "b"),
    ]
    rows += [(100 + i, prose(60 + i), "en", "hot") for i in range(25)]
    return [(i, t, lang, s, None if t is None else len(t), "x", 1, None) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(3, "source", "text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def given():
    """The smallest given documents as ``(doc_id, text, source)``."""
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    table = pq.read_table(f"{FOLDER}/documents.parquet")
    return [(r["doc_id"], r["text"], r["source"]) for r in table.to_pylist()]
