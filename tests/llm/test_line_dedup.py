"""Line dedup against a plain reading of its contract, and its perfect hash."""

import hashlib

import duckdb
import numpy as np
import pytest

from corpusloom.llm import line_dedup as ld

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string"


def key_of(line):
    key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    return key if len(key) >= 10 else None


def plain(rows, least=2):
    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if (key := key_of(line)) is not None:
                holders.setdefault(key, {})[i] = float("inf") if doc_id is None else doc_id
    out = []
    for doc_id, text in rows:
        lines, me = (text or "").split("\n"), float("inf") if doc_id is None else doc_id
        kept = [x for x in lines if (k := key_of(x)) is None or len(holders[k]) < least or me <= min(holders[k].values())]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r[:-1]) + (r[-1],))


@pytest.mark.parametrize("n", [0, 1, 2, 1_000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    found = ld.PerfectHash.build(keys)
    assert sorted(found.numbers(keys).tolist()) == list(range(len(keys)))
    again = ld.PerfectHash(found.sizes, found.bits)
    assert (again.numbers(keys) == found.numbers(keys)).all()
    if n >= 1_000:
        assert found.sizes.sum() < 5 * n  # bits


def test_lines_of_equal_hash_are_told_apart():
    lines = ld.Lines(np.array([5, 5, 9, 5], dtype=np.uint64), np.array([1, 2, 3, 1], dtype=np.uint32),
                     np.array([1, 4, 1, 2], dtype=np.uint8), np.array([70, 8, 9, 60]))
    row = ld.index_of(0, lines).to_pylist()[0]
    hashes, prints = np.array([5, 5, 5, 9, 9, 77], dtype=np.uint64), np.array([2, 1, 7, 3, 4, 1], dtype=np.uint32)
    counts, firsts = ld.probe(row, hashes, prints)
    assert counts.tolist() == [4, 3, 0, 1, 0, 0]
    assert firsts.tolist() == [8, 60, ld.NO_ID, 9, ld.NO_ID, ld.NO_ID]


ROWS = [
    (5, "A common footer\nown words of five\n  A COMMON footer \t"), (3, "a common footer\r\nshort\nshort"), (9, None), (10, ""),
    (11, "short\na common FOOTER\nshort"), (None, "a common footer\nonly without an id"), (None, "only without an id\nx"),
    (12, "éééééééééé\nÉÉÉÉÉÉÉÉÉÉ\nééééééééé"), (13, "éééééééééé\nÉÉÉÉÉÉÉÉÉÉ\nééééééééé"), (3, "a common footer\nof a repeated id"),
    (3, "a common footer\nof a repeated id"), (14, "\n\n\n"), (15, "1234567890 \n1234567890"), (16, "1234567890\n 1234567890"),
    (17, "z" * 300_000 + "\nq"), (18, "y\n" + "Z" * 300_000), (-4, "negative ids come first\na"), (19, "Negative ids come first"),
]


@pytest.fixture(params=[1 << 18, 3])
def sizes(request, monkeypatch):
    """One block and shard, and many of both."""
    monkeypatch.setattr(ld, "BLOCK_LINES", request.param)
    monkeypatch.setattr(ld, "SHARD_LINES", request.param)


def test_awkward_lines(spark, sizes):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert in_order(ld.op13(docs).collect()) == in_order(plain(ROWS))


def test_awkward_rows(spark, docs, rows):
    assert in_order(ld.op13(docs).collect()) == in_order(plain([r[:2] for r in rows]))


def test_hot_line_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ld, "BLOCK_LINES", 50)
    rows = [(i, f"the same line everywhere\nline of document {i}\nline of tens {i // 10}") for i in range(400)] + [(1_000 + i, "copied text of a group") for i in range(300)]
    got = ld.op13(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert in_order(got) == in_order(plain(rows))


def test_more_documents_needed(spark):
    rows = [(i, "held by three of them\n" + ("held by two of them" if i < 2 else "own line only here")) for i in range(3)]
    got = {r["row"]["doc_id"]: r["kept"] for r in ld.cleaned(spark.createDataFrame(rows, SCHEMA), least_documents=3).collect()}
    assert got == {0: rows[0][1], 1: "held by two of them", 2: "own line only here"}


def test_columns_pass_through(spark):
    schema = "row string, doc_id long, lost int, text string, kept string, mark long, block long, shard int, `n.lines` int, n_lines string"
    rows = [("r", i, 1, "a line that repeats\nb", "k", 2, 3, 4, 5, "n") for i in (1, 2)] + [("r", 3, 1, None, "k", 2, 3, 4, 5, "n")]
    got = ld.drop_lines(spark.createDataFrame(rows, schema))
    assert got.columns == ["row", "doc_id", "lost", "text", "kept", "mark", "block", "shard", "n.lines", "n_lines"]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, "a line that repeats\nb"), (2, "b"), (3, None)]
    assert {tuple(r)[4:] for r in got.collect()} == {("k", 2, 3, 4, 5, "n")}


def test_empty_table(no_docs):
    assert ld.op13(no_docs).collect() == []


def test_sql_states_the_same(spark, given):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = ld.op13(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    assert in_order(got) == in_order(con.execute(ld.SQL).fetchall()) == in_order(plain([g[:2] for g in given]))
