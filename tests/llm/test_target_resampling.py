"""Importance resampling against a plain reading of its contract."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as each
from hypothesis import settings
from hypothesis import strategies as st

from corpusloom.llm import target_resampling as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs, target):
    s, t = np.zeros(10_000, dtype=int), np.zeros(10_000, dtype=int)
    for _, text in docs:
        np.add.at(s, features(text)[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, len(words)])
    order = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(order[:25 * len(order) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@each(st.lists(st.text(alphabet="aB1é \n\0.-ü" + "Z"), max_size=6), st.integers(1, 3))
@settings(max_examples=100, deadline=None)
def test_features_of_a_block(texts, longest):
    if not texts:
        return
    _, runs = tr.block_features([t.encode() for t in texts], longest, 10_000)
    got = sorted((int(i), int(b)) for text, bucket in runs for i, b in zip(text, bucket))
    assert got == sorted((i, b) for i, t in enumerate(texts) for b in features(t, longest)[1])


def test_crc_of_long_words():
    texts = ["a" * n + " " + "é" * n + " b" for n in (1, 31, 32, 33, 63, 64, 65, 129, 5_000)]
    _, runs = tr.block_features([t.encode() for t in texts], 2, 10_000)
    got = sorted((int(i), int(b)) for text, bucket in runs for i, b in zip(text, bucket))
    assert got == sorted((i, b) for i, t in enumerate(texts) for b in features(t)[1])


def test_blocks_hold_every_row(monkeypatch):
    monkeypatch.setattr(tr, "BLOCK_BYTES", 10)
    texts = pa.array(["abc", None, "x" * 50, "", "defgh", "ij"])
    found = list(tr.text_blocks(texts))
    assert [b for _, run in found for b in run] == [b"abc", b"", b"x" * 50, b"", b"defgh", b"ij"]
    assert all(sum(map(len, run)) <= 10 or len(run) == 1 for _, run in found)


def test_awkward_rows(spark, docs, rows):
    target = [rows[0][1], None, "w1 w2 w3 w4", rows[-1][1]]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = tr.op11(docs, benchmark).collect()
    assert in_order(got) == in_order(plain([(r[0], r[1]) for r in rows], target))


def test_ties_go_to_smaller_ids(spark):
    rows = spark.createDataFrame([(i, 20, 39, 0, 5) for i in (9, 3, None, 7)] + [(1, 20, 39, 0, 4), (2, 19, 37, 0, 99)],
                                 "doc_id long, n_words int, n_features long, weight long, score long")
    got = {r["doc_id"]: r["rank"] for r in tr.draw(rows, percent=80).collect()}
    assert got == {3: 1, 7: 2, 9: 3, None: 4, 1: None, 2: None}


def test_empty_tables(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert tr.op11(no_docs, none).collect() == []
    got = tr.op11(docs, none).collect()
    assert in_order(got) == in_order(plain([(r[0], r[1]) for r in rows], []))


def test_sql_states_the_same(spark, given, tmp_path):
    folder = "/root/testdata/sf0.001"
    got = tr.op11(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")).collect()
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert in_order(got) == in_order(con.execute(tr.SQL).fetchall())
    assert in_order(got) == in_order(plain([(i, t) for i, t, _ in given], [t for t, in con.execute("SELECT text FROM benchmark").fetchall()]))


@pytest.mark.parametrize("longest", [1, 3])
def test_other_run_lengths(spark, docs, rows, longest):
    counts = tr.bucket_counts(docs, longest)
    expected = np.zeros(10_000, dtype=int)
    for r in rows:
        np.add.at(expected, features(r[1], longest)[1], 1)
    assert (counts == expected).all()
