"""Phrase collocations against a plain reading of their contract, and the quicksort against counting."""

import gc
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as each
from hypothesis import settings
from hypothesis import strategies as st

from corpusloom.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, __part int, phrase string, n long, rank int"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, longest=3, least=10, contained=50, reported=2_000):
    counts = {}
    for text, lang in rows:
        of = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", low(text or "")):
            words = re.findall(r"[^ \t]+", piece)
            of.update(tuple(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        longer = Counter()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], c)
        found = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= contained * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def result(rows):
    return sorted(map(tuple, rows.collect()))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, 1, "p", 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(parts)


suffix_lists = st.lists(st.tuples(st.integers(1, 4), st.integers(0, 4), st.integers(0, 4), st.integers(1, 9)), max_size=60)


@each(suffix_lists, st.integers(1, 30), st.sampled_from([0, 1, 5, 2_048]))
@settings(max_examples=200, deadline=None)
def test_quicksort_counts_phrases(suffixes, least, small):
    suffixes = [(a, b, c if b else 0, w) for a, b, c, w in suffixes]
    words = np.array([s[:3] for s in suffixes], dtype=np.int32).reshape(-1, 3).T
    got = co.multikey_quicksort(words, np.array([s[3] for s in suffixes], dtype=np.int64), least, small)
    for size, (pointers, counts) in enumerate(got, 2):
        expected = Counter()
        for s in suffixes:
            if s[size - 1]:
                expected[s[:size]] += s[3]
        phrases = [tuple(words[:size, p].tolist()) for p in pointers]
        assert len(set(phrases)) == len(phrases)
        assert dict(zip(phrases, counts.tolist())) == {p: c for p, c in expected.items() if c >= least}


def test_sorted_and_reversed_suffixes_do_not_stack_up():
    n = 50_000
    ids = np.arange(1, n + 1, dtype=np.int32)
    for order in (ids, ids[::-1]):
        got = co.multikey_quicksort(np.stack([order, order, order * 0]), np.full(n, 10), 10)
        assert len(got[0][0]) == n and len(got[1][0]) == 0


def test_chunks_end_with_pieces(monkeypatch):
    monkeypatch.setattr(co, "CHUNK_BYTES", 12)
    texts = [b"One two, three", b"", b"a-very-long-piece-without-any-end. x", b"\tY\rz"]
    whole = co.CUT.join(texts).translate(co._TABLE)
    assert co.CUT.join(co.chunks(texts)) == whole
    assert {len(c) <= 12 or co.CUT not in c for c in co.chunks(texts)} == {True}


PROSE = ["New York City is big; new york city", "in new york, in NEW YORK", "a b a b a b a b", "x\ty  z! x y z", None, "", " \t ",
         "Été çà. Été çà", "one", "hot pair hot pair hot pair"]


@pytest.mark.parametrize("runs", [None, 64])
def test_awkward_texts(spark, runs, monkeypatch):
    if runs:
        monkeypatch.setattr(co, "RUN_TOKENS", runs)
        monkeypatch.setattr(co, "SHARD_TOKENS", 16)
        monkeypatch.setattr(co, "CHUNK_BYTES", 100)
    rows = [(t, lang) for t in PROSE for lang in ("en", None, "und", "") for _ in range(4)]
    rows += [("long " * 300 + "tail, " + "w " * 200, "en"), ("v" * 20_000, "en")]
    assert result(co.op12(frame(spark, rows))) == plain(rows)


def test_awkward_rows(spark, docs, rows):
    assert result(co.best(co.collocations(docs, least=3))) == plain([(r[1], r[2]) for r in rows], least=3)


def test_a_run_is_cut_inside_a_piece(spark, monkeypatch):
    monkeypatch.setattr(co, "RUN_TOKENS", 32)
    rows = [(" ".join(f"w{i % 7}" for i in range(500)), "en")]
    assert result(co.op12(frame(spark, rows, 1))) == plain(rows)


def test_only_pairs(spark):
    rows = [(t, "en") for t in PROSE for _ in range(6)]
    assert result(co.best(co.collocations(frame(spark, rows), longest=2))) == plain(rows, longest=2)


def test_the_best_of_each_lang(spark):
    rows = [(" . ".join(f"a{i} b{i}" for i in range(40)), lang) for lang in ("en", "de") for _ in range(12)]
    got = result(co.best(co.collocations(frame(spark, rows)), reported=7))
    assert got == plain(rows, reported=7) and len(got) == 14


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_000)], "a long, l long, r long")
    a, left, right = rows.first()
    wide = {c: co.F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")}
    score = co.F.call_function("div", (co.F.lit(1_000_000) * wide["a"] * wide["a"]).cast("decimal(38,0)"),
                               (wide["l"] * wide["r"]).cast("decimal(38,0)"))
    assert rows.select(score).first()[0] == 1_000_000 * a * a // (left * right)


def test_names_that_collide_take_another_seed(spark, monkeypatch):
    real = co.words_of
    seeds = []

    def words_of(docs, seed):
        seeds.append(seed)
        table = real(docs, seed)
        return table.withColumn("name", co.F.lit(5).cast("long")) if seed == 0 else table

    monkeypatch.setattr(co, "words_of", words_of)
    assert co.named_words(frame(spark, [("a b", "en")]))[1] == 1 and seeds == [0, 1]


def test_empty_table(no_docs):
    assert co.op12(no_docs).collect() == []


def test_sql_states_the_same(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = result(co.op12(spark.read.parquet(f"{folder}/documents.parquet")))
    assert got == sorted(con.execute(co.SQL).fetchall())
    assert got == plain(con.execute("SELECT text, lang FROM documents").fetchall())


def test_a_run_holds_little(spark):
    """A task that fills a run of words holds few numbers a word."""
    words, seen = 400_000, []

    class Rows:
        def mapInArrow(self, deal, schema):
            seen.append(deal)

    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 20_000, words).tolist())
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(co, "_texts", lambda docs: docs)
        patch.setattr(co, "CHUNK_BYTES", 1 << 17)
        co.suffixes(Rows(), 0, 2, 3)
        gc.collect()
        tracemalloc.start()
        counted = sum(np.frombuffer(r["counts"], dtype=np.uint32).sum() for b in seen[0](iter([batch])) for r in b.to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert counted == words - 1
    assert peak < 110 * words  # 83; 138 with every array of a run kept
