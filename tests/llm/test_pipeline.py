"""The pipeline against plain Python on the smallest tables, and its stages on awkward rows."""

import os
import re
from collections import Counter, defaultdict

import pytest
from test_free import brute_components

import corpus_pipeline
from corpusloom.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


def test_run(spark, given):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    bad = {r["doc_id"] for r in toxicity.op4(docs, labels).collect() if r["predicted"]}
    left, seen = [], set()
    for i, t, s in sorted(given):
        same = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if i not in bad and same not in seen:
            seen.add(same)
            left.append((i, t, s))
    alone = {i for (i, _, c), _ in brute_components(left).items() if i == c}
    texts = {i: t for i, t, _ in left if i in alone}
    pieces = defaultdict(Counter)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r["doc_id"]][r["piece"], r["text"]] += 1
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        assert len(set(found.values())) == 1  # all pieces of a document have the same number of turns
        assert "".join(t for _, t in sorted(found)) == texts[i]


def test_stages_on_awkward_rows(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for start in (docs, no_docs):
        now = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert now.columns == docs.columns
            now.write.parquet(path := str(tmp_path / f"{start is docs}-{k}"))
            now = spark.read.parquet(path)
        assert (now.count() > 0) == (start is docs)


INTERNAL = ["row", "__run", "__sha", "__size", "__second", "__norm", "__n", "__keep", "__nth", "__slot", "__order", "__lane", "__place",
            "__epoch", "__toxicity", "score", "class", "mark", "label", "id", "of", "keep_id", "nth", "a.b"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:4]])
def test_columns_named_like_the_operators_own(spark, stage, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    rows = [(i, f"text number {i} of some words more", "s", *[f"{c}{i}" for c in INTERNAL]) for i in range(3)]
    got = dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame(rows, schema), str(tmp_path))
    assert sorted(map(tuple, got.collect())) == rows and got.columns == ["doc_id", "text", "source", *INTERNAL]
