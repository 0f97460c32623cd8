"""Readers, writers, ingest, and the jobs that run from files to files."""

import json
import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators.bpe import Vocabulary
from corpusloom.operators.order import source_of
from corpusloom.plans.corpus_dedup import build_dedup_corpus
from corpusloom.plans.training_tables import build_packed_corpus, build_verse_samples, cap_source
from corpusloom.plans.verse_corpus import build_verse_corpus
from corpusloom.plans.vocabulary import build_vocabulary, load_vocabulary
from corpusloom.plans.wiki_corpus import build_wiki_corpus
from corpusloom.session import cut_lineage, shared_folder
from corpusloom.sources import readers, writers
from corpusloom.streaming.ingest import UnsafeResume, append_batch, ingest, ingest_counts


def test_ordered_scan_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "FILES_PER_LOOKUP", 2)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(f"a{i:03}", 1) for i in range(50)], "text string, x int").repartitionByRange(5, "text").sortWithinPartitions("text").write.parquet(a)
    spark.createDataFrame([("b",)], "text string").write.parquet(b)
    rows = readers.read_corpora(spark, [("a", a), ("gone", str(tmp_path / "gone")), ("b", b)])
    got = rows.select("source", source_of(F.col("ord")).alias("n"), "text", "ord").orderBy("ord").collect()
    assert [r["text"] for r in got] == [f"a{i:03}" for i in range(50)] + ["b"]
    assert got[-1]["n"] == 2 and got[0]["n"] == 0


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"id": 1, "title": "t", "text": "é", "url": "u"}\n\n   \nnot json\n{"id": "x", "text": null}\n{"id": 2, "text": "cut\n', encoding="utf-8")
    parsed = readers.read_jsonl(spark, str(path), schemas.ARTICLE)
    assert readers.read_counts(parsed).first().asDict() == {"total_read": 4, "kept": 2, "malformed": 2}
    assert [r["text"] for r in readers.valid_rows(parsed).collect()] == ["é", None]


def test_csv_with_mark_and_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('title,content,url\n"a ""q""","l1\nl2, x",u\nNA,,v\n', encoding="utf-8-sig")
    rows = readers.read_csv(spark, str(path), {"title": "", "content": None, "url": None, "author": "Unknown"}).collect()
    assert [tuple(r) for r in rows] == [('a "q"', "l1\nl2, x", "u", "Unknown"), ("NA", None, "v", "Unknown")]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("s", "é")], "source string, text string")
    writers.write_by_source(rows, str(tmp_path / "p"), ["s", "none"])
    assert spark.read.parquet(str(tmp_path / "p" / "source=none")).dtypes == [("text", "string")]
    writers.write_jsonl(rows, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"source":"s","text":"é"}'
    stats = readers.table_stats(spark.read.parquet(str(tmp_path / "p" / "source=s"))).first()
    assert stats["rows"] == 1 and stats["bytes"] > 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(spark.range(5)).count() == 5


def test_ingest_restarts_without_duplicates(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "sink", "state"))
    schema = schemas.ARTICLE

    def deliver(ids):
        spark.createDataFrame([(i, "t", f"x{i}", "u") for i in ids], schema).write.mode("append").json(source)

    deliver([1, 2, 2, 3])
    ingest(spark, source, sink, state, schema, "id").awaitTermination()
    deliver([3, 4])
    ingest(spark, source, sink, state, schema, "id").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]
    # The last batch runs again, as after a failure between write and commit.
    again = spark.createDataFrame([(4, "t", "x4", "u", "", None)], "id long, title string, text string, url string, value string, reason string")
    append_batch(again, 1, sink, schema)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]
    with pytest.raises(UnsafeResume):
        ingest(spark, source, sink, str(tmp_path / "lost"), schema, "id")


def test_ingest_rejects_with_reasons(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "sink")
    source.mkdir()
    (source / "a.json").write_text('{"id": 1, "text": "a"}\n{"id": "2", "text": "b"}\n{"id": 3, "te\n\n{"text": "c"}\n{"id": 4, "text": ""}\n'
                                   '{"id": 1, "text": "later"}\n')
    ingest(spark, str(source), sink, str(tmp_path / "state"), schemas.ARTICLE, "id", "text").awaitTermination()
    assert sorted((r["id"], r["text"]) for r in spark.read.parquet(sink).collect()) == [(1, "a"), (2, "b")]
    assert {r["outcome"]: r["lines"] for r in ingest_counts(spark, sink).collect()} == {
        "stored": 2, "malformed": 1, "no key": 1, "no content": 1}
    (source / "b.json").write_text('{"id": 4, "text": "now"}\n')
    ingest(spark, str(source), sink, str(tmp_path / "state"), schemas.ARTICLE, "id", "text").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 4]


def test_wiki_job(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    lines = [json.dumps({"id": 1, "title": "T", "text": "'''A''' [[b]]\n== Notes ==\nx", "url": "u"}), "broken", ""]
    path.write_text("\n".join(lines), encoding="utf-8")
    counts = build_wiki_corpus(spark, str(path), str(tmp_path / "j"), str(tmp_path / "p")).first()
    assert counts.asDict() == {"total_read": 2, "kept": 1, "malformed": 1}
    assert spark.read.parquet(str(tmp_path / "p")).first().asDict() == {"id": 1, "title": "T", "text": "A b", "url": "u"}
    path.write_text("broken\n", encoding="utf-8")
    build_wiki_corpus(spark, str(path), str(tmp_path / "j2"), str(tmp_path / "p2"))
    assert not os.path.exists(tmp_path / "p2")


def test_dedup_job(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    texts = ["a text that is long enough", "another text that is long enough", "short"]
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.parquet(a)
    spark.createDataFrame([(t,) for t in texts[:1] + ["words of the second source"]], "text string").coalesce(1).write.parquet(b)
    spark.createDataFrame([(texts[1],)], "text string").write.parquet(c)
    out = str(tmp_path / "out")
    build_dedup_corpus(spark, [("a", a), ("b", b), ("c", c)], out, Vocabulary(()), {"b": 3}, {"a"}, budget=1000)
    report = json.loads(spark.read.text(f"{out}/report").first()[0])
    assert report["sources"]["a"]["deduped_docs"] == 2 and report["sources"]["c"]["deduped_docs"] == 0
    assert report["sources"]["b"]["duplicate_rate"] == 0.5 and report["total_deduped_docs"] == 3
    assert report["token_audit"]["sources"]["b"] == {"tokens": 26, "weight": 3, "weighted_tokens": 78}
    assert report["token_audit"]["budget_gap_or_surplus"] == 26 + 32 + 78 - 1000
    kept = spark.read.schema("text string, source string").parquet(f"{out}/corpus")
    assert sorted((r["source"], r["text"]) for r in kept.collect()) == [("a", texts[0]), ("a", texts[1]), ("b", "words of the second source")]


def test_vocabulary_training_and_verse_jobs(spark, tmp_path):
    raw = str(tmp_path / "raw")
    texts = [f"the cat and the hat number {i}" for i in range(60)]
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.parquet(raw)
    report = build_vocabulary(spark, [("raw", raw)], str(tmp_path / "vocab"), 257 + 12)
    assert report.first()["broken"] == 0
    vocab = load_vocabulary(spark, str(tmp_path / "vocab"))
    assert len(vocab.merges) == 12 and vocab.tokens()[257:] == [
        r["merged"] for r in spark.read.parquet(str(tmp_path / "vocab" / "merges")).orderBy("rank").collect()]

    capped = cap_source(spark, raw, str(tmp_path / "cap"), 45).first()
    assert capped["rows"] == 45 and capped["size"].endswith("B")
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "cap")).collect()) == sorted(texts[:45])

    plan = build_packed_corpus(spark, [("raw", raw)], str(tmp_path / "blocks"), vocab, {"raw": 2}, 32).first()
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    assert plan["corpus_tokens"] == 32 * blocks.count() and {r[0] for r in blocks.select("split").distinct().collect()} == {"train", "test"}

    page = tmp_path / "pages.csv"
    stanza = "<br/>".join(["a b c d e"] * 4)
    page.write_text(f'title,content,source,url,author\nt,"<p>{stanza}</p>",s,u1,x\nt,"{stanza}\n\nno",s,u2,x\n', encoding="utf-8-sig")
    assert build_verse_corpus(spark, str(page), str(tmp_path / "verse")).first()["stanzas"] == 1
    rows = build_verse_samples(spark, str(tmp_path / "verse"), str(tmp_path / "samples"), vocab).collect()
    assert [(r["split"], r["rows"]) for r in rows] == [("test", 1)]


@pytest.mark.parametrize("cap", [0, 1, 9, 10, 11, 25, 60, 99])
def test_first_rows_read_only_the_files_they_are_in(spark, tmp_path, cap):
    path = str(tmp_path / "a folder, with blanks")
    spark.range(60).selectExpr("id", "cast(id as string) as text").repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().orderBy("file_path").collect()]
    rows = readers.first_rows(spark, path, cap)
    assert sorted(r["id"] for r in rows.collect()) == list(range(min(cap, 60))) and rows.columns == ["id", "text"]
    if cap:
        assert len(rows.inputFiles()) == next((n for n in range(1, 7) if sum(sizes[:n]) >= cap), 6)


def test_first_rows_of_one_file_and_of_partitions(spark, tmp_path):
    one = str(tmp_path / "one")
    spark.range(20).coalesce(1).write.parquet(one)
    file = unquote(spark.read.parquet(one).inputFiles()[0])
    assert sorted(r["id"] for r in readers.first_rows(spark, file, 7).collect()) == list(range(7))
    parted = str(tmp_path / "parted")
    spark.range(20).selectExpr("id", "id % 2 as part").coalesce(1).write.partitionBy("part").parquet(parted)
    assert sorted(map(tuple, readers.first_rows(spark, parted, 12).collect())) == sorted([(2 * k, 0) for k in range(10)] + [(1, 1), (3, 1)])


def test_counters_of_the_job_that_writes(spark, tmp_path):
    """The lines are read by one job, and a task that runs again does not count twice."""
    path = str(tmp_path / "lines")
    good = [json.dumps({"id": i, "text": "t"}) for i in range(90)]
    spark.createDataFrame([(x,) for x in good + ['{"id": 1, "te'] * 10], "value string").repartition(5).write.text(path)
    rows, counters = readers.observed_reads(readers.read_jsonl(spark, path, schemas.ARTICLE))
    readers.valid_rows(rows).write.parquet(str(tmp_path / "out"))
    assert counters().first().asDict() == {"total_read": 100, "kept": 90, "malformed": 10}
    none = str(tmp_path / "none")
    spark.createDataFrame([], "value string").write.text(none)
    rows, counters = readers.observed_reads(readers.read_jsonl(spark, none, schemas.ARTICLE))
    readers.valid_rows(rows).write.parquet(str(tmp_path / "out2"))
    assert counters().first().asDict() == {"total_read": 0, "kept": 0, "malformed": 0}
