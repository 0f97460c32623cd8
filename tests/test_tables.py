"""Selection, joins, mixture, packing and samples."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import training_queries
from corpusloom.catalog.registry import documents
from corpusloom.operators import bpe, joins, packing, selection
from corpusloom.operators import pages as P
from corpusloom.operators.audit import best_evaluation, token_audit, weighted_tokens, with_perplexity
from corpusloom.operators.mixture import split_leakage, split_mixture, weighted_mixture
from corpusloom.operators.order import shuffle_key, sort_hex
from corpusloom.operators.bpe import Vocabulary
from corpusloom.operators.dictionary import with_ids
from corpusloom.plans.training_tables import packed_corpus, verse_samples


@pytest.mark.parametrize("small", [100_000, 3])
def test_smallest_is_exact_for_any_spread(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "SMALL", small)
    rng = random.Random(1)
    keys = list({rng.choice([rng.randrange(40), (1 << 40) + rng.randrange(300), rng.randrange(1 << 60)]) for _ in range(500)})
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for n in (0, 1, 17, 200, len(keys), len(keys) + 5):
        got = sorted(r["k"] for r in selection.smallest(df, sort_hex(F.col("k")), n).collect())
        assert got == sorted(keys)[:n]


def test_rank(spark):
    rows = [("ab"[i % 2], i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long").withColumn("key", shuffle_key(7, F.col("i")))
    got = selection.with_rank(df, "key", ["g"]).collect()
    for g in "ab":
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["key"])
        assert [r["rank"] for r in mine] == list(range(150))


def test_not_yet_done_keeps_null(spark):
    todo = spark.createDataFrame([("a",), ("b",), (None,)], "url string")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    assert {r[0] for r in joins.not_yet_done(todo, done, "url").collect()} == {"b", None}


def test_weight_below_one_keeps_one_copy(spark):
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "source string, ord long")
    assert sorted((r["ord"], r["replica"]) for r in weighted_mixture(docs, {"a": 0, "b": 2}).collect()) == [(1, 1), (2, 1), (2, 2)]


def test_listing_without_pages(spark):
    totals = spark.createDataFrame([("a", 0), ("b", 2)], "author string, total long")
    assert sorted((r["author"], r["page"]) for r in P.author_frontier(totals).collect()) == [("b", 1), ("b", 2)]


def test_listing_attribute_forms(spark):
    html = ("<div class='list-item'><h4 class=list-item-header><span>x</span> <a title=t href=/p/1>A</a></h4>"
            "<a href='/author-1'>B</a></div><div class=list-item><h4 class='list-item-header'><a href='/p/2'>C</a></h4></div>")
    got = P.listing_items(spark.createDataFrame([(html,)], "html string")).collect()
    assert [(r["url"], r["title"], r["author"]) for r in got] == [("/p/1", "A", "B"), ("/p/2", "C", "Unknown")]


def test_mixture_and_split(spark):
    docs = spark.createDataFrame([("a" if i % 2 else "b", i) for i in range(100)], "source string, ord long")
    mix = weighted_mixture(docs, {"a": 3})
    assert {r["source"]: r["count"] for r in mix.groupBy("source").count().collect()} == {"a": 150, "b": 50}
    assert [r["ord"] for r in mix.repartition(7).orderBy("order_key").collect()] == [r["ord"] for r in mix.orderBy("order_key").collect()]
    faithful = split_mixture(mix, 0.1)
    assert faithful.filter("split = 'test'").count() == 20
    assert split_leakage(faithful).agg(F.sum("in_both")).first()[0] > 0
    apart = split_mixture(mix, 0.1, "by_document")
    assert split_leakage(apart).agg(F.sum("in_both"), F.sum("in_test")).first() == (0, 10)


@pytest.mark.parametrize("total, blocks", [(2 * 8 + 3, [8, 8]), (7, [7]), (0, []), (8, [8])])
def test_block_of_one_row(spark, total, blocks):
    df = spark.createDataFrame([(0, 0, list(range(total)))], "batch_id int, rank long, input_ids array<int>")
    rows = sorted(packing.pack_blocks(df, 8).collect(), key=lambda r: r["block"])
    assert [len(r["input_ids"]) for r in rows] == blocks
    assert sum((r["input_ids"] for r in rows), []) == list(range(sum(blocks)))


def test_packing_equals_python(spark):
    rng = random.Random(3)
    rows = [("t", i, [rng.randrange(99) for _ in range(rng.randrange(12))]) for i in range(90)]
    df = spark.createDataFrame(rows, "split string, ord long, input_ids array<int>")
    placed = packing.with_batches(df.withColumn("order_key", shuffle_key(1, F.col("ord"))), 20, ["split"])
    got = [(r["batch_id"], r["block"], r["input_ids"]) for r in packing.pack_blocks(placed, 16, ["split"]).collect()]
    want, ordered = [], sorted(placed.collect(), key=lambda r: r["order_key"])
    for b in range(0, 90, 20):
        flat = [t for r in ordered[b:b + 20] for t in r["input_ids"]]
        used = len(flat) // 16 * 16 if len(flat) >= 16 else len(flat)
        want += [(b // 20, i // 16, flat[i:i + 16]) for i in range(0, used, 16)]
    assert sorted(got) == sorted(want)
    totals = packing.block_totals(packing.pack_blocks(placed, 16, ["split"]), 16).first()
    assert totals["real_tokens"] == sum(len(w[2]) for w in want)
    plan = packing.budget_plan(packing.block_totals(packing.pack_blocks(placed, 16, ["split"]))).first()
    assert plan["max_steps"] == 9460


def test_label_mask(spark):
    df = spark.createDataFrame([([1, 2, 7, 8],), ([1, 2, 3, 4, 5, 6, 7, 8, 9],)], "ids array<int>")
    rows = packing.padded_samples(df, 2, 0, 0, 8).collect()
    assert rows[0]["labels"] == [-100, -100, 7, 8, 0, -100, -100, -100]
    assert rows[0]["attention_mask"] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert rows[1]["input_ids"] == [1, 2, 3, 4, 5, 6, 7, 8] and rows[1]["labels"][2:] == [3, 4, 5, 6, 7, 8]


def test_training_tables(spark):
    docs = spark.createDataFrame([("s", i, f"text {i}") for i in range(40)], "source string, ord long, text string")
    blocks = packed_corpus(docs, Vocabulary(()), {"s": 2}, length=32, ratio=0.1, batch_rows=10).collect()
    assert {r["split"] for r in blocks} == {"train", "test"}
    # 72 training rows in batches of 10: the last batch has 2 rows, fewer tokens
    # than a block, and therefore gives the one short block.
    short = [r for r in blocks if len(r["input_ids"]) != 32]
    assert [(r["split"], r["batch_id"], r["block"]) for r in short] == [("train", 7, 0)]
    assert len(short[0]["input_ids"]) in range(14, 17)
    stanzas = spark.createDataFrame([(i, 0, "ab é") for i in range(20)], "ord long, stanza_ord int, text string")
    sample = verse_samples(stanzas, Vocabulary(()), length=16).first()
    prefix = len("thơ:\n".encode())
    assert sample["labels"][:prefix] == [-100] * prefix and sample["labels"][prefix + 5] == 0
    assert sum(sample["attention_mask"]) == prefix + 6


def test_audit(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 5)], "source string, tokens long")
    row = token_audit(weighted_tokens(counts, {"a": 3}), 100).first()
    assert row.asDict() == {"unique_tokens": 15, "effective_tokens_with_weights": 35, "token_budget": 100,
                            "repeat_factor": 6.67, "enough_for_budget": False, "budget_gap_or_surplus": -65}
    nothing = token_audit(weighted_tokens(counts.filter("false"), {}), 100).first()
    assert nothing["repeat_factor"] is None and nothing["unique_tokens"] == 0
    log = spark.createDataFrame([(1, 1.0, None), (2, None, 0.5), (3, None, 0.5), (4, None, 2.0)], "step long, loss double, eval_loss double")
    assert best_evaluation(log).first()["best_step"] == 2
    assert with_perplexity(log).filter("step = 1").first()["eval_perplexity"] is None


def test_listing_pages_come_in_bounded_tasks(spark, tmp_path):
    """However many pages there are, a task reads a bounded number of them."""
    from corpusloom.catalog import page_queries

    spark.range(40_000).selectExpr("id AS page_id", "concat('/p', id) AS url", "'<h1>t</h1>' AS html").coalesce(1).write.parquet(
        str(tmp_path / "pages.parquet"))
    pages = page_queries._listing_pages(spark, str(tmp_path))
    sizes = pages.select("page_id").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * page_queries.PAGES_OF_A_TASK


def test_packing_encodes_every_text_once(spark):
    docs = spark.createDataFrame([("s", i, f"text {i}é") for i in range(20)], "source string, ord long, text string")
    plan = packed_corpus(docs, Vocabulary(()), {"s": 2})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython [encode_batches") == 1 and plan.count("ArrowEvalPython [_nfc_udf") == 1


def test_packing_skips_rows_without_tokens(spark):
    rows = [(0, 0, []), (0, 1, [1, 2, 3]), (0, 2, None), (0, 3, [4, 5]), (0, 4, []), (1, 5, []), (1, 6, None)]
    df = spark.createDataFrame(rows, "batch_id int, rank long, input_ids array<int>")
    assert sorted(tuple(r)[:3] for r in packing.pack_blocks(df, 2).collect()) == [(0, 0, [1, 2]), (0, 1, [3, 4])]
    assert [tuple(r)[:3] for r in packing.pack_blocks(df, 8).collect()] == [(0, 0, [1, 2, 3, 4, 5])]


def test_training_blocks_with_awkward_rows(spark, tmp_path):
    """Every row keeps its own text where a key repeats; words are counted once, and the ids are those of the plain encoder."""
    rows = [(1, "src1", "a b a b"), (1, "src1", "b a<|endoftext|> a b"), (2, "src1", None), (3, "src0", ""), (None, "src0", "a b"), (4, None, "a b")]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = documents(spark, str(tmp_path))
    words = bpe.word_counts(docs)
    vocab = bpe.learn(words)
    kept = docs.filter("ord is not null")
    ids = {r["text"]: r["ids"] + [0] for r in bpe.with_token_ids(kept, vocab).collect()}
    assert {r["text"]: r["ids"] + [0] for r in with_ids(kept, vocab, counts=words).collect()} == ids
    # A repeated key places both of its rows and meets both texts each time: 2 rows x 3 replicas x 2 texts.
    want = 6 * sum(len(ids[t]) for _, s, t in rows[:2]) + 3 * len(ids[None]) + len(ids[""])
    assert sum(r["n"] for r in training_queries.training_blocks(spark, str(tmp_path)).collect()) == want
