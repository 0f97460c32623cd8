"""Mixture, split, packing and sample tables.

Code points serve as token ids, so SQL can state the packed blocks too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.catalog.registry import SQL_DOCS, doc_id, documents, query, table, texts
from corpusloom.catalog.token_queries import WEIGHTS, _weights_sql
from corpusloom.operators import bpe
from corpusloom.operators.mixture import split_leakage as leakage_report
from corpusloom.operators.mixture import split_mixture, weighted_mixture
from corpusloom.operators.order import ROW_BITS, order_key, shuffle_key
from corpusloom.operators.packing import (
    block_totals as totals_of_blocks, budget_plan as plan_for_budget, code_points, pack_blocks,
    padded_samples, with_batches,
)
from corpusloom.operators.selection import split_by_key
from corpusloom.plans.training_tables import packed_corpus, verse_samples
from corpusloom.session import written

RATIO = settings.EVAL_RATIO
BATCH_ROWS = settings.MAP_BATCH_ROWS
EOS = 0

_ORD = f"(CAST(so AS BIGINT) * {1 << ROW_BITS} + doc_id)"
_MIX = f"""WITH {SQL_DOCS},
mix AS (SELECT source, so, doc_id, replica, {_ORD} AS ord, sha256('42#' || {_ORD} || '#' || replica) AS order_key
  FROM (SELECT *, unnest(range(1, {_weights_sql()} + 1)) AS replica FROM docs)),
ranked AS (SELECT *, row_number() OVER (ORDER BY order_key) AS rn FROM mix),
split AS (SELECT *, CASE WHEN rn <= ceil({RATIO} * (SELECT count(*) FROM mix)) THEN 'test' ELSE 'train' END AS split FROM ranked)
"""


def _mixture(spark, folder):
    return weighted_mixture(documents(spark, folder).select("source", "ord"), WEIGHTS)


@query("mixture", _MIX + "SELECT source, doc_id, CAST(replica AS INTEGER) AS replica, order_key FROM mix")
def mixture(spark, folder):
    return _mixture(spark, folder).select("source", doc_id(), "replica", "order_key")


@query("mixture_counts", _MIX + "SELECT source, count(*) AS samples FROM mix GROUP BY source")
def mixture_counts(spark, folder):
    return _mixture(spark, folder).groupBy("source").agg(F.count("*").alias("samples"))


@query("mixture_split", _MIX + "SELECT doc_id, CAST(replica AS INTEGER) AS replica, split FROM split")
def mixture_split(spark, folder):
    return split_mixture(_mixture(spark, folder), RATIO).select(doc_id(), "replica", "split")


@query("mixture_split_by_document", _MIX + f""", d AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha256('42#' || {_ORD}))
    <= ceil({RATIO} * (SELECT count(*) FROM docs)) THEN 'test' ELSE 'train' END AS split FROM docs)
SELECT doc_id, CAST(replica AS INTEGER) AS replica, split FROM mix JOIN d USING (doc_id)""")
def mixture_split_by_document(spark, folder):
    return split_mixture(_mixture(spark, folder), RATIO, "by_document").select(doc_id(), "replica", "split")


@query("split_leakage", _MIX + """, sides AS (SELECT source, doc_id, bool_or(split = 'test') AS te, bool_or(split = 'train') AS tr FROM split GROUP BY ALL)
SELECT source, count(*) AS documents, count(*) FILTER (te) AS in_test, count(*) FILTER (te AND tr) AS in_both FROM sides GROUP BY source""")
def split_leakage(spark, folder):
    return leakage_report(split_mixture(_mixture(spark, folder), RATIO))


# Running lengths place every text in its batch; a block is made of the substrings that fall into it. chr(1) stands for the end of a text.
_PLACES = _MIX + f""", placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY order_key) - 1 AS rank FROM split),
texts AS (SELECT doc_id, text || chr(1) AS t, length(text) + 1 AS n FROM documents),
sized AS (SELECT split, rank // {BATCH_ROWS} AS batch_id, rank, t, n FROM placed JOIN texts USING (doc_id)),
running AS (SELECT *, sum(n) OVER (PARTITION BY split, batch_id ORDER BY rank) - n AS start, sum(n) OVER (PARTITION BY split, batch_id) AS total FROM sized),
used AS (SELECT *, CASE WHEN total >= 1024 THEN total - total % 1024 ELSE total END AS used FROM running)
"""
_BLOCKS = _PLACES + f""", cuts AS (SELECT *, unnest(range(CAST(start // 1024 AS BIGINT), CAST((least(start + n, used) - 1) // 1024 AS BIGINT) + 1)) AS block FROM used WHERE start < used),
parts AS (SELECT split, batch_id, block, rank, greatest(block * 1024 - start, 0) AS first, least(block * 1024 + 1024, used) - start AS last, t FROM cuts),
joined AS (SELECT split, batch_id, block, string_agg(substring(t, CAST(first AS BIGINT) + 1, CAST(last - first AS BIGINT)), '' ORDER BY rank) AS body FROM parts GROUP BY ALL),
blocks AS (SELECT split, batch_id, CAST(block AS INTEGER) AS block,
  list_transform(list_filter(string_split(body, ''), lambda c: c <> ''), lambda c: CASE WHEN c = chr(1) THEN {EOS} ELSE unicode(c) END) AS ids FROM joined)
"""
_SUMS = _PLACES + """, sums AS (SELECT split, batch_id, max(used) AS used FROM used GROUP BY ALL),
totals AS (SELECT split, CAST(sum((used + 1023) // 1024) AS BIGINT) AS blocks, CAST(sum(used) AS BIGINT) AS real_tokens FROM sums GROUP BY split)
"""


def _blocks(spark, folder):
    docs = documents(spark, folder)
    placed = with_batches(split_mixture(_mixture(spark, folder), RATIO), BATCH_ROWS, ["split"])
    ids = F.concat(code_points(F.col("text")), F.array(F.lit(EOS)))
    tokens = docs.select("ord", ids.alias("input_ids"))
    return pack_blocks(placed.join(tokens, "ord"), within=["split"])


@query("pack_blocks", _BLOCKS + """SELECT split, batch_id, block, len(ids) AS n, ids[1] AS first_id,
  md5(array_to_string(ids, ' ')) AS content, true AS same_labels FROM blocks""")
def packed_blocks(spark, folder):
    return _blocks(spark, folder).select(
        "split", "batch_id", "block", F.size("input_ids").alias("n"), F.get("input_ids", F.lit(0)).alias("first_id"),
        F.md5(F.array_join("input_ids", " ")).alias("content"), (F.col("labels") == F.col("input_ids")).alias("same_labels"),
    )


@query("block_totals", _SUMS + "SELECT split, blocks, blocks * 1024 AS total_tokens, real_tokens FROM totals")
def block_totals(spark, folder):
    return totals_of_blocks(_blocks(spark, folder))


@query("budget_plan", _SUMS + """SELECT CAST(sum(blocks) * 1024 AS BIGINT) AS corpus_tokens, 262144::BIGINT AS tokens_per_step, 9460::BIGINT AS max_steps,
  2480000000.0::DOUBLE / (sum(blocks) * 1024) AS epochs FROM totals""")
def budget_plan(spark, folder):
    return plan_for_budget(totals_of_blocks(_blocks(spark, folder)))


_PREFIX_IDS = [ord(ch) for ch in settings.VERSE_PREFIX]
_SAMPLES = f"""WITH t AS (SELECT conv_id, turn, list_append(list_concat({_PREFIX_IDS},
    list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: unicode(c))), {EOS})[1:64] AS f FROM conversations)
"""


def _turns(spark, folder):
    return texts(spark, folder, "conversations", "conv_id").select(
        "conv_id", "turn", F.concat(F.array(*[F.lit(i) for i in _PREFIX_IDS]), code_points(F.col("text"))).alias("ids")
    )


@query("sample_mask", _SAMPLES + f"""SELECT conv_id, turn,
  array_to_string(list_concat(f, list_transform(range(len(f), 64), lambda i: {EOS})), ' ') AS input_ids,
  array_to_string(list_transform(range(0, 64), lambda i: CASE WHEN i < len(f) THEN 1 ELSE 0 END), ' ') AS attention_mask,
  array_to_string(list_transform(range(0, 64), lambda i: CASE WHEN i < {len(_PREFIX_IDS)} OR i >= len(f) THEN -100 ELSE f[i + 1] END), ' ') AS labels
FROM t""")
def sample_mask(spark, folder):
    rows = padded_samples(_turns(spark, folder), len(_PREFIX_IDS), EOS, EOS)
    return rows.select("conv_id", "turn", *[F.array_join(c, " ").alias(c) for c in ("input_ids", "attention_mask", "labels")])


@query("sample_split", """SELECT conv_id, turn, CASE WHEN row_number() OVER (ORDER BY sha256('42#' || conv_id || '#' || turn))
  <= ceil(0.1 * (SELECT count(*) FROM conversations)) THEN 'test' ELSE 'train' END AS split FROM conversations""")
def sample_split(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn")
    key = shuffle_key(settings.SEED, F.col("conv_id"), F.col("turn"))
    return split_by_key(rows, key, settings.VERSE_EVAL_RATIO)


@query("training_blocks")
def training_blocks(spark, folder):
    """The whole first-stage table with a learned vocabulary."""
    docs = documents(spark, folder)
    words = written(bpe.word_counts(docs), "words")
    vocab = bpe.learn(words, settings.VOCAB_SIZE, settings.MIN_FREQUENCY)
    blocks = packed_corpus(docs, vocab, WEIGHTS, ratio=RATIO, batch_rows=BATCH_ROWS, counts=words)
    return blocks.select("split", "batch_id", "block", F.size("input_ids").alias("n"),
                         F.md5(F.array_join("input_ids", " ")).alias("content"))


@query("verse_training_samples")
def verse_training_samples(spark, folder):
    """The whole second-stage table with a learned vocabulary."""
    turns = table(spark, folder, "conversations")
    vocab = bpe.learn(bpe.word_counts(turns), settings.VOCAB_SIZE, settings.MIN_FREQUENCY)
    rows = turns.select(order_key(F.lit(0), F.col("conv_id")).alias("ord"), F.col("turn").alias("stanza_ord"), "text")
    return verse_samples(rows, vocab).select(
        "ord", "stanza_ord", "split", *[F.array_join(c, " ").alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )
