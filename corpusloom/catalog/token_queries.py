"""Tokenizer jobs: word and pair counts, learning, encoding, audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.catalog.registry import doc_id, documents, query, table
from corpusloom.operators import audit, bpe, token_store
from corpusloom.operators.dictionary import encoded_texts
from corpusloom.session import shared_folder, written

WEIGHTS = {"src0": 1, "src1": 3, "src2": 2}

# RE2 has no look-ahead: a mark is put in front of the last blank of a run that
# precedes a word, and the text is cut there.
_WORDS = r"""WITH cut AS (SELECT source, unnest(string_split(regexp_replace(nfc_normalize(text), '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g'), chr(1))) AS t FROM documents),
words AS (SELECT source, unnest(regexp_extract_all(t, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+')) AS word FROM cut),
counts AS (SELECT word, count(*) AS freq FROM words GROUP BY word)
"""


def _weights_sql() -> str:
    cases = " ".join(f"WHEN '{s}' THEN {w}" for s, w in WEIGHTS.items())
    return f"CASE source {cases} ELSE 1 END"


@query("word_counts", _WORDS + "SELECT word, freq FROM counts")
def word_counts(spark, folder):
    return bpe.word_counts(documents(spark, folder))


@query("pair_counts", _WORDS + r""", bytes AS (SELECT freq, hex(encode(word)) AS h FROM counts),
pairs AS (SELECT freq, h, unnest(range(0, length(h) // 2 - 1)) AS i FROM bytes)
SELECT substring(h, 2 * i + 1, 4) AS pair, CAST(sum(freq) AS BIGINT) AS freq FROM pairs GROUP BY 1""")
def pair_counts(spark, folder):
    """Adjacent byte pairs over the words, as hexadecimal bytes."""
    words = bpe.word_counts(documents(spark, folder))
    state = words.select(bpe.symbols(F.col("word")).alias("symbols"), "freq")
    latin = F.translate("pair", bpe._BYTE_SYMBOLS, bpe._LATIN)
    return bpe.pair_counts(state).select(F.hex(F.encode(latin, "ISO-8859-1")).alias("pair"), "freq")


def _learned(words):
    return bpe.learn(words, settings.VOCAB_SIZE, settings.MIN_FREQUENCY)


def _vocabulary(docs):
    return _learned(bpe.word_counts(docs))


@query("bpe_merges")
def bpe_merges(spark, folder):
    return _vocabulary(documents(spark, folder)).merges_table(spark)


@query("bpe_vocab")
def bpe_vocab(spark, folder):
    return _vocabulary(documents(spark, folder)).vocab_table(spark)


@query("bpe_encode")
def bpe_encode(spark, folder):
    docs = documents(spark, folder)
    words = written(bpe.word_counts(docs), "words")
    rows = encoded_texts(docs, _learned(words), counts=words)
    return rows.select(doc_id(), F.size("ids").alias("n_tokens"), F.array_join("ids", " ").alias("ids"))


@query("token_counts")
def token_counts(spark, folder):
    docs = documents(spark, folder)
    return bpe.token_counts(docs, _vocabulary(docs))


@query("token_roundtrip", "SELECT source, count(*) AS docs, 0::BIGINT AS broken FROM documents GROUP BY source")
def token_roundtrip(spark, folder):
    docs = documents(spark, folder)
    return bpe.round_trip_report(docs, _vocabulary(docs)).drop("tokens")


def _tokens(spark, folder):
    """Words of a source as its token count (a vocabulary-free proxy)."""
    words = bpe.word_counts(documents(spark, folder), ["source"])
    return words.groupBy("source").agg(F.sum("freq").alias("tokens"))


@query("weighted_tokens", _WORDS + f"""SELECT source, count(*) AS tokens, {_weights_sql()} AS weight,
  count(*) * {_weights_sql()} AS weighted_tokens FROM words GROUP BY source""")
def weighted_tokens(spark, folder):
    return audit.weighted_tokens(_tokens(spark, folder), WEIGHTS)


@query("token_audit", _WORDS + f""", t AS (SELECT count(*) AS u, CAST(sum({_weights_sql()}) AS BIGINT) AS w FROM words)
SELECT u AS unique_tokens, w AS effective_tokens_with_weights, 2480000000::BIGINT AS token_budget,
  round(2480000000 / u, 2) AS repeat_factor, w >= 2480000000 AS enough_for_budget,
  w - 2480000000 AS budget_gap_or_surplus FROM t""")
def token_audit(spark, folder):
    return audit.token_audit(audit.weighted_tokens(_tokens(spark, folder), WEIGHTS))


# The vocabulary without merges has the bytes of the NFC text as tokens, so SQL can count them.
_BYTES = "WITH tokens AS (SELECT source, count(*) AS docs, CAST(sum(strlen(nfc_normalize(text))) AS BIGINT) AS tokens FROM documents GROUP BY source)\n"


def _stored(spark, folder):
    """The documents come in two deliveries, the second one twice."""
    store, vocab = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}", bpe.Vocabulary(())
    docs = documents(spark, folder, "doc_id")
    even = F.col("doc_id") % 2 == 0
    for name, part in (("first", even), ("second", ~even), ("second", ~even)):
        token_store.add_delivery(docs.filter(part), vocab, store, name)
    return store, vocab


@query("stored_tokens", _BYTES + f"""SELECT source, tokens, {_weights_sql()} AS weight, tokens * {_weights_sql()} AS weighted_tokens FROM tokens""")
def stored_tokens(spark, folder):
    return token_store.stored_audit(spark, *_stored(spark, folder), WEIGHTS)[0]


@query("stored_token_audit", _BYTES + f""", t AS (SELECT CAST(sum(tokens) AS BIGINT) AS u, CAST(sum(tokens * {_weights_sql()}) AS BIGINT) AS w FROM tokens)
SELECT u AS unique_tokens, w AS effective_tokens_with_weights, 2480000000::BIGINT AS token_budget,
  round(2480000000 / u, 2) AS repeat_factor, w >= 2480000000 AS enough_for_budget,
  w - 2480000000 AS budget_gap_or_surplus FROM t""")
def stored_token_audit(spark, folder):
    return token_store.stored_audit(spark, *_stored(spark, folder), WEIGHTS)[1]


# --- training log: event values stand in for losses ---
_LOG = """WITH log AS (SELECT event_id AS step, event_type AS run, value AS loss,
  CASE WHEN event_id % 10 = 0 THEN value / 2 END AS eval_loss FROM events)
"""


def _log(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("step"), F.col("event_type").alias("run"), F.col("value").alias("loss"),
        F.when(F.col("event_id") % 10 == 0, F.col("value") / 2).alias("eval_loss"),
    )


@query("log_perplexity", _LOG + """SELECT step, loss, eval_loss, exp(loss) AS train_perplexity,
  exp(eval_loss) AS eval_perplexity FROM log""")
def log_perplexity(spark, folder):
    return audit.with_perplexity(_log(spark, folder)).drop("run")


@query("best_eval", _LOG + """SELECT run, step AS best_step, eval_loss AS best_eval_loss FROM log WHERE eval_loss IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run ORDER BY eval_loss, step) = 1""")
def best_eval(spark, folder):
    return audit.best_evaluation(_log(spark, folder), ["run"])
