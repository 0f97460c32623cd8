"""Training tables: packed blocks of the mixture, and padded verse samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.functions.text import format_size, with_nfc
from corpusloom.operators.bpe import SPECIAL_ID, Vocabulary, with_token_ids
from corpusloom.operators.dictionary import with_ids
from corpusloom.operators.mixture import split_mixture, weighted_mixture
from corpusloom.operators.order import shuffle_key
from corpusloom.operators.packing import (
    block_totals, budget_plan, pack_blocks, padded_samples, with_batches,
)
from corpusloom.operators.selection import split_by_key
from corpusloom.schemas import TEXT
from corpusloom.sources.readers import first_rows, read_corpora, table_stats
from corpusloom.sources.writers import write_parquet


def packed_corpus(docs: DataFrame, vocab: Vocabulary, weights: dict[str, int],
                  length: int = settings.BLOCK_LENGTH, ratio: float = settings.EVAL_RATIO,
                  batch_rows: int = settings.MAP_BATCH_ROWS, mode: str = "faithful",
                  counts: DataFrame | None = None) -> DataFrame:
    """``docs(source, ord, text)`` to ``(split, batch_id, block, input_ids, labels)``.

    Order, split and batches are decided on row identities alone; every
    document is tokenized once, before its replicas meet their batches.
    ``counts(word, freq)`` are those of the texts' words, where they are stored already.
    """
    mixture = weighted_mixture(docs.select("source", "ord"), weights)
    placed = with_batches(split_mixture(mixture, ratio, mode), batch_rows, ["split"])
    tokens = with_ids(docs.select("ord", "text"), vocab, "input_ids", counts).select(
        "ord", F.concat("input_ids", F.array(F.lit(SPECIAL_ID))).alias("input_ids")
    )
    rows = placed.select("split", "batch_id", "rank", "ord").join(tokens, "ord")
    return pack_blocks(rows, length, ["split"])


def verse_samples(stanzas: DataFrame, vocab: Vocabulary, prefix: str = settings.VERSE_PREFIX,
                  length: int = settings.SAMPLE_LENGTH, ratio: float = settings.VERSE_EVAL_RATIO,
                  seed: int = settings.SEED) -> DataFrame:
    """``stanzas(ord, stanza_ord, text)`` to masked samples with their split.

    Prefix and text are tokenized as one string; the mask covers as many
    tokens as the prefix has on its own.
    """
    prefix_row = stanzas.sparkSession.createDataFrame([(prefix,)], "text string")
    prefix_length = len(with_token_ids(prefix_row, vocab).first()["ids"])
    whole = with_nfc(stanzas, "text").withColumn("text", F.concat(F.lit(prefix), "text"))
    samples = padded_samples(with_token_ids(whole, vocab), prefix_length, SPECIAL_ID, SPECIAL_ID, length)
    key = shuffle_key(seed, F.col("ord"), F.col("stanza_ord"))
    return split_by_key(samples, key, ratio)


def cap_source(spark: SparkSession, path: str, out: str, cap: int = settings.SOURCE_ROW_CAP) -> DataFrame:
    """Write the first ``cap`` rows of a Parquet source and return rows and size."""
    write_parquet(first_rows(spark, path, cap).select("text"), out)
    stats = table_stats(spark.read.parquet(out))
    return stats.select("rows", format_size(F.col("bytes")).alias("size"))


def build_packed_corpus(spark: SparkSession, sources: Sequence[tuple[str, str]], out: str, vocab: Vocabulary,
                        weights: dict[str, int], length: int = settings.BLOCK_LENGTH) -> DataFrame:
    """Write the first-stage table by split; return block totals and budget plan."""
    blocks = packed_corpus(read_corpora(spark, sources), vocab, weights, length)
    blocks.write.mode("overwrite").partitionBy("split").parquet(out)
    totals = block_totals(spark.read.parquet(out), length)
    return budget_plan(totals, length=length)


def build_verse_samples(spark: SparkSession, jsonl_path: str, out: str, vocab: Vocabulary) -> DataFrame:
    """Write the second-stage table by split; return rows per split."""
    # A JSON scan has no row numbers: the n-th copy of a line in its file is told
    # apart by n, so equal lines have places of their own whatever the splits.
    copies = Window.partitionBy("path", "text").orderBy(F.lit(0))
    stanzas = spark.read.schema(TEXT).json(jsonl_path).select(
        F.col("_metadata.file_path").alias("path"), "text"
    ).withColumn("stanza_ord", F.row_number().over(copies)).select(
        F.sha2(F.concat_ws("#", "path", "text"), 256).alias("ord"), "stanza_ord", "text"
    )
    verse_samples(stanzas, vocab).write.mode("overwrite").partitionBy("split").parquet(out)
    return spark.read.parquet(out).groupBy("split").agg(F.count("*").alias("rows"))
