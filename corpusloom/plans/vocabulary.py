"""Learn a vocabulary from the raw sources and keep it as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators.bpe import Vocabulary, learn, round_trip_report, word_counts
from corpusloom.sources.readers import read_corpora
from corpusloom.sources.writers import write_parquet


def build_vocabulary(spark: SparkSession, sources: Sequence[tuple[str, str]], out: str,
                     vocab_size: int = settings.VOCAB_SIZE,
                     min_frequency: int = settings.MIN_FREQUENCY) -> DataFrame:
    """Write ``vocab``, ``merges`` and ``roles`` under ``out``; return the
    round-trip report over all sources."""
    docs = read_corpora(spark, sources)
    vocab = learn(word_counts(docs), vocab_size, min_frequency)
    write_parquet(vocab.vocab_table(spark), f"{out}/vocab")
    ids = spark.createDataFrame(
        [(rank, *merge) for rank, merge in enumerate(vocab.merges)],
        "rank int, left_id int, right_id int, merged_id int",
    )
    names = vocab.merges_table(spark)
    write_parquet(names.join(ids, "rank"), f"{out}/merges")
    write_parquet(vocab.roles_table(spark), f"{out}/roles")
    return round_trip_report(docs, vocab)


def load_vocabulary(spark: SparkSession, out: str) -> Vocabulary:
    """The stored merges, whose number is bounded by the vocabulary size."""
    rows = spark.read.parquet(f"{out}/merges").select("rank", "left_id", "right_id", "merged_id")
    ordered = rows.orderBy(F.col("rank")).collect()
    return Vocabulary(tuple((r["left_id"], r["right_id"], r["merged_id"]) for r in ordered))
