"""Article JSON lines to clean text, with an audit of what every step removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions.wikitext import STEPS, clean_wikitext
from corpusloom.sources.readers import observed_reads, read_jsonl, valid_rows
from corpusloom.sources.writers import write_jsonl, write_parquet


def cleaning_audit(rows: DataFrame, by: str, text: str = "text", mode: str = "faithful") -> DataFrame:
    """Per ``by``: rows, changed rows, empty results, characters removed per step
    (negative where a step adds characters)."""
    cleaned = clean_wikitext(rows, text, "__clean", mode, lengths="__lengths")
    steps = [
        F.sum(F.get("__lengths", F.lit(i)) - F.get("__lengths", F.lit(i + 1))).alias(f"cut_{name}")
        for i, (name, _step) in enumerate(STEPS)
    ]
    return cleaned.groupBy(by).agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("__clean") != F.col(text)).alias("rows_changed"),
        F.count_if(F.col("__clean") == "").alias("rows_empty"),
        *steps,
    )


def build_wiki_corpus(spark: SparkSession, articles_path: str, jsonl_path: str, parquet_path: str,
                      mode: str = "faithful") -> DataFrame:
    """Clean the articles of a JSON-lines input, write JSON lines and Parquet,
    and return the counters of the run, gathered while the lines are written.
    Nothing is written to Parquet when no line is valid."""
    parsed, counters = observed_reads(read_jsonl(spark, articles_path, schemas.ARTICLE))
    write_jsonl(clean_wikitext(valid_rows(parsed), mode=mode), jsonl_path)
    cleaned = spark.read.schema(schemas.ARTICLE).json(jsonl_path)
    if not cleaned.isEmpty():
        write_parquet(cleaned, parquet_path)
    return counters()
