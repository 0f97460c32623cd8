"""Token sequences to training rows: blocks, padded samples, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import settings
from corpusloom.operators.selection import with_rank


def with_batches(rows: DataFrame, batch_rows: int = settings.MAP_BATCH_ROWS,
                 within: list[str] | None = None, key: str = "order_key") -> DataFrame:
    """Add ``batch_id`` and ``rank``: consecutive ``batch_rows`` rows in key order."""
    ranked = with_rank(rows, key, within or [])
    return ranked.withColumn("batch_id", F.floor(F.col("rank") / batch_rows))


def pack_blocks(rows: DataFrame, length: int = settings.BLOCK_LENGTH,
                within: list[str] | None = None) -> DataFrame:
    """Concatenate ``input_ids`` inside each batch and cut blocks of ``length``.

    The tail of a batch is dropped unless it is all there is; no tokens give no
    block.  Each row is cut at the block borders that its offset in the batch
    decides, so a group gathers the tokens of one block and no more.  ``labels``
    equal ``input_ids``.

    Rows without tokens go behind the windows: a filter in front of them would be
    moved to where the tokens are made, and make them a second time.
    """
    keys = [*(within or []), "batch_id"]
    size = F.greatest(F.size("input_ids"), F.lit(0)).cast("long")
    batch = Window.partitionBy(*keys)
    before = batch.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    sized = rows.select(*keys, "rank", "input_ids").withColumn(
        "__start", F.coalesce(F.sum(size).over(before), F.lit(0))
    ).withColumn("__total", F.sum(size).over(batch))
    used = F.when(F.col("__total") >= length, F.col("__total") - F.col("__total") % length).otherwise(F.col("__total"))
    first = F.floor(F.col("__start") / length)
    last = F.floor((F.least(F.col("__start") + size, used) - 1) / length)
    cut = sized.withColumn("__used", used).filter((F.col("__start") < F.col("__used")) & (size > 0)).withColumn(
        "block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("block") * length - F.col("__start"), F.lit(0))
    end = F.least(F.col("block") * length + length, F.col("__used")) - F.col("__start")
    parts = cut.select(*keys, F.col("block").cast("int").alias("block"), "rank",
                       F.slice("input_ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("part"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "part")))
    return parts.groupBy(*keys, "block").agg(
        F.flatten(F.transform(ordered, lambda r: r["part"])).alias("input_ids")
    ).withColumn("labels", F.col("input_ids"))


def block_totals(blocks: DataFrame, length: int = settings.BLOCK_LENGTH) -> DataFrame:
    """Blocks and nominal tokens (blocks x length) per split, plus real tokens."""
    return blocks.groupBy("split").agg(
        F.count("*").alias("blocks"),
        (F.count("*") * length).alias("total_tokens"),
        F.sum(F.size("input_ids")).alias("real_tokens"),
    )


def budget_plan(totals: DataFrame, budget: int = settings.TOKEN_BUDGET,
                length: int = settings.BLOCK_LENGTH) -> DataFrame:
    """Optimizer steps the token budget pays for and epochs over the corpus."""
    per_step = settings.BATCH_PER_DEVICE * settings.GRADIENT_ACCUMULATION * settings.DEVICES * length
    corpus = totals.agg(F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("corpus_tokens"))
    return corpus.select(
        "corpus_tokens",
        F.lit(per_step).cast("bigint").alias("tokens_per_step"),
        F.lit(budget // per_step).cast("bigint").alias("max_steps"),
        (F.lit(float(budget)) / F.nullif(F.col("corpus_tokens"), F.lit(0))).alias("epochs"),
    )


def padded_samples(rows: DataFrame, prefix_length: int, eos: int, pad: int,
                   length: int = settings.SAMPLE_LENGTH) -> DataFrame:
    """``ids`` (prefix included) + EOS, truncated and padded to ``length``.

    ``labels`` ignore the first ``prefix_length`` tokens and the padding; a
    real EOS keeps its label even though padding uses the same id.
    """
    full = F.slice(F.concat("ids", F.array(F.lit(eos))), 1, length)
    used = F.size("__full")
    fill = F.lit(length) - used
    return (
        rows.withColumn("__full", full)
        .withColumn("input_ids", F.concat("__full", F.array_repeat(F.lit(pad), fill)))
        .withColumn("attention_mask",
                    F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), fill)))
        .withColumn("labels", F.transform(
            "input_ids",
            lambda t, i: F.when(
                (i < prefix_length) | (i >= F.size("__full")), settings.IGNORED_LABEL
            ).otherwise(t),
        ))
        .drop("__full", "ids")
    )


def code_points(text: Column) -> Column:
    """Text as an array of its code points, a vocabulary-free token form."""
    points = F.transform(F.split(text, ""), lambda ch: F.ascii(ch))
    return F.when(text == "", F.array().cast("array<int>")).otherwise(points)
