"""Packing by optimal length buckets.

A document is cut into pieces of at most ``CONTEXT`` words, so that nothing is
dropped and the histogram of piece lengths has at most ``CONTEXT`` entries.  Dynamic
programming over the histogram of all pieces chooses the ``BUCKETS`` upper lengths
with the least padding.  Inside a bucket the pieces form batches of as many rows as
the token budget allows at the bucket's length: in pseudo-random order, or, in
``pack``, in the order of the incoming rows, so that batches follow a mix.

A word is ``[^\\x20\\x09-\\x0D]+``.  The pieces of a text joined are the text.  A null,
empty or blank text is one piece of no words, padded like one of one word.
Repeated rows are rows of their own; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tables import stored, uniform, with_places

CONTEXT = 2_048
BUCKETS = 16
TOKEN_BUDGET = 65_536
SEED = 7
_WORD, _GAP = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD + "++"))


def pieces_of(text: Column, words: Column, context: int = CONTEXT) -> Column:
    """The text cut after every ``context`` words, white space with the word before it."""
    cut = F.regexp_extract_all(text, F.lit(f"{_GAP}*+(?:{_WORD}++{_GAP}*+){{1,{context}}}+"), F.lit(0))
    return F.when(words > context, cut).otherwise(F.array(text))


def best_bounds(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend.  ``least[j]``: least padding of the first ``j`` lengths."""
    size = len(lengths)
    if size == 0:
        return []
    length, count = np.asarray(lengths, dtype=float), np.asarray(counts, dtype=float)
    rows = np.concatenate([[0.0], np.cumsum(count)])
    words = np.concatenate([[0.0], np.cumsum(count * length)])
    least = np.concatenate([[0.0], np.full(size, np.inf)])
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, size)):
        after, cut = np.full(size + 1, np.inf), np.zeros(size + 1, dtype=int)
        for j in range(1, size + 1):
            cost = least[:j] + length[j - 1] * (rows[j] - rows[:j]) - (words[j] - words[:j])
            cut[j] = int(np.argmin(cost))
            after[j] = cost[cut[j]]
        least, cuts = after, [*cuts, cut]
    bounds, j = [], size
    for cut in reversed(cuts):
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def batches(pieces: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, order: Column | None = None) -> DataFrame:
    """Add ``bucket, padded, batch, slot`` to rows with ``doc_id, piece, n_tokens``.

    ``order``: a LONG in [0, 2^60), spread evenly, instead of a hash."""
    if order is None:
        order = uniform(SEED, "doc_id", "piece")
    padded = F.greatest(F.col("n_tokens"), F.lit(1))
    histogram = sorted(pieces.groupBy(padded.alias("n")).agg(F.count("*").alias("c")).collect())
    bounds = best_bounds([r["n"] for r in histogram], [r["c"] for r in histogram], buckets)
    of = F.lit(bounds or [1])
    bucket = F.size(F.filter(of, lambda b: b < padded))
    placed = with_places(pieces.withColumn("bucket", bucket), ["bucket"], order,
                         sum(r["c"] for r in histogram), "__place")
    rows = F.greatest(F.floor(F.lit(budget) / F.col("padded")), F.lit(1))
    return placed.withColumn("padded", F.get(of, F.col("bucket"))).select(
        *pieces.columns, "bucket", "padded", F.floor(F.col("__place") / rows).alias("batch"),
        (F.col("__place") % rows).alias("slot"))


def pieces(docs: DataFrame, context: int = CONTEXT, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, piece, n_tokens, text``: every document cut to the context; ``keep``: columns that stay."""
    counted = docs.select(*keep, "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("__words", count_words(F.col("text")))
    cut = counted.select(*keep, "doc_id", "__words", F.posexplode(pieces_of(F.col("text"), F.col("__words"), context)).alias("piece", "text"))
    return cut.select(*keep, "doc_id", "piece", F.least(F.lit(context), F.col("__words") - F.col("piece") * context).alias("n_tokens"), "text")


def piece_lengths(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """``doc_id, piece, n_tokens`` without the texts."""
    counted = docs.select("doc_id", count_words(F.col("text")).alias("__words"))
    last = F.greatest(F.floor((F.col("__words") - 1) / context), F.lit(0)).cast("int")
    cut = counted.select("doc_id", "__words", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return cut.select("doc_id", "piece", F.least(F.lit(context), F.col("__words") - F.col("piece") * context).alias("n_tokens"))


def with_positions(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, text`` of Parquet files plus ``__at``, the row's number from 0 by file and row; and the number of rows."""
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:  # no files: written in the order of the partitions
        return with_positions(stored(docs.select("doc_id", "text"), "ordered"))
    sizes = placed.groupBy("__file").agg((F.max("__row") + 1).alias("__n"))
    # One row a file, as the driver's list of files has it.
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sizes.select("__file", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "starts")
    return (placed.join(F.broadcast(starts), "__file").select("doc_id", "text", (F.col("__start") + F.col("__row")).alias("__at")),
            starts.agg(F.sum("__n")).first()[0] or 0)


def pack(docs: DataFrame) -> DataFrame:
    """The pieces with their texts and places in batches, which follow the order of the rows."""
    placed, rows = with_positions(docs)
    step = (1 << 60) // max(1, rows)
    cut = stored(pieces(placed, keep=["__at"]), "pieces")
    return batches(cut, order=F.col("__at") * F.lit(step) + F.least(F.col("piece"), F.lit(step - 1))).drop("__at")


def op7(docs: DataFrame) -> DataFrame:
    return batches(stored(piece_lengths(docs), "lengths"))
