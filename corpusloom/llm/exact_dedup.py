"""Exact copies: sorted digest runs merged up a tree, answers handed back down.

Each document becomes a digest and its ``doc_id``.  Documents are dealt to
``RUNS`` runs; a run keeps per digest the smallest ``doc_id`` and the number of
rows.  In each round ``FAN`` neighbouring runs are merged into one, until one run
(distributed by digest) is left.  The winner then goes back through the same
levels, so no join or aggregation ever sees more than ``FAN`` rows of a digest,
or a run's share of its copies, however many copies there are.

Null texts count as empty ones.  A null ``doc_id`` is larger than any other.  Of
rows equal in text and ``doc_id`` one stays.  An empty table gives an empty
result.  Columns of the input, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tables import packed, stored, unpacked

FAN_BITS = 4  # 16 runs merge into one
LEVELS = 2
RUNS = 1 << (FAN_BITS * LEVELS)
# The second hash and the size verify what SHA-256 calls equal.
DIGEST = ["__sha", "__size", "__second"]
RUN = "__run"


def normalised(text: Column) -> Column:
    """Runs of white space as one space; runs that already are one are skipped."""
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++", " ")


def with_digest(docs: DataFrame) -> DataFrame:
    """Add the digest of the text and the run that the row belongs to."""
    return docs.withColumn("__norm", normalised(F.col("text"))).select(
        *docs.columns, F.unhex(F.sha2("__norm", 256)).alias("__sha"), F.octet_length("__norm").alias("__size"),
        F.xxhash64("__norm").alias("__second"),
        F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(RUNS)).cast("int").alias(RUN))


def winners(rows: DataFrame) -> DataFrame:
    """Per run and digest ``keep_id`` and ``group_size`` over all runs."""
    parent = F.shiftright(RUN, FAN_BITS)
    levels = [rows.groupBy(RUN, *DIGEST).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))]
    for _ in range(LEVELS):
        levels.append(levels[-1].withColumn(RUN, parent).groupBy(RUN, *DIGEST).agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    answer = levels.pop()
    while levels:
        below = levels.pop().select(F.col(RUN).alias("__child"), parent.alias(RUN), *DIGEST)
        answer = below.join(answer, [RUN, *DIGEST]).select(
            F.col("__child").alias(RUN), *DIGEST, "keep_id", "group_size")
    return answer


def decided(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` (with digests) plus ``keep_id, group_size, kept``."""
    nth = F.row_number().over(Window.partitionBy(RUN, *DIGEST, "doc_id").orderBy(F.lit(0)))
    return rows.join(merged, [RUN, *DIGEST]).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (nth == 1))


def decide(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept`` and the digest for every row."""
    rows = stored(with_digest(docs.select("doc_id", "text")).drop("text"), "digests")
    return decided(rows, winners(rows))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    digests = stored(with_digest(docs.select("doc_id", "text")).drop("text"), "digests")
    merged = winners(digests).select(RUN, *DIGEST, "keep_id")
    # Of rows equal in text and id one stays, whatever the order in which they arrive.
    nth = F.row_number().over(Window.partitionBy(RUN, *DIGEST, "doc_id").orderBy(F.xxhash64(F.to_json("row"))))
    rows = with_digest(packed(docs, "doc_id", "text")).drop("text").join(merged, [RUN, *DIGEST]).filter(
        F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return unpacked(rows.withColumn("nth", nth).filter("nth = 1"), docs.columns)


def op2(docs: DataFrame) -> DataFrame:
    return decide(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("__sha")).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d"""
