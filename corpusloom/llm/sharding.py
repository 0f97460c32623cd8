"""Sharding in two passes of an external shuffle.

Pass one scatters the documents into memory-sized buckets by seeded hashes: the
shard by rendezvous hashing of ``doc_id`` (the largest of one hash per shard wins),
the bucket inside the shard by a hash of ``doc_id`` and text.  Pass two puts each
bucket in order, shuffles it (Fisher-Yates) and writes its documents to their
shard, one after the other by slot.

Law ``key``: ``doc_id`` and the number of shards decide, so a further shard takes
rows only into itself.  Rows with a null ``doc_id`` go to one shard by the hash of
null; null texts have 16 bytes.  Repeated rows get slots of their own.  Other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tables import packed, stored

SHARDS = 40
BUCKET_ROWS = 50_000  # rows of one bucket on average, where rows are keys only
BUCKET_BYTES = 8 << 20  # of the documents of one bucket on average
SEED = 9


def shard_of(doc_id: Column, shards: int) -> Column:
    draws = [F.struct(F.xxhash64(F.lit(SEED), F.lit(k), doc_id).alias("h"), F.lit(k).alias("k")) for k in range(shards)]
    return F.greatest(*draws)["k"] if shards > 1 else F.lit(0)


def scatter(docs: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Pass one: add ``size, text_crc32, shard, grown_shard`` and the bucket, one of ``buckets`` a shard."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *docs.columns,
        (F.octet_length(whole) + 16).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        shard_of(F.col("doc_id"), shards).alias("shard"),
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id", whole), F.lit(buckets)).alias("__bucket"))


def shuffled(scattered: DataFrame) -> DataFrame:
    """Pass two: the rows of each bucket in random order, with their ``slot``."""
    keys = ["shard", "__bucket"]
    columns = [c for c in scattered.columns if c not in keys]
    buckets = scattered.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("__rows"))
    mixed = buckets.select(*keys, F.posexplode(F.shuffle("__rows", F.lit(SEED))).alias("__at", "__row"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scattered.groupBy(*keys).agg(F.count("*").alias("__n")).select(
        *keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return mixed.join(F.broadcast(offsets), keys).select(  # one row a bucket
        *[F.col(f"__row.`{c}`").alias(c) for c in columns], "shard", (F.col("__before") + F.col("__at")).alias("slot"))


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, grown_shard, slot`` of every row, as the written shards hold them."""
    narrow = docs.select("doc_id", "text")
    measured = narrow.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    buckets = max(1, -(-measured // (BUCKET_BYTES * shards)))
    # Ranges of buckets: what a task shuffles lies one after the other in its shards.
    scattered = scatter(narrow, shards, buckets).repartitionByRange("shard", "__bucket")
    ordered = shuffled(scattered).sortWithinPartitions("shard", "slot")
    return stored(ordered, "shards", "shard").select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents themselves in the order of their slots, one folder a shard; where a column is called
    ``shard`` or ``slot`` already, the written one has an underscore more.

    Buckets shuffle numbers of rows, never documents; these are then sorted into files by their slots,
    which spills where they are larger than memory."""
    kept = stored(packed(docs, "doc_id", "text").withColumn("id", F.monotonically_increasing_id()), "to-shard")
    numbered = kept.select("doc_id", "text", "id")
    buckets = max(1, -(-kept.count() // (BUCKET_ROWS * shards)))
    slots = shuffled(scatter(numbered, shards, buckets).drop("text")).select("id", "shard", "slot")
    out = kept.select("row", "id").join(slots, "id").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    folder, place = (name + "_" * (name in docs.columns) for name in ("shard", "slot"))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    out.select(F.col("shard").alias(folder), F.col("slot").alias(place), *columns).write.partitionBy(folder).parquet(path)


def op9(docs: DataFrame) -> DataFrame:
    return place(docs).withColumn("law", F.lit("key"))
