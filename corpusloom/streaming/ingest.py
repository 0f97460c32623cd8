"""Restartable, append-only ingest of page records.

The stream itself has no state: a batch is a table of lines, and everything about it
is decided by joins and aggregations.  Rejected lines leave first; of every key in the
batch the row delivered first is left by one aggregation; keys that earlier batches stored
are found by a scan of the sink's key column, whose other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.sources.readers import parse_lines
from corpusloom.streaming.ledger import UnsafeResume, check_resume, record_batch

__all__ = ["UnsafeResume", "append_batch", "ingest", "ingest_counts", "rejected_path", "store_batch"]

REJECTED = "rejected"  # folder beside the sink
_FILE = {"__modified": "file_modification_time", "__file": "file_path", "__start": "file_block_start"}
_ORDER = [*_FILE, "__row"]


def rejected_path(sink: str) -> str:
    return f"{sink}-{REJECTED}"


def delivered(lines: DataFrame, schema: T.StructType, key: str, content: str | None) -> DataFrame:
    """Parsed lines with their place of delivery, the raw line and ``reason``:
    why a line is not stored, null if it can be."""
    # A task reads a file's part from its start on, so numbers within a task follow the file.
    placed = lines.withColumn("__row", F.monotonically_increasing_id())
    parsed = parse_lines(placed, schema, "value", *_ORDER)
    reason = F.when(F.col("malformed"), "malformed").when(F.col(key).isNull(), "no key")
    if content is not None:
        reason = reason.when(F.coalesce(F.col(content), F.lit("")) == "", "no content")
    return parsed.withColumn("reason", reason).drop("malformed")


def first_deliveries(rows: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Of every key the row delivered first."""
    first = F.min_by(F.struct(*schema.fieldNames()), F.struct(*_ORDER))
    return rows.groupBy(F.col(key).alias("__key")).agg(first.alias("row")).select("row.*")


def stored_keys(spark: SparkSession, sink: str, schema: T.StructType, key: str, before: int) -> DataFrame:
    """Keys that batches with a smaller number stored; a batch that runs again does not see itself."""
    columns = T.StructType([schema[key], T.StructField("batch", T.LongType())])
    return spark.read.schema(columns).parquet(sink).filter(F.col("batch") < before).select(key)


def append_batch(batch: DataFrame, batch_id: int, sink: str, schema: T.StructType) -> None:
    """Write the rows of a batch, its rejected lines beside them, and its manifest last.

    A batch has folders of its own: one that runs again after a failure
    overwrites what its first attempt left.
    """
    spark = batch.sparkSession
    good, bad = f"{sink}/batch={batch_id}", f"{rejected_path(sink)}/batch={batch_id}"
    batch.filter(F.col("reason").isNull()).select(*schema.fieldNames()).write.mode("overwrite").parquet(good)
    batch.filter(F.col("reason").isNotNull()).select("value", "reason").write.mode("overwrite").parquet(bad)
    record_batch(spark, sink, batch_id, spark.read.schema(schema).parquet(good).count(),
                 spark.read.schema("value string, reason string").parquet(bad).count())


def store_batch(lines: DataFrame, batch_id: int, sink: str, schema: T.StructType, key: str, content: str | None) -> None:
    """Decide about the lines of a micro-batch and write them."""
    rows = delivered(lines, schema, key, content).persist()
    try:
        fresh = first_deliveries(rows.filter(F.col("reason").isNull()), schema, key)
        if batch_id > 0:
            fresh = fresh.join(stored_keys(lines.sparkSession, sink, schema, key, batch_id), key, "left_anti")
        nothing = [F.lit(None).cast("string").alias(c) for c in ("value", "reason")]
        rejected = rows.filter(F.col("reason").isNotNull()).select(*schema.fieldNames(), "value", "reason")
        append_batch(fresh.select(*schema.fieldNames(), *nothing).unionByName(rejected), batch_id, sink, schema)
    finally:
        rows.unpersist()


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: T.StructType,
           key: str, content: str | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Start an ``availableNow`` stream from JSON-lines files in ``source``.

    The row of a key that is delivered first is stored.  Lines that are no JSON,
    have no key or (where ``content`` names a column) no content go to the
    rejected lines with their reason; a later delivery of such a key counts.
    Sink and checkpoint that do not fit each other are refused.
    """
    check_resume(spark, sink, checkpoint)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(source).select(
        "value", *[F.col(f"_metadata.{field}").alias(name) for name, field in _FILE.items()])
    return (
        lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda df, n: store_batch(df, n, sink, schema, key, content)).start()
    )


def ingest_counts(spark: SparkSession, sink: str) -> DataFrame:
    """``outcome, lines``: rows stored and lines rejected by reason."""
    stored = spark.read.parquet(sink).select(F.lit("stored").alias("outcome"))
    rejected = spark.read.parquet(rejected_path(sink)).select(F.col("reason").alias("outcome"))
    return stored.unionByName(rejected).groupBy("outcome").agg(F.count("*").alias("lines"))
