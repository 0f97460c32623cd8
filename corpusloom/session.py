"""Session helpers: configuration and the shared folder for cut lineages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job benefits from; sizes that depend on the cluster (executor
# memory, shuffle partitions) stay with the submitter, AQE adapts the rest.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long documents: keep an Arrow batch in the tens of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master (tests, one machine) may fall back to a fresh temporary
    folder; on a cluster a missing setting is an error, because a machine-local
    path would be lost together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: nothing that follows repeats the work."""
    path = f"{shared_folder(df.sparkSession)}/corpusloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 16 << 20  # of an Arrow batch; a larger row goes alone
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends Python batches of at most ``BATCH_BYTES``.

    Batches are counted in rows unless told otherwise, and rows can be long."""
    settings = df.sparkSession.conf
    if int(settings.get(_BATCH_SETTING, str(2**31 - 1)).rstrip("bB")) > BATCH_BYTES:
        settings.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df
