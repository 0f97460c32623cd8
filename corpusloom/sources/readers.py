"""Readers: explicit schemas, explicit row order, tolerant of missing inputs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import strip
from corpusloom.operators.order import FILE_ROW_BITS, MAX_FILES, MAX_SOURCES, order_key
from corpusloom.operators.rows import keep
from corpusloom.sources.csv_ranges import read_csv_ranges

log = logging.getLogger(__name__)
FILES_PER_LOOKUP = 50_000  # file ordinals in one broadcast lookup
_CORRUPT = "_corrupt_record"


def existing(spark: SparkSession, sources: Sequence[tuple[str, str]]) -> list[tuple[int, str, DataFrame]]:
    """``(position, name, frame)`` of every readable source; absent ones are
    skipped with a warning and keep their position free."""
    found = []
    for position, (name, path) in enumerate(sources):
        try:
            found.append((position, name, spark.read.parquet(path)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("Skipping (not found): %s", path)
    return found


def _metadata_path(listed: str) -> str:
    """A listed file the way ``_metadata.file_path`` spells it."""
    return "file:/" + listed[len("file:///"):] if listed.startswith("file:///") else listed


def _ordered(spark: SparkSession, position: int, frame: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one source with ``ord`` = (source, file, row in file)."""
    files = sorted(map(_metadata_path, frame.inputFiles()))
    if len(files) > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} files in one source")
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    if len(files) == 1:
        return frame.select(order_key(F.lit(position), row).alias("ord"), *columns)
    # A driver already lists the files of a scan; their ordinals travel as
    # lookups of bounded size, one per range of paths, and the range on the path
    # limits each part of the scan to its own files.
    parts = []
    for start in range(0, len(files), FILES_PER_LOOKUP):
        group = files[start:start + FILES_PER_LOOKUP]
        lookup = spark.createDataFrame(
            list(zip(group, range(start, start + len(group)))), "__file string, __file_ord bigint"
        )
        df = frame.filter(path.between(group[0], group[-1])).select(
            *columns, path.alias("__file"), row.alias("__row")
        ).join(F.broadcast(lookup), "__file")
        place = F.shiftleft("__file_ord", FILE_ROW_BITS) + F.col("__row")
        parts.append(df.select(order_key(F.lit(position), place).alias("ord"), *columns))
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out


def first_rows(spark: SparkSession, path: str, cap: int) -> DataFrame:
    """The first ``cap`` rows of a Parquet source, by file and row in the file.

    The files' footers tell their numbers of rows; a prefix sum over them says which files
    are needed, and only these are read, the last one up to the row where the cap ends.
    """
    frame = spark.read.parquet(path)
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = frame.inputFiles()
    if len(files) > MAX_FILES:
        raise ValueError(f"more than {MAX_FILES} files in one source")
    # No column is asked for, so a task answers from the footer.
    counts = frame.select(file.alias("file")).groupBy("file").agg(F.count("*").alias("rows")).collect()
    needed, left = [], cap
    for name, rows in sorted(map(tuple, counts)):
        if left <= 0:
            break
        needed.append((name, min(rows, left)))
        left -= rows
    if not needed:
        return frame.filter(F.lit(False))
    last, taken = needed[-1]
    is_file = len(files) == 1 and unquote(files[0]).endswith(path.split(":", 1)[-1].lstrip("/"))
    base = {} if is_file else {"basePath": path}  # partition columns come from the folders below
    part = spark.read.schema(frame.schema).options(**base).parquet(*[unquote(name) for name, _ in needed])
    return part.filter((file != last) | (row < taken))


def read_corpora(spark: SparkSession, sources: Sequence[tuple[str, str]]) -> DataFrame:
    """``(source, ord, text)`` of all sources in list order, pruned to ``text``."""
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    out = None
    for position, name, frame in existing(spark, sources):
        rows = _ordered(spark, position, frame, ["text"]).select(
            F.lit(name).alias("source"), "ord", "text"
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "source string, ord bigint, text string")
    return out


def fill_cores(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores.

    A table of few or large row groups would leave most cores idle in the
    text-heavy steps; it is also small enough to move.  A scan with at least one
    split per core, as any large table has, is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a JSON-lines file plus ``malformed`` (true where a line is not
    JSON); blank lines are no rows.  A value of an unexpected type becomes null
    without making its line malformed."""
    return parse_lines(spark.read.text(path), schema)


def parse_lines(lines: DataFrame, schema: T.StructType, *keep_columns: str) -> DataFrame:
    """``read_jsonl`` for the lines in column ``value``; ``keep_columns`` stay."""
    as_text = T.StructType(
        [T.StructField(f.name, f.dataType if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
                       else T.StringType()) for f in schema]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    written = lines.filter(strip(F.col("value")) != "")
    parsed = written.select(*keep_columns, F.from_json("value", as_text, options).alias("r"))
    return parsed.select(
        *keep_columns,
        *[F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name)
          if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f"r.{f.name}").alias(f.name)
          for f in schema],
        F.col(f"r.{_CORRUPT}").isNotNull().alias("malformed"),
    )


def valid_rows(parsed: DataFrame) -> DataFrame:
    return keep(parsed, ~F.col("malformed")).drop("malformed")


def _counters() -> list[Column]:
    """Lines read, rows kept, lines malformed."""
    return [
        F.count("*").alias("total_read"),
        F.count_if(~F.col("malformed")).alias("kept"),
        F.count_if("malformed").alias("malformed"),
    ]


def read_counts(parsed: DataFrame) -> DataFrame:
    """Counters of the lines, as one row."""
    return parsed.agg(*_counters())


def observed_reads(parsed: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``parsed``, and its counters as they are gathered by the first job that reads it all.

    The counters ride along with that job's tasks, so the lines are not read once more; of a task that
    runs again only the run that counts is counted.  Asking for them waits for the job."""
    observation = Observation()

    def counters() -> DataFrame:
        seen = observation.get
        names = ["total_read", "kept", "malformed"]
        return parsed.sparkSession.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names))

    return parsed.observe(observation, *_counters()), counters


def read_csv(spark: SparkSession, path: str, defaults: dict[str, str | None]) -> DataFrame:
    """Text columns of a CSV with a header, byte-order mark, doubled quotes and
    multi-line cells.  ``defaults`` names the wanted columns and the value of a
    column the file does not have.

    Files are read one per task; where the largest would keep its task longer than a
    split's size is meant to, all are cut into ranges, with the same rows.
    """
    sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()
    if (sizes[0] or 0) > _split_bytes(spark):
        raw = read_csv_ranges(spark, path)
    else:
        raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"',
                             encoding="UTF-8", inferSchema=False)
    return raw.select(*[
        F.col(f"`{name}`") if name in raw.columns else F.lit(value).cast("string").alias(name)
        for name, value in defaults.items()
    ])


def _split_bytes(spark: SparkSession) -> int:
    """Bytes of a file that one task is meant to read."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return size(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def table_stats(frame: DataFrame) -> DataFrame:
    """Row count and stored bytes of a file-based frame, per input file first
    so that only file sizes are aggregated."""
    files = frame.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).groupBy("path", "size").agg(F.count("*").alias("rows"))
    return files.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )
