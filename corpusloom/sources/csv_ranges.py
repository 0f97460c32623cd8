"""Multi-line CSV read by byte ranges, however large a file is.

A line break inside a quoted cell is no end of a record, so a range of a file
cannot tell by itself where its first record begins.  It can tell both answers:

1. The text reader cuts the file into ranges at line ends.  Every line is a map
   from the state before it (outside a quoted cell or inside one) to the state
   after it, folded over its quotes in the JVM.  A range composes the maps of its lines
   and keeps, for either state before it, the lines of the record that is open when it
   begins and of the one that is open when it ends.
2. Composition is associative: a window over the ranges of a file gives the state
   before each range, and the range in which an open record began.
3. Ranges are read again, each from its state, and give the records that lie
   inside them; records that cross a border are put together from the kept lines.

Records are parsed by the CSV parser of the engine.  What travels is one row a range and the
lines of records that cross borders; the driver holds 17 bytes a range.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import written

OUTSIDE, INSIDE, CLOSED, START = 0, 1, 2, 3  # CLOSED: right behind a quote that may close a cell
KEEPS = 2  # the map that changes neither state: outside -> outside, inside -> inside
BOM = "\ufeff"
MAX_RANGES = 1 << 24


def line_map(line: Column, sep: str) -> Column:
    """State after a line that begins outside, plus twice the state after one that begins inside."""

    def step(state: Column, before: Column) -> Column:
        """``before`` is what stands between the last quote, or the line's start, and the next quote."""
        opens = F.endswith(before, F.lit(sep)) | (
            (state == START) & before.isin("", BOM)) | ((state == CLOSED) & (before == ""))
        return F.when(state == INSIDE, F.lit(CLOSED)).when(opens, F.lit(INSIDE)).otherwise(F.lit(OUTSIDE))

    def after(state: int) -> Column:
        parts = F.split(line, '"', -1)
        end = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(state), step)
        return F.when(end == INSIDE, 1).otherwise(0)

    # Quotes in even runs, such as doubled ones, leave either state: a run that opens a cell closes it again.
    odd = F.contains(F.replace(line, F.lit('""'), F.lit("")), F.lit('"'))
    return F.when(odd, after(START) + 2 * after(INSIDE)).otherwise(KEEPS).cast("tinyint")


class Walk:
    """Cuts lines into records, from a known state before the first line."""

    def __init__(self, state: int):
        self.began_inside = state == INSIDE
        self.state = state
        self.head: list[str] | None = None  # the rest of the record that was open before
        self.open: list[str] = []

    def feed(self, line: str, code: int) -> list[str] | None:
        """The lines of the record that ends with this one, if it began in the walk."""
        if self.state == OUTSIDE and line in ("", "\r"):
            return None
        self.open.append(line)
        self.state = code >> self.state & 1
        if self.state == INSIDE:
            return None
        record, self.open = self.open, []
        if self.began_inside and self.head is None:
            self.head = record
            return None
        return record

    def feed_all(self, lines: list[str], codes: np.ndarray) -> list[str]:
        """The records that end with one of the lines, as ``feed`` gives them for one line after the other.

        Lines that keep either state are passed in runs."""
        records, begin = [], 0
        for at in [*np.flatnonzero(codes != KEEPS).tolist(), len(lines)]:
            if self.state == INSIDE:
                self.open += lines[begin:at]
            else:
                records += [line for line in lines[begin:at] if line not in ("", "\r")]
            if at < len(lines):
                record = self.feed(lines[at], int(codes[at]))
                if record is not None:
                    records.append("\n".join(record))
            begin = at + 1
        return records


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(key, first, last)`` of the runs of equal keys."""
    heads = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()] if len(keys) else []
    for a, b in zip(heads, [*heads[1:], len(keys)]):
        yield int(keys[a]), a, b


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    place = [F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start", "file_block_length")]
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64(*place).alias("range"), F.xxhash64(place[0]).alias("path"), place[1].alias("start"),
        F.col("value").alias("line"), line_map(F.col("value"), sep).alias("code"))


SUMMARY = ("range long, path long, start long, after_outside int, after_inside int, ends boolean, "
           "first string, head string, open_outside string, open_inside string")


def _summaries(lines: DataFrame) -> DataFrame:
    """Per range what it does to either state, and the lines of the records that are open at its borders."""

    names = [c.split()[0] for c in SUMMARY.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.string()] * 4]

    def text(lines: list[str] | None) -> str | None:
        return "\n".join(lines) if lines else None

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, walks, first = None, (None, None), (Walk(OUTSIDE), Walk(INSIDE)), None

        def summary() -> tuple:
            outside, inside = walks
            return (now, *place, outside.state, inside.state, inside.head is not None,
                    text(first), text(inside.head), text(outside.open), text(inside.open))

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done) if done else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            done = []
            lines, codes = batch.column(3).to_pylist(), batch.column(4).to_numpy()
            for key, a, b in _runs(batch.column(0).to_numpy()):
                if key != now:
                    if now is not None:
                        done.append(summary())
                    now, walks, first = key, (Walk(OUTSIDE), Walk(INSIDE)), None
                    place = batch.column(1)[a].as_py(), batch.column(2)[a].as_py()
                records = walks[OUTSIDE].feed_all(lines[a:b], codes[a:b])
                if place[1] == 0 and first is None and records:
                    first = records[:1]
                walks[INSIDE].feed_all(lines[a:b], codes[a:b])
            yield rows(done)
        if now is not None:
            yield rows([summary()])

    return lines.mapInArrow(one, SUMMARY)


def _resolved(summaries: DataFrame) -> DataFrame:
    """Add ``state``, the state before the range, and ``owner``, where the record began that is open then."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    # A range that ends in one state whatever was before hides all earlier ones; between such ranges states only swap.
    fixed = F.when(F.col("after_outside") == F.col("after_inside"), F.col("after_outside"))
    swap = F.when((F.col("after_outside") == INSIDE) & (F.col("after_inside") == OUTSIDE), 1).otherwise(0)
    counted = summaries.withColumn("swaps", F.sum(swap).over(upto)).withColumn("fixed", fixed)
    last = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "swaps")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.max("swaps").over(before), F.lit(0))
    state = F.when(last.isNull(), so_far % 2).otherwise((last["fixed"] + so_far - last["swaps"]) % 2)
    known = counted.withColumn("state", state.cast("int"))
    begins = F.when((F.col("state") == OUTSIDE) | F.col("ends"), F.col("start"))
    return known.withColumn("owner", F.last(begins, ignorenulls=True).over(before))


def _crossing(ranges: DataFrame) -> DataFrame:
    """``first, record`` of the records that cross a border of ranges."""
    outside = F.col("state") == OUTSIDE
    passing = ~outside & ~F.col("ends")
    rest = F.when(outside, F.lit(None)).when(passing, F.col("open_inside")).otherwise(F.col("head"))
    begun = F.when(outside, F.col("open_outside")).when(passing, F.lit(None)).otherwise(F.col("open_inside"))
    pieces = ranges.select("path", "start", F.explode(F.array(
        F.struct(F.col("owner").alias("owner"), rest.alias("text")), F.struct(F.col("start").alias("owner"), begun.alias("text")))).alias("p"),
        ((F.col("start") == 0) & F.col("first").isNull()).alias("first")).filter("p.text IS NOT NULL")
    return pieces.groupBy("path", "p.owner").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "p.text"))).alias("texts"),
    ).select("first", F.array_join(F.col("texts.text"), "\n").alias("record"))


def _inside(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """``first, record`` of the records that lie inside a range."""
    known = ranges.select("range", "state").toArrow()
    if known.num_rows > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: read larger ones")
    keys, states = known["range"].to_numpy(), known["state"].to_numpy().astype(np.int8)
    order = np.argsort(keys)
    shared = lines.sparkSession.sparkContext.broadcast((keys[order], states[order]))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, states = shared.value
        now, walk, ahead = None, None, False
        for batch in batches:
            first, records = [], []
            lines, codes = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            for key, a, b in _runs(batch.column(0).to_numpy()):
                if key != now:
                    at = int(np.searchsorted(keys, key))
                    if at == len(keys) or keys[at] != key:
                        raise RuntimeError("the files or their ranges changed while they were read")
                    now, walk, ahead = key, Walk(int(states[at])), batch.column(1)[a].as_py() == 0
                found = walk.feed_all(lines[a:b], codes[a:b])
                first += [ahead and i == 0 for i in range(len(found))]
                records += found
                ahead = ahead and not found
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.bool_()), pa.array(records, pa.string())], ["first", "record"])

    return lines.select("range", "start", "line", "code").mapInArrow(one, "first boolean, record string")


def read_csv_ranges(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Text columns of CSV files with a header, a byte-order mark or none, doubled quotes and
    multi-line cells; all files must have the same header.

    A cell is quoted if it begins with a quote; other quotes are text.  Records end with a
    newline, a carriage return before it belongs to the break.  Blank lines between records are
    skipped; a cell that is never closed reaches the end of its file."""
    lines = _lines(spark, path, sep)
    ranges = written(_resolved(written(_summaries(lines), "csv-summaries")), "csv-ranges")
    crossing = _crossing(ranges)
    headers = ranges.select(F.col("first").alias("record")).filter("record IS NOT NULL").unionByName(
        crossing.filter("first").select("record")).select(_trimmed("record").alias("record")).distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"files with different headers under {path}")
    names = next(csv.reader(io.StringIO(headers[0][0], newline=""), delimiter=sep), []) if headers else []
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    if not names:
        return spark.createDataFrame([], T.StructType())
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    records = _inside(lines, ranges).unionByName(crossing).filter("NOT first")
    cells = F.from_csv(_trimmed("record"), ", ".join(f"_c{i} string" for i in range(len(names))), options)
    return records.select(cells.alias("cells")).select(*[F.col(f"cells._c{i}").alias(name) for i, name in enumerate(names)])


def _trimmed(record: str) -> Column:
    """The record without byte-order mark and the carriage return of its line break."""
    return F.regexp_replace(record, rf"\A{BOM}|\r\z", "")
