"""Importance resampling towards a target corpus by hashed n-gram features.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Features are
all runs of 1 to ``longest`` words of a text, joined by a space and repeated as they
occur; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.

The texts of a block are joined with a separator that no word holds.  One pass of one
regular expression finds the words of the whole block, ``searchsorted`` over the
texts' offsets names the text of each word, and runs that leave their text are
masked before ``bincount``.  The CRC of a run is put together from those of its words:
appending bytes to a text is a linear map of its CRC, so no run is ever spelled out.

A bucket's gain is the log ratio of its smoothed shares in the target and in the raw
corpus, in thousandths; a document's weight is the mean gain of its features, its
score adds Gumbel noise from its ``doc_id``, and the highest scores are a draw without
replacement.  A task sends its buckets' sums, so tables of ``buckets`` rows are all
that is gathered; the draw's border and ranks come from the counts of each score, an
integer in a range of about 200,000 whatever the input.

Null and empty texts have no features and weight 0.  A null ``doc_id`` draws the noise
of the empty id and is larger than any other; repeated rows are rows of their own (equal
rows get neighbouring ranks); extra columns are not read.  Without target or documents
all gains are 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tables import stored

LONGEST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
DRAW_PERCENT = 25
SEED = 7

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\n"
BLOCK_BYTES = 4_000_000  # texts joined at once; one longer text is handled alone
TABLED = 64  # longest word, in bytes, whose CRC is computed in columns

_CRC_BYTE = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)


def _zero_byte(register: np.ndarray) -> np.ndarray:
    """The CRC register after one more zero byte."""
    return (register >> np.uint32(8)) ^ _CRC_BYTE[register & np.uint32(255)]


def _append_tables() -> np.ndarray:
    """``[n, j, v]``: the register byte ``j`` of value ``v`` after ``n`` zero bytes."""
    tables = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(TABLED):
        tables.append(_zero_byte(tables[-1]))
    return np.stack(tables)


_APPEND = _append_tables()


def word_crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of every word, computed for all words of a block byte by byte."""
    by_length = np.argsort(length, kind="stable")
    at, size = start[by_length], length[by_length]
    register = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
    longer = int(np.searchsorted(size, TABLED, side="right"))
    for k in range(int(size[longer - 1]) if longer else 0):
        active = slice(int(np.searchsorted(size, k, side="right")), longer)
        register[active] = (register[active] >> np.uint32(8)) ^ _CRC_BYTE[(register[active] ^ data[at[active] + k]) & np.uint32(255)]
    crcs = np.empty(len(at), dtype=np.uint32)
    crcs[by_length] = ~register
    for i in np.flatnonzero(length > TABLED).tolist():
        crcs[i] = zlib.crc32(data[start[i]:start[i] + length[i]])
    return crcs


def append_words(crcs: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray, words: np.ndarray) -> np.ndarray:
    """CRC-32 of each text of CRC ``crcs``, a space and the word that follows it."""
    spaced = ~(((~crcs) >> np.uint32(8)) ^ _CRC_BYTE[(~crcs ^ np.uint32(32)) & np.uint32(255)])
    n = np.minimum(length, TABLED)
    moved = words.copy()
    for j in range(4):
        moved ^= _APPEND[n, j, (spaced >> np.uint32(8 * j)) & np.uint32(255)]
    for i in np.flatnonzero(length > TABLED).tolist():
        moved[i] = zlib.crc32(data[start[i]:start[i] + length[i]], int(spaced[i]))
    return moved


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` of runs of rows; null is empty."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts.cast(pa.large_binary())):
        body = text.as_py() or b""
        if run and size + len(body) > BLOCK_BYTES:
            yield first, run
            first, size, run = i, 0, []
        run.append(body)
        size += len(body)
    if run:
        yield first, run


def block_features(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of every text of the block, and per run length ``(text, bucket)`` of its features."""
    joined = SEPARATOR.join(texts).lower()  # of bytes: A-Z only
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    spans = np.fromiter(chain.from_iterable(map(re.Match.span, WORD.finditer(joined))), dtype=np.int64).reshape(-1, 2)
    start, length = spans[:, 0], spans[:, 1] - spans[:, 0]
    data = np.frombuffer(joined, dtype=np.uint8)
    text_of = np.searchsorted(offsets, start, side="right") - 1
    words = word_crcs(data, start, length)
    runs, crcs = [(text_of, (words % np.uint32(buckets)).astype(np.int64))], words
    for extra in range(1, longest):
        if len(words) <= extra:
            break
        crcs = append_words(crcs[:len(words) - extra], data, start[extra:], length[extra:], words[extra:])
        inside = text_of[extra:] == text_of[:len(words) - extra]
        runs.append((text_of[extra:][inside], (crcs[inside] % np.uint32(buckets)).astype(np.int64)))
    return np.bincount(text_of, minlength=len(texts)), runs


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often the features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in text_blocks(batch.column(0)):
                for _, found in block_features(texts, longest, buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of every bucket, in thousandths, floored."""
    all_raw, all_target, n = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log(((t + 1) * (all_raw + n)) / ((s + 1) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for first, texts in text_blocks(batch.column(1)):
                n_words, runs = block_features(texts, longest, len(gain))
                count = sum(np.bincount(t, minlength=len(texts)) for t, _ in runs)
                total = sum(np.bincount(t, weights=gain[b], minlength=len(texts)) for t, b in runs)  # integers, exact
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(n_words.astype(np.int64)), pa.array(count.astype(np.int64)),
                     pa.array(total.astype(np.int64) // np.maximum(count, 1))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        one, "doc_id long, n_words long, n_features long, weight long")


def scored(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weigh(docs, gain, longest).withColumn("score", F.col("weight") + noise)


def draw(rows: DataFrame, percent: int = DRAW_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` with ``rank``, from 1, of the ``percent`` of the eligible rows that have the highest scores."""
    spark = rows.sparkSession
    able = F.col("n_words") >= least_words
    counts = rows.filter(able).groupBy("score").agg(F.count("*").alias("n")).toArrow().sort_by([("score", "descending")])
    score, n = counts["score"].to_numpy(), counts["n"].to_numpy()
    drawn = int(n.sum()) * percent // 100
    before = np.cumsum(n) - n
    reached = before < drawn
    if not reached.any():
        return rows.withColumn("rank", F.lit(None).cast("long"))
    border = int(score[reached].min())
    places = spark.createDataFrame(list(zip(score[reached].tolist(), before[reached].tolist())), "score long, higher long")
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features")
    top = able & (F.col("score") >= border)
    ranked = rows.filter(top).withColumn("rank", F.row_number().over(among)).join(places, "score").withColumn(
        "rank", F.col("rank") + F.col("higher"))
    return ranked.select(*rows.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        rows.filter(~top).withColumn("rank", F.lit(None).cast("long")))


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = stored(scored(docs, benchmark), "resampling-scores")
    return draw(rows).select("doc_id", "n_features", "weight", "score", "rank")


def _sql_features(name: str, table: str) -> str:
    """Every feature of a table with its row."""
    return rf"""
{name}_texts AS (SELECT {"doc_id" if table == "documents" else "item_id"} AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table}),
{name} AS (SELECT id, unnest(words) AS feature FROM {name}_texts
    UNION ALL SELECT id, unnest(list_transform(list_zip(words[:len(words) - 1], words[2:]), lambda p: p[1] || ' ' || p[2]))
    FROM {name}_texts WHERE len(words) > 1)"""


SQL = rf"""
WITH RECURSIVE steps AS (
    SELECT i, i::BIGINT AS crc, 0 AS step FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN crc % 2 = 1 THEN xor(3988292384, crc // 2) ELSE crc // 2 END, step + 1 FROM steps WHERE step < 8),
crc_table AS (SELECT list(crc ORDER BY i) AS entries FROM steps WHERE step = 8),{_sql_features("raw", "documents")},{_sql_features("target", "benchmark")},
distinct_features AS (SELECT DISTINCT feature FROM (SELECT feature FROM raw UNION ALL SELECT feature FROM target)),
buckets AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, strlen(feature) + 1), lambda k: ('0x' || hex(encode(feature))[2 * k - 1 : 2 * k])::BIGINT)),
        lambda c, b: xor(c // 256, entries[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
    FROM distinct_features, crc_table),
raw_counts AS (SELECT bucket, count(*) AS s FROM raw JOIN buckets USING (feature) GROUP BY bucket),
target_counts AS (SELECT bucket, count(*) AS t FROM target JOIN buckets USING (feature) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM raw) AS all_s, (SELECT count(*) FROM target) AS all_t),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000))::DOUBLE
        / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
    FROM raw_counts LEFT JOIN target_counts USING (bucket), sums),
weights AS (SELECT id, count(*) AS n_features, (floor(sum(gain)::DOUBLE / count(*)))::BIGINT AS weight
    FROM raw JOIN buckets USING (feature) JOIN gain USING (bucket) GROUP BY id),
scores AS (SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || id)[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM raw_texts LEFT JOIN weights USING (id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS eligible
    FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * eligible // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranked USING (doc_id)
"""
