"""Line dedup: drop lines that earlier documents hold, by a sharded minimal perfect hash.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.  A key of
at least ``least_chars`` code points that at least ``least_documents`` documents hold loses
all its lines but those of the smallest ``doc_id``.

1. *Blocks*: a task hashes the lines of its documents and writes, per block of at most
   ``BLOCK_LINES`` lines, the distinct ones sorted by hash, and which line of which
   document is which of them.  However often a line occurs, a block sends it once.
2. *Index*: a shard is a range of the hash, of ``SHARD_LINES`` lines on average.  Over its
   distinct hashes it builds a minimal perfect hash (levels of bit arrays: a key settles on
   the first level where no other key has its place; its number is the bits before it), which
   addresses three plain arrays: a 32-bit fingerprint, the number of documents (up to 255)
   and the smallest ``doc_id``.
3. *Probe*: blocks send their hashes to the shards, one gather per array answers
   them, and answers go back to the block.  No line, and no table of lines, is joined.
4. Documents that lose lines are met by ``doc_id`` and a hash of the text and cut.

Lines are told apart by 96 bits of a 128-bit hash: 64 choose the slot, the fingerprint
confirms it, and distinct lines with equal 64 bits are kept in a side list of the shard.

Null and empty texts are one empty line.  A null ``doc_id`` is larger than any other and
equal to itself; rows are documents, rows of the same ``doc_id`` keep a line together.
All columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.tables import stored
from corpusloom.llm.words import mix

LEAST_CHARS = 10
LEAST_DOCUMENTS = 2
BLOCK_LINES = 1 << 18
SHARD_LINES = 1 << 18
SLOTS_PER_KEY = 1.5  # places a level has for each key that is left
MOST_COUNTED = 255
BLANK = b" \t\n\x0b\x0c\r"
NO_ID = np.iinfo(np.int64).max
_U = np.uint64


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.cumsum(sizes) - sizes
        self.settled = np.unpackbits(bits, bitorder="little").astype(bool)
        self.before = np.cumsum(self.settled) - self.settled

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + _U((2 * level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(keys):
            size = -(-int(len(keys) * SLOTS_PER_KEY + 1) // 8) * 8
            at = cls.places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate([np.empty(0, dtype=np.uint8), *bits]))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """0 .. n-1 of the keys it was built from; any number or -1 for others."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist())):
            at = start + self.places(keys[left], level, size)
            here = self.settled[at]
            out[left[here]] = self.before[at[here]]
            left = left[~here]
        return out


@dataclass
class Lines:
    """Lines by hash and fingerprint, with the documents that hold them."""

    hashes: np.ndarray
    prints: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray

    def merged(self) -> Lines:
        """One entry per line, sorted by (hash, fingerprint)."""
        order = np.lexsort((self.prints, self.hashes))
        h, p = self.hashes[order], self.prints[order]
        heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])])[:len(h)])
        if len(heads) == 0:
            return self
        counts = np.minimum(np.add.reduceat(self.counts[order].astype(np.int64), heads), MOST_COUNTED)
        return Lines(h[heads], p[heads], counts.astype(np.uint8), np.minimum.reduceat(self.firsts[order], heads))


FIELDS = (("hashes", np.uint64), ("prints", np.uint32), ("counts", np.uint8), ("firsts", np.int64))


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _read(table: pa.Table) -> Lines:
    return Lines(**{name: _joined(table[name], kind) for name, kind in FIELDS})


def line_keys(text: bytes | None, least_chars: int) -> Iterator[tuple[int, bytes]]:
    """``(line number, key)`` of the lines that count."""
    for number, line in enumerate((text or b"").lower().split(b"\n")):
        key = line.strip(BLANK)
        if len(key) >= 4 * least_chars or len(key) >= least_chars and len(key.decode("utf-8", "replace")) >= least_chars:
            yield number, key


BLOCK = ("block long, n long, hashes binary, prints binary, counts binary, firsts binary, "
         "doc_ids binary, marks binary, rows binary, numbers binary, refs binary")


def blocks(docs: DataFrame, least_chars: int) -> DataFrame:
    """Distinct lines of runs of documents, and where they stand."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, task = 0, TaskContext.get().partitionId()
        doc_ids, marks, rows, numbers, digests = [], [], [], [], []

        def block() -> pa.RecordBatch:
            ids, row = np.array(doc_ids, dtype=np.int64), np.array(rows, dtype=np.int32)
            pair = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
            h, p = pair[:, 0], (pair[:, 1] >> _U(32)).astype(np.uint32)
            order = np.lexsort((row, p, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (p[order][1:] != p[order][:-1])])[:len(h)]
            fresh = new | np.concatenate([[True], row[order][1:] != row[order][:-1]])[:len(h)]
            refs = np.empty(len(h), dtype=np.int32)
            refs[order] = np.cumsum(new) - 1
            heads = np.flatnonzero(new)
            counts = np.minimum(np.add.reduceat(fresh.astype(np.int64), heads), MOST_COUNTED) if len(h) else heads
            firsts = np.minimum.reduceat(ids[row[order]], heads) if len(h) else heads
            parts = [h[order][heads], p[order][heads], counts.astype(np.uint8), firsts.astype(np.int64),
                     ids, np.array(marks, dtype=np.int64), row, np.array(numbers, dtype=np.int32), refs]
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made]), pa.array([len(heads)]), *[pa.array([x.tobytes()], pa.binary()) for x in parts]],
                [c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                some = False
                for number, key in line_keys(text.as_py(), least_chars):
                    rows.append(len(doc_ids))
                    numbers.append(number)
                    digests.append(xxhash.xxh3_128_digest(key))
                    some = True
                if some:
                    doc_ids.append(NO_ID if doc_id is None else doc_id)
                    marks.append(mark)
                if len(rows) >= BLOCK_LINES:
                    yield block()
                    made += 1
                    doc_ids, marks, rows, numbers, digests = [], [], [], [], []
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), _mark("text"), "text").mapInArrow(one, BLOCK)


def _mark(text: str) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _cuts(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards that sorted hashes fall into, and the bounds of their runs."""
    if bits == 0:
        return np.zeros(1, dtype=np.int64), np.array([0, len(hashes)])
    shard = (hashes >> _U(64 - bits)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    return shard[heads], np.append(heads, len(hashes))


def _dealt(of_blocks: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """Per block and shard the given arrays of the block's lines, and where they begin."""
    kinds = dict(FIELDS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                arrays = {c: np.frombuffer(row[c], dtype=kinds[c]) for c in columns}
                shard, bounds = _cuts(arrays["hashes"], bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(np.full(len(shard), row["block"])), pa.array(bounds[:-1]),
                     *[pa.array([x[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()) for x in arrays.values()]],
                    ["shard", "block", "begin", *columns])

    schema = "shard long, block long, begin long, " + ", ".join(f"{c} binary" for c in columns)
    return of_blocks.select("block", *columns).mapInArrow(deal, schema)


INDEX = "shard long, levels binary, bits binary, prints binary, counts binary, firsts binary, side binary"
SIDE = np.dtype([("hash", np.uint64), ("print", np.uint32), ("count", np.uint8), ("first", np.int64)])


def index_of(shard: int, lines: Lines) -> pa.Table:
    """The arrays of one shard, as a row."""
    lines = lines.merged()
    single = np.concatenate([[True], lines.hashes[1:] != lines.hashes[:-1]])[:len(lines.hashes)]
    keys = lines.hashes[single]
    found = PerfectHash.build(keys)
    slot = found.numbers(keys)
    arrays = []
    for values in (lines.prints, lines.counts, lines.firsts):
        arrays.append(np.empty(len(keys), dtype=values.dtype))
        arrays[-1][slot] = values[single]
    side = np.empty(int((~single).sum()), dtype=SIDE)
    for name, values in zip(SIDE.names, (lines.hashes, lines.prints, lines.counts, lines.firsts)):
        side[name] = values[~single]
    return pa.table([pa.array([shard]), *[pa.array([x.tobytes()], pa.binary()) for x in (found.sizes, found.bits, *arrays, side)]],
                    [c.split()[0] for c in INDEX.split(", ")])


def probe(index: dict, hashes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(documents, smallest doc_id)`` of lines; 0 documents for a line that is not in the index."""
    known = [np.frombuffer(index[c], dtype=k) for c, k in FIELDS[1:]]
    slot = PerfectHash(np.frombuffer(index["levels"], dtype=np.int64), np.frombuffer(index["bits"], dtype=np.uint8)).numbers(hashes)
    good = slot >= 0
    good[good] = known[0][slot[good]] == prints[good]
    counts, firsts = np.zeros(len(hashes), dtype=np.uint8), np.full(len(hashes), NO_ID)
    counts[good], firsts[good] = known[1][slot[good]], known[2][slot[good]]
    side = np.frombuffer(index["side"], dtype=SIDE)
    if len(side):
        others = {(int(s["hash"]), int(s["print"])): s for s in side}
        for i in np.flatnonzero(~good).tolist():
            if (s := others.get((int(hashes[i]), int(prints[i])))) is not None:
                counts[i], firsts[i] = s["count"], s["first"]
    return counts, firsts


def line_index(of_blocks: DataFrame, bits: int) -> DataFrame:
    """One row of arrays per shard of the hash."""
    def build(table: pa.Table) -> pa.Table:
        return index_of(table["shard"][0].as_py(), _read(table))

    return _dealt(of_blocks, [name for name, _ in FIELDS], bits).groupBy("shard").applyInArrow(build, INDEX)


def losses(of_blocks: DataFrame, index: DataFrame, bits: int, least_documents: int) -> DataFrame:
    """``doc_id, mark, lost``: the numbers of the lines that a document loses, for documents that lose any."""
    def answer(probes: pa.Table, arrays: pa.Table) -> pa.Table:
        row = arrays.to_pylist()[0]
        sizes = [len(x.as_py()) // 8 for x in probes["hashes"]]
        counts, firsts = probe(row, _joined(probes["hashes"], np.uint64), _joined(probes["prints"], np.uint32))
        out, at = [], 0
        for begin, size in zip(probes["begin"].to_pylist(), sizes):
            repeated = np.flatnonzero(counts[at:at + size] >= least_documents)
            out.append(((begin + repeated).astype(np.int32).tobytes(), firsts[at:at + size][repeated].tobytes()))
            at += size
        return pa.table([probes["block"], pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())],
                        ["block", "places", "firsts"])

    def decide(own: pa.Table, answers: pa.Table) -> pa.Table:
        block = own.to_pylist()[0]
        ids, marks = (np.frombuffer(block[c], dtype=np.int64) for c in ("doc_ids", "marks"))
        row, number, ref = (np.frombuffer(block[c], dtype=np.int32) for c in ("rows", "numbers", "refs"))
        first = np.full(block["n"], NO_ID)
        first[_joined(answers["places"], np.int32)] = _joined(answers["firsts"], np.int64)
        lost = np.flatnonzero(ids[row] > first[ref])  # ascending, so a document's lines are together
        row, number = row[lost], number[lost]
        heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[:len(row)])
        some = row[heads]
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(row)).astype(np.int32)), pa.array(number))
        return pa.table([pa.array(ids[some], mask=ids[some] == NO_ID), pa.array(marks[some]), lists], ["doc_id", "mark", "lost"])

    answers = _dealt(of_blocks, ["hashes", "prints"], bits).groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        answer, "block long, places binary, firsts binary")
    own = of_blocks.select("block", "n", "doc_ids", "marks", "rows", "numbers", "refs")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        decide, "doc_id long, mark long, lost array<int>").dropDuplicates(["doc_id", "mark"])


@F.pandas_udf(T.StringType())
def without(texts: pd.Series, lost: pd.Series) -> pd.Series:
    """The texts without the given lines; null where nothing is lost."""
    def cut(text: str, gone: np.ndarray) -> str:
        lines, keep = text.split("\n"), np.ones(text.count("\n") + 1, dtype=bool)
        keep[gone] = False
        return "\n".join([lines[i] for i in np.flatnonzero(keep).tolist()])

    return pd.Series([None if t is None or g is None else cut(t, g) for t, g in zip(texts, lost)], dtype=object)


def cleaned(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``row, n_lines, n_dropped, kept``: the whole row as a struct, its lines before, lines lost, and the text left."""
    found = stored(blocks(docs, least_chars), "line-blocks")
    lines = found.agg(F.sum("n")).first()[0] or 0
    bits = max(0, (-(-lines // SHARD_LINES) - 1).bit_length())
    index = stored(line_index(found, bits), "line-index")
    lost = losses(found, index, bits, least_documents)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    met = rows.join(lost, rows["row.doc_id"].cast("long").eqNullSafe(lost["doc_id"]) & (_mark("row.text") == lost["mark"]), "left")
    kept = F.coalesce(without(F.when(F.col("lost").isNotNull(), text), F.col("lost")), text, F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return met.select("row", (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("n_lines"),
                      F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def drop_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The columns of ``docs``; texts that lose lines hold the others."""
    columns = [F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text")).alias(c) if c == "text"
               else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return cleaned(docs, least_documents, least_chars).select(*columns)


def op13(docs: DataFrame) -> DataFrame:
    return cleaned(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS number, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
    SELECT doc_id, number, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
    SELECT doc_id, number, line, first IS NOT NULL AND doc_id > first AS gone FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
