"""Phrase collocations: a multikey three-way quicksort of suffix pointers.

A-Z is lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into
words ``[^\\x20\\x09]+``.  Everything is per ``lang`` (null: ``und``).  A suffix is a place in a
piece and the up to ``longest`` words from there; a phrase's count is the number of
suffixes that begin with it.

1. *Words* are counted per lang and named by a 64-bit hash of lang and word.  The table of
   words proves that no two have the same name; if two had, the next seed is taken.
2. *Routing*: suffixes go to the shard of their first two words, so a shard holds all
   suffixes of its phrases.  A task sends equal suffixes once, with their number, so
   however often a phrase occurs, a shard gets it once from each run of ``RUN_TOKENS``
   words; a run's words travel once per shard, suffixes refer to them.
3. *Sorting*: a shard partitions pointers to its suffixes into smaller, equal and larger
   by one word; the equal ones go on with the next word, down to ``longest`` words.  The size of
   an equal partition is the count of its phrase; a partition that is smaller than ``least`` is
   abandoned, since it holds no phrase that is frequent enough.  Partitions of at most
   ``SMALL`` suffixes are sorted together.
4. *Scores* are joins of the frequent phrases with the counts of their parts, in exact
   decimal arithmetic; a phrase inside a longer candidate that is nearly as frequent goes.

Null and empty texts have no words.  Repeated rows count again, ``doc_id`` and extra columns
are not read.  Equal scores and counts go by the phrase in UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tables import bounded_batches, stored
from corpusloom.llm.words import mix

LONGEST = 3  # words of a phrase; the packing of a run's suffixes allows 2 or 3
LEAST = 10
CONTAINED_PERCENT = 50
REPORTED = 2_000
CHUNK_BYTES = 4_000_000  # text split at once, longer only for a longer piece
RUN_TOKENS = 1 << 21  # words (and so distinct words) of a run: 3 * 21 bits are a suffix
SHARD_TOKENS = 1 << 20
SMALL = 2_048
SALTS = 64
SEEDS = 5
CUT = b"\xff"  # in no UTF-8 text
_BITS = 21
_U = np.uint64
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
_TABLE[9] = 32
for _mark in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_mark] = CUT[0]
_TABLE = bytes(_TABLE)


def chunks(texts: list[bytes]) -> Iterator[bytes]:
    """The texts, lower-cased and with every end of a piece marked, in parts that end with a piece."""
    body, at = CUT.join(texts).translate(_TABLE), 0
    while at < len(body):
        end = len(body) if len(body) - at <= CHUNK_BYTES else body.rfind(CUT, at, at + CHUNK_BYTES)
        if end < 0:
            end = body.find(CUT, at + CHUNK_BYTES)
            end = len(body) if end < 0 else end
        yield body[at:end]
        at = end + 1


def tokens(lang: str, texts: list[bytes], seed: int) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
    prefix = lang.encode() + CUT
    for chunk in chunks(texts):
        words = np.array([CUT, *chunk.replace(CUT, b" \xff ").split()], dtype=object)
        codes, distinct = pd.factorize(words)
        codes = codes[1:].astype(np.int32) - np.int32(1)
        del words  # while the part is in use, only its distinct words are held
        names = np.array([xxhash.xxh3_64_intdigest(prefix + w, seed) for w in distinct[1:]], dtype=np.uint64)
        yield lang, codes, distinct[1:].tolist(), names


def tokens_by_lang(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
    """``(lang, code of every word, words by code, their names)`` of parts of the texts; the end of a piece is code -1.

    Texts of a lang are gathered up to ``CHUNK_BYTES``, whatever the batch holds."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            if text.is_valid:
                by_lang.setdefault(lang, []).append(text.as_py())
                size[lang] = size.get(lang, 0) + len(by_lang[lang][-1])
                if size[lang] >= CHUNK_BYTES:
                    del size[lang]
                    yield from tokens(lang, by_lang.pop(lang), seed)
        while by_lang:
            yield from tokens(*by_lang.popitem(), seed)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def words_of(docs: DataFrame, seed: int) -> DataFrame:
    """``name, lang, word, f`` of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, words, names in tokens_by_lang(batches, seed):
            if words:
                n = np.bincount(codes[codes >= 0], minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array([lang] * len(words), pa.string()),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64))], ["name", "lang", "word", "f"])

    return _texts(docs).mapInArrow(count, "name long, lang string, word string, f long").groupBy(
        "name", "lang", "word").agg(F.sum("f").alias("f"))


def named_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """The table of words under a seed that gives them different names, none of them 0."""
    for seed in range(SEEDS):
        words = stored(words_of(docs, seed), "collocation-words")
        same = words.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1 OR name = 0")
        if same.isEmpty():
            return words, seed
    raise RuntimeError(f"{SEEDS} seeds gave two words the same name")


ROUTED = "shard int, names binary, codes binary, counts binary"


def suffixes(docs: DataFrame, seed: int, bits: int, longest: int) -> DataFrame:
    """Distinct suffixes of runs of words, with their numbers, dealt to shards by their first two words.

    ``codes`` are ``longest`` arrays of places in ``names``, from 1; 0 is behind the piece's end."""

    def run(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
        # Behind each part stands an end, so that no suffix reaches into the next one.  The arrays of a run are let go as
        # soon as they have served, as a run is what a task holds most of.
        places = sum(len(codes) + longest for codes, _, _ in parts)
        named, begins, at = np.zeros(places + 1, dtype=np.uint64), np.zeros(places, dtype=bool), 0
        for codes, names, own in parts:
            np.append(names, _U(0)).take(codes, out=named[at + 1:at + 1 + len(codes)], mode="wrap")  # code -1 is the end
            begins[at:at + own] = True
            at += len(codes) + longest
        parts.clear()
        codes, distinct = pd.factorize(named)  # 0 gets code 0
        del named
        codes = np.append(codes[1:].astype(np.int32), np.zeros(longest, dtype=np.int32))
        packed = np.zeros(places, dtype=np.int64)
        for k in range(longest):
            following = codes[k:k + places]
            begins &= following > 0
            packed <<= _BITS
            np.bitwise_or(packed, following, out=packed, where=begins)
        del codes, following
        low = (1 << _BITS) - 1
        packed = packed[packed >> (_BITS * (longest - 2)) & low > 0]
        packed.sort()
        heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])[:len(packed)])
        counts = np.diff(np.append(heads, len(packed))).astype(np.uint32)
        packed = packed[heads]
        columns = [(packed >> (_BITS * (longest - 1 - k)) & low).astype(np.int32) for k in range(longest)]
        del packed, heads
        route = distinct[columns[1]]
        route = mix(route)
        route += distinct[columns[0]] * _U(3)
        shard = (mix(route) >> _U(64 - bits)).astype(np.int32) if bits else np.zeros(len(route), dtype=np.int32)
        del route
        order = np.argsort(shard, kind="stable").astype(np.int32)
        shard, columns, counts = shard[order], [c[order] for c in columns], counts[order]
        del order
        heads = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])[:len(shard)])
        rows = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(shard)]):
            local, used = pd.factorize(np.concatenate([[0], *[c[a:b] for c in columns]]))
            kind = np.uint16 if len(used) < 1 << 16 else np.uint32
            rows.append((int(shard[a]), distinct[used[1:]].tobytes(), local[1:].astype(kind).tobytes(), counts[a:b].tobytes()))
        del shard, columns, counts
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["shard", "names", "codes", "counts"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for _, codes, _, names in tokens_by_lang(batches, seed):
            for a in range(0, len(codes), RUN_TOKENS // 2):  # suffixes begin in the first half of a run, and may end behind it
                part = codes[a:a + RUN_TOKENS // 2 + longest - 1]
                if size + len(part) + longest > RUN_TOKENS - 2 and parts:
                    yield run(parts)  # empties the list
                    size = 0
                parts.append((part, names, min(len(codes) - a, RUN_TOKENS // 2)))
                size += len(part) + longest
        if parts:
            yield run(parts)

    return _texts(docs).mapInArrow(deal, ROUTED)


def multikey_quicksort(words: np.ndarray, weights: np.ndarray, least: int, small: int = SMALL) -> list[tuple[np.ndarray, np.ndarray]]:
    """Frequent phrases of at least two words among suffixes.

    ``words[k]`` is word ``k`` of every suffix, 0 behind the end.  Returns, per number of words
    from two on, a pointer to one suffix of each phrase and the phrase's count."""
    longest = len(words)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(longest + 1)]
    rest, rest_depth = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int8)]
    open_ = [(np.arange(words.shape[1]), 0)]
    while open_:
        pointers, depth = open_.pop()
        if len(pointers) == 0 or weights[pointers].sum() < least:
            continue
        if len(pointers) <= small:
            rest.append(pointers)
            rest_depth.append(np.full(len(pointers), depth, dtype=np.int8))
            continue
        keys = words[depth][pointers]
        pivot = np.sort(keys[np.linspace(0, len(keys) - 1, 9).astype(np.int64)])[4]
        open_.append((pointers[keys < pivot], depth))
        open_.append((pointers[keys > pivot], depth))
        equal = pointers[keys == pivot]
        size = weights[equal].sum()
        if pivot and size >= least:
            if depth:
                found[depth + 1].append((equal[:1], np.array([size])))
            if depth + 1 < longest:
                open_.append((equal, depth + 1))
    # The small partitions: one sort puts the equal suffixes of all of them together.
    pointers, depth = np.concatenate(rest), np.concatenate(rest_depth)
    order = np.lexsort([words[k][pointers] for k in reversed(range(longest))])
    pointers, depth = pointers[order], depth[order]
    changed = np.zeros(len(pointers), dtype=bool)
    changed[:1] = True
    for k in range(longest):
        key = words[k][pointers]
        changed[1:] |= key[1:] != key[:-1]
        heads = np.flatnonzero(changed)
        if k and len(heads):
            sizes = np.add.reduceat(weights[pointers], heads)
            good = (sizes >= least) & (key[heads] > 0) & (depth[heads] <= k)  # deeper partitions have told this count
            found[k + 1].append((pointers[heads[good]], sizes[good]))
    return [(np.concatenate([np.empty(0, dtype=np.int64), *[p for p, _ in f]]),
             np.concatenate([np.empty(0, dtype=np.int64), *[n for _, n in f]])) for f in found[2:]]


def frequent_phrases(docs: DataFrame, seed: int, tokens: int, longest: int, least: int) -> DataFrame:
    """``phrase, a``: phrases of 2 to ``longest`` words, as names of words, that occur at least ``least`` times."""
    bits = max(0, (-(-tokens // SHARD_TOKENS) - 1).bit_length())

    def sort(shard: pa.Table) -> pa.Table:
        named, coded, counted = ([x.as_buffer() for x in shard.column(c)] for c in ("names", "codes", "counts"))
        named = [np.frombuffer(x, dtype=np.uint64) for x in named]
        known = np.unique(np.concatenate([np.zeros(1, dtype=np.uint64), *named]))
        total = sum(x.size for x in counted) // 4
        words, weights, at = np.empty((longest, total), dtype=np.int32), np.empty(total, dtype=np.int64), 0
        for mine, codes, n in zip(named, coded, counted):
            n = np.frombuffer(n, dtype=np.uint32)
            kind = np.uint16 if codes.size == 2 * longest * len(n) else np.uint32
            ids = np.append(0, np.searchsorted(known, mine)).astype(np.int32)
            words[:, at:at + len(n)] = ids[np.frombuffer(codes, dtype=kind)].reshape(longest, -1)
            weights[at:at + len(n)] = n
            at += len(n)
        phrases, counts = [], []
        for size, (pointers, n) in enumerate(multikey_quicksort(words, weights, least), 2):
            phrases += known[words[:size, pointers]].view(np.int64).T.tolist()
            counts += n.tolist()
        return pa.table([pa.array(phrases, pa.list_(pa.int64())), pa.array(counts, pa.int64())], ["phrase", "a"])

    return suffixes(docs, seed, bits, longest).groupBy("shard").applyInArrow(sort, "phrase array<long>, a long")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, contained: int = CONTAINED_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all candidates that are not contained in a longer one."""
    if longest not in (2, 3):
        raise ValueError("phrases have 2 or 3 words")
    words, seed = named_words(bounded_batches(docs))
    per_lang = words.groupBy("lang").agg(F.sum("f").alias("n"))
    tokens = words.agg(F.sum("f")).first()[0] or 0
    candidates = stored(frequent_phrases(docs, seed, tokens, longest, least), "collocation-phrases")

    size = F.size("phrase")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: F.slice("phrase", at, n))))
    inside = candidates.filter(size > 2).select(F.explode(parts).alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, "phrase", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a"))).select("phrase", "a")

    often = words.filter(F.col("f") >= least)
    counts = often.select(F.array("name").alias("part"), "f").unionByName(
        candidates.filter(size < longest).select(F.col("phrase").alias("part"), F.col("a").alias("f")))
    cuts = kept.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.slice("phrase", F.lit(1), F.col("k")).alias("first"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("rest"))
    halves = cuts.join(counts.select(F.col("part").alias("first"), F.col("f").alias("l")), "first").join(
        counts.select(F.col("part").alias("rest"), F.col("f").alias("r")), "rest")
    wide = [F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")]
    score = F.call_function("div", (F.lit(1_000_000) * wide[0] * wide[0]).cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))
    lowest = halves.withColumn("score", score).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spelled = lowest.select("*", F.posexplode("phrase").alias("place", "name")).join(often.select("name", "lang", "word"), "name")
    spelled = spelled.groupBy("phrase", "a", "cut").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    return spelled.join(per_lang, "lang").select(
        "lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")


def best(rows: DataFrame, reported: int = REPORTED) -> DataFrame:
    """The first rows of each lang with their ``rank``; a lang is first cut in ``SALTS`` parts, whose best meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).filter(
        F.col("rank") <= reported)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= reported).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(docs: DataFrame) -> DataFrame:
    return best(collocations(docs))


SQL = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(body, '[^\x20\x09]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body
        FROM documents)),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
phrases AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM places, range(1, 4) s(size) WHERE i + size - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1 AND f >= 10),
inside AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer
    FROM candidates WHERE size = 3),
kept AS (
    SELECT c.* FROM candidates c LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL) i USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
    SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c
    JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest) JOIN totals USING (lang)
WHERE rank <= 2000
"""
