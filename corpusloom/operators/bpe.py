"""Byte-level BPE: word counts, learning, and encoding as Spark jobs.

A word is kept as a string with one character per symbol, so adjacent pairs
are a regular expression and a merge is ``replace``; both run in the JVM and
are linear in the word.  Ids follow the usual layout: the special token, the
256 byte symbols in the order of their printable stand-ins, then the merges.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings
from corpusloom.functions.text import with_nfc
from corpusloom.operators.rows import explode_items
from corpusloom.session import bounded_batches, written

FIRST = 0x100  # character of id 0; ids stay below the surrogate block
MAX_VOCAB = 0xD800 - FIRST
SPECIAL_ID = 0
TOP = 16_384  # pairs a full count brings to the driver
FIRST_TOP = 64  # active pairs of the first round, when words are whole and parts long
MEMO_WORDS, MEMO_LENGTH = 1 << 16, 64  # words a worker remembers, and their longest
SIDE_BY_SIDE = 1 << 14  # words whose merges are made side by side
NO_RANK = (1 << 31) - 1  # of two symbols that do not merge
BETWEEN = "\0"  # stands between the words of a batch; no symbol
PART_SYMBOLS = 1_000_000  # symbols of the distinct parts a round brings to the driver


def _byte_stand_ins() -> list[str]:
    """Printable stand-in of every byte: printable Latin-1 bytes stand for
    themselves, the others take the characters from U+0100 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


_STAND_INS = _byte_stand_ins()
_BYTE_ID = {b: 1 + rank for rank, b in enumerate(sorted(range(256), key=_STAND_INS.__getitem__))}


def _symbol(token_id: int) -> str:
    return chr(FIRST + token_id)


_LATIN = "".join(map(chr, range(256)))
_BYTE_SYMBOLS = "".join(_symbol(_BYTE_ID[b]) for b in range(256))


@dataclass(frozen=True)
class Vocabulary:
    """Learned merges in rank order; its size is bounded by the vocabulary size."""

    merges: tuple[tuple[int, int, int], ...]  # (left id, right id, merged id)

    def token_bytes(self) -> list[bytes]:
        """Bytes of every id; the special token contributes its own text."""
        out = {SPECIAL_ID: settings.SPECIAL_TOKEN.encode()}
        out.update({i: bytes([b]) for b, i in _BYTE_ID.items()})
        for left, right, merged in self.merges:
            out.setdefault(merged, out[left] + out[right])
        return [out[i] for i in range(len(out))]

    def tokens(self) -> list[str]:
        """Printable form of every id."""
        raw = self.token_bytes()
        return [settings.SPECIAL_TOKEN] + ["".join(_STAND_INS[b] for b in t) for t in raw[1:]]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens())), "id int, token string")

    def merges_table(self, spark: SparkSession) -> DataFrame:
        names = self.tokens()
        rows = [(rank, names[l], names[r], names[m]) for rank, (l, r, m) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, merged string")

    def roles_table(self, spark: SparkSession) -> DataFrame:
        """Special-token roles and limits, stored next to the vocabulary."""
        s = settings.SPECIAL_TOKEN
        return spark.createDataFrame(
            [(s, s, s, s, settings.BLOCK_LENGTH, False)],
            "bos_token string, eos_token string, unk_token string, pad_token string, "
            "model_max_length int, add_prefix_space boolean",
        )


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(settings.PRETOKEN_PATTERN), F.lit(0))


def encoder_pieces(text: Column) -> Column:
    """Pre-tokens for encoding: the special token, where the text spells it, is
    a piece of its own and separates what surrounds it."""
    special = settings.SPECIAL_TOKEN
    parts = F.transform(
        F.split(text, "\\Q" + special + "\\E", -1),
        lambda part, i: F.concat(
            F.when(i > 0, F.array(F.lit(special))).otherwise(F.array().cast("array<string>")), pretokens(part)
        ),
    )
    return F.when(F.contains(text, F.lit(special)), F.flatten(parts)).otherwise(pretokens(text))


def word_counts(docs: DataFrame, by: list[str] | None = None, text: str = "text",
                pieces: Callable[[Column], Column] = pretokens) -> DataFrame:
    """Frequency of every pre-token of the NFC text; frequent words collapse
    before the shuffle."""
    keys = by or []
    words = explode_items(with_nfc(docs.select(*keys, text), text, "__nfc"), keys, pieces(F.col("__nfc")), "word")
    return words.groupBy(*keys, "word").agg(F.count("*").alias("freq"))


def symbols(word: Column) -> Column:
    """Word as one symbol character per UTF-8 byte."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _LATIN, _BYTE_SYMBOLS)


def _joined(batch: pa.RecordBatch) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a batch ``(symbols, freq)`` as one text with ``BETWEEN`` between them, its
    characters as numbers, the frequencies of the words, and for each character its word."""
    whole = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
    text = pc.binary_join(whole, BETWEEN)[0].as_py()
    codes = np.frombuffer(text.encode("utf-16-le"), dtype=np.uint16).astype(np.uint32)
    return text, codes, batch.column(1).to_numpy(), np.cumsum(codes == ord(BETWEEN))


def pair_counts(state: DataFrame) -> DataFrame:
    """``(pair, freq)`` of adjacent symbols over ``state(symbols, freq)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, codes, freqs, word = _joined(batch)
            at = np.flatnonzero((codes[:-1] != ord(BETWEEN)) & (codes[1:] != ord(BETWEEN)))
            if len(at) == 0:
                continue
            pairs = codes[at] << 16 | codes[at + 1]
            order = np.argsort(pairs)
            pairs = pairs[order]
            first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            sums = np.add.reduceat(freqs[word[at[order]]], first)
            names = [chr(p >> 16) + chr(p & 0xFFFF) for p in pairs[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.int64())], ["pair", "freq"])

    return state.select("symbols", "freq").mapInArrow(count, "pair string, freq long").groupBy("pair").agg(F.sum("freq").alias("freq"))


def _runs(codes: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of more than one symbol: what is left of the words, cut at
    every pair that is not in the sorted ``active``."""
    if len(codes) == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    left, right = np.zeros(1 << 16, dtype=bool), np.zeros(1 << 16, dtype=bool)
    left[active >> 16], right[active & 0xFFFF] = True, True
    at = np.flatnonzero(left[codes[:-1]] & right[codes[1:]])
    pairs = codes[at] << 16 | codes[at + 1]
    at = at[active[np.minimum(np.searchsorted(active, pairs), len(active) - 1)] == pairs]
    held = np.zeros(len(codes) + 1, dtype=bool)  # of a symbol and the one before it
    held[at + 1] = True
    return np.flatnonzero(~held[:-1] & held[1:]), np.flatnonzero(held[:-1] & ~held[1:]) + 1


def _codes(pairs: list[str]) -> np.ndarray:
    return np.array(sorted(ord(p[0]) << 16 | ord(p[1]) for p in pairs), dtype=np.uint32)


def _parts(state: DataFrame, active: list[str]) -> DataFrame:
    """``(part, freq)``: the words cut at every pair that is not ``active``."""
    pairs = _codes(active)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, int] = defaultdict(int)
            text, codes, freqs, word = _joined(batch)
            starts, ends = _runs(codes, pairs)
            for i, j, freq in zip(starts.tolist(), ends.tolist(), freqs[word[starts]].tolist()):
                found[text[i:j]] += freq
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["part", "freq"])

    return state.select("symbols", "freq").mapInArrow(cut, "part string, freq long").groupBy("part").agg(F.sum("freq").alias("freq"))


def _bounded_parts(state: DataFrame, ranked: list[str], most: int) -> tuple[dict[str, int], int, int]:
    """The parts of the words for as many of the ``ranked`` pairs, at most
    ``most``, as give no more than ``PART_SYMBOLS`` symbols, that number, and how many symbols.

    A single pair is taken in any case: its parts are itself or runs of one symbol."""
    while True:
        most = min(most, len(ranked))
        parts = _parts(state, ranked[:most]).persist()
        try:
            size = parts.agg(F.sum(F.length("part"))).first()[0] or 0
            if size <= PART_SYMBOLS or most == 1:
                return {r["part"]: r["freq"] for r in parts.collect()}, most, size
        finally:
            parts.unpersist()
        most = max(1, most // 2)


def _learn_parts(parts: dict[str, int], last: tuple[int, str], raw: list[bytes], ids: dict[bytes, int],
                 vocab_size: int) -> tuple[list[tuple[int, int, int]], dict[str, str]]:
    """Merge one pair at a time up to ``last``, as ``(-freq, pair)``, the end of the active ranking;
    the merges, and what has become of the parts that changed.

    Extends ``raw`` and ``ids``.  A merge that spells a known token makes pairs more
    frequent, inactive ones too, and is the last of its round.
    """
    words, freqs = list(parts), list(parts.values())
    counts: Counter = Counter()
    where: dict[str, set[int]] = defaultdict(set)
    for i, (word, freq) in enumerate(zip(words, freqs)):
        for pair in map("".join, zip(word, word[1:])):
            counts[pair] += freq
            where[pair].add(i)
    ready = [(-n, pair) for pair, n in counts.items()]
    heapq.heapify(ready)
    merges: list[tuple[int, int, int]] = []
    while ready and len(raw) < vocab_size:
        key = heapq.heappop(ready)
        pair = key[1]
        if counts[pair] != -key[0]:
            if counts[pair] > 0:
                heapq.heappush(ready, (-counts[pair], pair))
            continue
        if key > last:
            break
        left, right = ord(pair[0]) - FIRST, ord(pair[1]) - FIRST
        spelled = raw[left] + raw[right]
        known = spelled in ids
        if not known:
            ids[spelled] = len(raw)
            raw.append(spelled)
        merges.append((left, right, ids[spelled]))
        if known:
            break
        symbol, fresh = _symbol(ids[spelled]), set()
        for i in where.pop(pair):
            old = words[i]
            if pair not in old:
                continue
            words[i] = new = old.replace(pair, symbol)
            for p in map("".join, zip(old, old[1:])):
                counts[p] -= freqs[i]
            for p in map("".join, zip(new, new[1:])):
                counts[p] += freqs[i]
                if symbol in p:
                    where[p].add(i)
                    fresh.add(p)
        for p in fresh:
            heapq.heappush(ready, (-counts[p], p))
    return merges, {old: new for old, new in zip(parts, words) if old != new}


def _replayed(state: DataFrame, active: list[str], became: dict[str, str]) -> DataFrame:
    """The words with every part between the ``active`` pairs' cuts as it ``became``; those of one symbol have no pairs and go."""
    pairs = _codes(active)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, codes, _, _ = _joined(batch)
            pieces, done = [], 0
            for i, j in zip(*(x.tolist() for x in _runs(codes, pairs))):
                new = became.get(text[i:j])
                if new is not None:
                    pieces += [text[done:i], new]
                    done = j
            words = "".join([*pieces, text[done:]]).split(BETWEEN)[:batch.num_rows]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column(1)], ["symbols", "freq"])

    return state.select("symbols", "freq").mapInArrow(replay, "symbols string, freq long").filter(F.length("symbols") > 1)


def learn(words: DataFrame, vocab_size: int = settings.VOCAB_SIZE,
          min_frequency: int = settings.MIN_FREQUENCY, checkpoint_every: int = 32) -> Vocabulary:
    """Learn merges from ``words(word, freq)``; the words stay distributed.

    A round counts all pairs and calls the most frequent ones, ``TOP`` at most,
    active.  A pair that a merge makes is no more frequent than the one it stands on,
    and its symbols are newer, so what lies across an inactive pair ranks behind all
    active ones until the round ends.  The words are therefore cut there, equal parts
    are added up, and the driver merges within the parts, one pair at a time, until
    the best pair ranks behind the last active one.  ``PART_SYMBOLS`` bounds what it
    holds; where parts would be larger, fewer pairs are active and the rounds are
    more.  What the parts became is then put into the words, and these are written anew, once ``checkpoint_every`` merges are pending.
    """
    if vocab_size > MAX_VOCAB:
        raise ValueError(f"vocab_size above {MAX_VOCAB}")
    # Fixed partitions: adaptive execution would shrink this small table to one
    # task, and every round reads all of it.
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = words.select(symbols(F.col("word")).alias("symbols"), "freq")
    state = written(coded.repartition(parts, "symbols"), "symbols")
    raw = Vocabulary(()).token_bytes()
    ids = {t: i for i, t in enumerate(raw)}
    merges: list[tuple[int, int, int]] = []
    pending, held, most = 0, [], FIRST_TOP
    while len(raw) < vocab_size:
        top = (
            pair_counts(state).filter(F.col("freq") >= min_frequency)
            .orderBy(F.col("freq").desc(), "pair").limit(TOP).collect()
        )
        if not top:
            break
        found, most, size = _bounded_parts(state, [r["pair"] for r in top], most)
        last = top[most - 1]
        done, became = _learn_parts(found, (-last["freq"], last["pair"]), raw, ids, vocab_size)
        merges += done
        if len(raw) < vocab_size:
            state = _replayed(state, [r["pair"] for r in top[:most]], became)
            pending += len(done)
            if pending >= checkpoint_every:
                state, pending = written(state, "symbols"), 0
            else:
                state = state.persist()
                held.append(state)
        most = min(TOP, most * (8 if size * 16 <= PART_SYMBOLS else 2))
    for stale in held:
        stale.unpersist()
    return Vocabulary(tuple(merges))


def _ranks(merges: Sequence[tuple[int, int, int]]) -> dict[str, tuple[int, str]]:
    return {_symbol(l) + _symbol(r): (n, _symbol(m)) for n, (l, r, m) in reversed(list(enumerate(merges)))}


def _merged(word: str, rank: dict[str, tuple[int, str]]) -> str:
    """``word`` after its merges, the best first."""
    parts: list[str | None] = list(word)
    after = [*range(1, len(parts)), -1]
    before = list(range(-1, len(parts) - 1))
    # The best pair first, the leftmost of equals; entries whose symbols changed are stale.
    ready = [(rank[pair][0], i, pair) for i, pair in enumerate(map("".join, zip(parts, parts[1:]))) if pair in rank]
    heapq.heapify(ready)
    while ready:
        _, i, pair = heapq.heappop(ready)
        j = after[i]
        if parts[i] is None or j < 0 or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j], after[i] = rank[pair][1], None, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] >= 0:
                fresh = parts[left] + parts[after[left]]
                if fresh in rank:
                    heapq.heappush(ready, (rank[fresh][0], left, fresh))
    return "".join(p for p in parts if p is not None)


def _word_encoder(vocab: Vocabulary):
    """Function word -> symbol string, remembering recent words, but no long ones."""
    rank = _ranks(vocab.merges)
    table = {b: _BYTE_SYMBOLS[b] for b in range(256)}
    special = settings.SPECIAL_TOKEN

    def encode(word: str) -> str:
        if word == special:
            return _symbol(SPECIAL_ID)
        return _merged(word.encode("utf-8").decode("latin-1").translate(table), rank)

    remembered = lru_cache(maxsize=MEMO_WORDS)(encode)
    return lambda word: remembered(word) if len(word) <= MEMO_LENGTH else encode(word)


def word_ids(vocab: Vocabulary) -> Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Function from words to ids in one array, and where those of each word begin and how many they are.

    In a pass every word makes its best merge, the leftmost of equals, side by side with the
    others; words above ``MEMO_LENGTH`` bytes, which would take many passes, go one by one."""
    rank = {ord(pair[0]) - FIRST << 16 | ord(pair[1]) - FIRST: n for pair, (n, _) in _ranks(vocab.merges).items()}
    pairs = np.array(sorted(rank), dtype=np.uint32)
    padded = np.append(pairs, np.uint32(0xFFFFFFFF))  # no pair: ids are smaller
    ranks = np.array([rank[p] for p in pairs.tolist()] + [NO_RANK], dtype=np.int32)
    made = np.array([m for _, _, m in vocab.merges], dtype=np.uint32)
    byte_ids = np.array([_BYTE_ID[b] for b in range(256)], dtype=np.uint32)
    alone = _word_encoder(vocab)

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 16 | right
        at = np.searchsorted(pairs, wanted)
        return np.where(padded[at] == wanted, ranks[at], NO_RANK)

    def merged(codes: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The words' numbers, sizes and ids, as they have no merge left."""
        words = np.arange(len(sizes))
        order = np.append(rank_of(codes[:-1], codes[1:]), np.int32(NO_RANK))
        order[np.cumsum(sizes) - 1] = NO_RANK
        while len(words):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(order.astype(np.int64) << 32 | np.arange(len(order)), starts)
            at, by = best & 0xFFFFFFFF, best >> 32
            over = by == NO_RANK
            if over.any():
                gone = np.repeat(over, sizes)
                yield words[over], sizes[over], codes[gone]
                at = (at - starts)[~over]
                words, sizes, by, codes, order = words[~over], sizes[~over], by[~over], codes[~gone], order[~gone]
                starts = np.cumsum(sizes) - sizes
                at += starts
            codes[at] = made[by]
            held = np.ones(len(codes), dtype=bool)
            held[at + 1] = False
            codes, order = codes[held], order[held]
            before = np.arange(len(words))  # symbols that the words in front have lost
            at, starts, sizes = at - before, starts - before, sizes - 1
            order[at] = NO_RANK
            right = at[at + 1 < starts + sizes]
            order[right] = rank_of(codes[right], codes[right + 1])
            left = at[at > starts]
            order[left - 1] = rank_of(codes[left - 1], codes[left])

    def ids(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begin, count = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        found, done = [np.empty(0, dtype=np.uint32)], 0
        lengths = np.asarray(pc.binary_length(words))
        single = (lengths > MEMO_LENGTH) | np.asarray(pc.equal(words, settings.SPECIAL_TOKEN))
        for i in np.flatnonzero(single).tolist():
            found.append(np.array([ord(c) - FIRST for c in alone(words[i].as_py())], dtype=np.uint32))
            begin[i], count[i] = done, len(found[-1])
            done += count[i]
        rest = np.flatnonzero(~single & (lengths > 0))
        for some in (rest[i:i + SIDE_BY_SIDE] for i in range(0, len(rest), SIDE_BY_SIDE)):
            raw = np.frombuffer(b"".join(words.take(pa.array(some)).cast(pa.binary()).to_pylist()), dtype=np.uint8)
            for which, sizes, codes in merged(byte_ids[raw], lengths[some].astype(np.int64)):
                begin[some[which]], count[some[which]] = done + np.cumsum(sizes) - sizes, sizes
                found.append(codes)
                done += len(codes)
        return np.concatenate(found), begin, count

    return ids


def encoded(word: str, vocab: Vocabulary) -> Column:
    """The symbols of a word under ``vocab``, one character per id, from an Arrow batch of words."""

    def encode_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _word_encoder(vocab)
        for words in batches:
            yield words.map(encode)

    return F.pandas_udf(encode_batches, T.StringType())(word)


def ids_of(code: Column) -> Column:
    """The ids of a string of symbols."""
    return F.transform(F.regexp_extract_all(code, F.lit("(?s)."), F.lit(0)), lambda symbol: F.ascii(symbol) - FIRST)


def with_token_ids(docs: DataFrame, vocab: Vocabulary, text: str = "text", target: str = "ids") -> DataFrame:
    """Add the token ids of every text: pre-tokens from the JVM, merges in an
    Arrow batch with a per-worker memo of words.  Narrow; nothing is shuffled.
    Python holds the words of one text at a time and answers with its symbols,
    one character per id."""

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _word_encoder(vocab)
        for texts in batches:
            yield pa.array(("".join(map(encode, words.as_py())) if words.is_valid else None for words in texts), pa.string())

    udf = F.arrow_udf(encode_batches, T.StringType())
    rows = with_nfc(docs, text, "__nfc").withColumn("__code", udf(encoder_pieces(F.col("__nfc"))))
    return rows.withColumn(target, ids_of(F.col("__code"))).drop("__nfc", "__code")


def with_decoded(rows: DataFrame, vocab: Vocabulary, ids: str = "ids", target: str = "decoded") -> DataFrame:
    raw = vocab.token_bytes()

    def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield pa.array((b"".join([raw[i] for i in xs.as_py()]).decode("utf-8", "replace") for xs in lists), pa.string())

    return bounded_batches(rows).withColumn(target, F.arrow_udf(decode_batches, T.StringType())(ids))


def token_counts(docs: DataFrame, vocab: Vocabulary, by: str = "source") -> DataFrame:
    """Tokens per source: every distinct word is encoded once and meets its counts in the sources."""

    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _word_encoder(vocab)
        for words in batches:
            yield pa.array((len(encode(w)) for w in words.to_pylist()), pa.int64())

    counts = written(word_counts(docs, [by], pieces=encoder_pieces), "words")
    # As many tasks as a shuffle has: small files would leave the encoding to a few.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = counts.select("word").distinct().repartition(tasks, "word")
    sizes = words.select("word", F.arrow_udf(lengths, T.LongType())("word").alias("size"))
    return counts.join(sizes, "word").groupBy(by).agg(F.sum(F.col("freq") * F.col("size")).alias("tokens"))


def round_trip_report(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Texts per source and how many do not survive encode + decode."""
    back = with_decoded(with_token_ids(with_nfc(docs, "text"), vocab), vocab)
    return back.groupBy("source").agg(
        F.count("*").alias("docs"),
        F.sum(F.size("ids")).alias("tokens"),
        F.count_if(F.col("decoded") != F.col("text")).alias("broken"),
    )
