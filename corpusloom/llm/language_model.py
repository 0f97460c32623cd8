"""Language-model scores by a hashed maximum-entropy model with n-grams and skips of words.

P0(word | history) = P(class | history) * P(word | class).  The class of a word is its
own for the most frequent words and the end, else a hash of its last two bytes.
The class part is a softmax over ``CLASSES`` with hashed features of the history:
the class before, the class before that (a skip), and both together.  Its
statistics, the counts of class triples, come from every training text; gradient
and curvature are summed over the cluster in each of ``ROUNDS`` updates.  The word
part is the word's share of its class, half a count added for every known word and
one unknown one.

The words themselves are features too: the word before the last (a skip), the last
one, and both together.  For each in this order
P(word | feature) = (n(feature, word) + K * P of the one before) / (n(feature) + K),
which starts from P0 and stays a distribution.  The counts n cover every training
text, in a table of hashed n-grams that grows with the corpus and is spread over
shards of the hash.  A block of texts sends its distinct n-grams with their counts,
packed by shard; a shard adds up and answers each block for what it sent.  K is the one of
``PRIORS`` that gives all training tokens the highest likelihood when each is left out of the counts.

Counts cover all training rows: those whose crc32(doc_id) mod 5 is not 1.  Words are
held by 64-bit hashes, n-grams by 28 bits and those of their shard.  Words of at least 1 in 2^20 tokens (so 2^20
at most) are sent to every task; the counts of others come from the shards.

Null and empty texts have only the end.  Repeated rows are rows of their own;
extra columns do not matter; with no training rows every count is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import bounded_batches, stored
from corpusloom.llm.words import blocks, mix, word_hashes, word_spans

HOT_SHARE = 1 << 20
CLASSES = 64
OWN = 32  # classes of one frequent word each; class 0 is the end
FEATURES = 1 << 12  # rows of the hashed weight table
ROUNDS = 15
STEP = 0.25  # four features act at once
MOST = 0.5  # of a weight's change in a round
RIDGE = 5.0
PRIORS = tuple(4.0 ** k for k in range(2, 7))  # counts that the shorter history is worth
GRAM_BITS = 28  # of an n-gram inside its shard, where about 1 in 100 shares them with another
SHARD_BYTES = 1 << 24  # of all texts, whose n-grams of one kind a shard holds on average
RUN_BYTES = 1 << 23  # of the texts of a block; one longer text is a block alone
GRAMS, KINDS = 4, 5  # the kinds of n-grams, and the words themselves
STRIDE = 1 << 15  # tokens whose numbers stay in a core's cache
END = np.uint64(0)  # stands for the hash of the end
_PART = np.random.Generator(np.random.PCG64(3)).integers(1, 2**63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def suffix_class(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Class by the last two bytes, for words without a class of their own."""
    last = start + length - 1
    before = np.where(length > 1, _LOWER[data[np.maximum(last - 1, 0)]], np.uint64(0))
    pair = _LOWER[data[last]] * np.uint64(256) + before
    return (OWN + mix(pair) % np.uint64(CLASSES - OWN)).astype(np.uint8)


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, k, c``: hash, suffix class and count of every word of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                start, length, _ = word_spans(data, offsets)
                if len(start) == 0:
                    continue
                h, at, c = np.unique(word_hashes(data, start, length), return_index=True, return_counts=True)
                k = suffix_class(data, start[at], length[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(k.astype(np.int32)), pa.array(c)], ["h", "k", "c"])

    return docs.select("text").mapInArrow(count, "h long, k int, c long").groupBy("h", "k").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows of the words: bounded by ``HOT_SHARE`` and ``CLASSES``."""

    tokens: int
    types: int
    ends: int
    hot: np.ndarray  # sorted hashes
    hot_count: np.ndarray
    own: np.ndarray  # sorted hashes of words with a class of their own
    own_class: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray

    def cold(self, words: np.ndarray) -> np.ndarray:
        """Which tokens are neither hot words nor the end."""
        return (words != END) & ~found_in(self.hot, words)[1]


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    top = counts.orderBy(F.desc("c"), "h").limit(OWN - 1).collect()
    own = sorted((r["h"] & (2**64 - 1), i + 1) for i, r in enumerate(top))
    taken = {r["h"]: i + 1 for i, r in enumerate(top)}
    sums = counts.groupBy("k").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        class_tokens[r["k"]] += r["c"]
        class_types[r["k"]] += r["n"]
    for r in top:
        class_tokens[r["k"]] -= r["c"]
        class_types[r["k"]] -= 1
        class_tokens[taken[r["h"]]], class_types[taken[r["h"]]] = r["c"], 1
    class_tokens[0], class_types[0] = ends, 1 if ends else 0
    tokens, types = sum(r["c"] for r in sums) + ends, sum(r["n"] for r in sums) + (1 if ends else 0)
    hot = counts.filter(F.col("c") * HOT_SHARE >= tokens).select("h", "c").toArrow() if tokens else None
    h = hot["h"].to_numpy().view(np.uint64) if hot is not None else np.empty(0, dtype=np.uint64)
    c = hot["c"].to_numpy() if hot is not None else np.empty(0, dtype=np.int64)
    order = np.argsort(h)
    return Vocabulary(int(tokens), int(types), ends, h[order], c[order],
                      np.array([x for x, _ in own], dtype=np.uint64), np.array([x for _, x in own], dtype=np.uint8),
                      class_tokens, class_types)


def found_in(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every key in a sorted table, and whether it is there."""
    if len(table) == 0:
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


BLOCK = "block long, doc_id array<long>, held_out array<boolean>, offsets binary, text binary"


def text_blocks(docs: DataFrame) -> DataFrame:
    """Runs of texts, one row each, so that whoever reads a block sees the same texts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = count(TaskContext.get().partitionId() << 32), [], 0

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            texts = table.column(2).combine_chunks().fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = memoryview(texts.buffers()[2] or b"")[offsets[0]:offsets[-1]]
            places = pa.array([0, len(texts)], pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array([next(numbers)]), *[pa.ListArray.from_arrays(places, table.column(i).combine_chunks()) for i in (0, 1)],
                pa.array([(offsets - offsets[0]).tobytes()], pa.binary()), pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary())],
                ["block", "doc_id", "held_out", "offsets", "text"])

        for batch in batches:
            first = 0
            for i, n in enumerate(pc.binary_length(batch.column(2)).fill_null(0).to_pylist()):
                if size and size + n > RUN_BYTES:
                    held.append(batch.slice(first, i - first))
                    yield row()
                    held, size, first = [], 0, i
                size += n + 8
            held.append(batch.slice(first))
        if size:
            yield row()

    texts = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return bounded_batches(texts).mapInArrow(gather, BLOCK)


@dataclass
class Tokens:
    """The tokens of a block of texts, the end of each text among them."""

    words: np.ndarray  # hashes
    classes: np.ndarray
    firsts: np.ndarray  # place of every text's first token
    training: np.ndarray  # whether the token is in a training text

    def before(self, values: np.ndarray, steps: int, start) -> np.ndarray:
        """The value ``steps`` tokens back in the same text; ``start`` before its first."""
        out = np.full(len(values), start, dtype=values.dtype)
        out[steps:] = values[:len(values) - steps]
        for i in range(steps):
            out[self.firsts[self.firsts + i < len(out)] + i] = start
        return out

    def histories(self) -> np.ndarray:
        """Both classes before every class; before a text's start is the end."""
        further, last = (self.before(self.classes, n, 0).astype(np.int64) for n in (2, 1))
        return further * CLASSES + last

    def sums(self, values: np.ndarray) -> np.ndarray:
        """One sum per text."""
        return np.add.reduceat(values, self.firsts)


def tokens_of(row: dict, own: np.ndarray, own_class: np.ndarray) -> Tokens:
    """The tokens of one row of ``text_blocks``."""
    held, offsets = np.array(row["held_out"], dtype=bool), np.frombuffer(row["offsets"], dtype=np.int64)
    data = np.frombuffer(pa.decompress(row["text"], int(offsets[-1]), "zstd"), dtype=np.uint8)
    start, length, bounds = word_spans(data, offsets)
    sizes = np.diff(bounds)
    at = np.arange(len(start)) + np.repeat(np.arange(len(sizes)), sizes)
    words = np.full(len(start) + len(sizes), END)
    classes = np.zeros(len(words), dtype=np.uint8)
    h = word_hashes(data, start, length)
    words[at] = h
    if len(start):
        k = suffix_class(data, start, length)
        own_at, is_own = found_in(own, h)
        k[is_own] = own_class[own_at[is_own]]
        classes[at] = k
    return Tokens(words, classes, bounds[:-1] + np.arange(len(sizes)), np.repeat(~held, sizes + 1))


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def grams(tokens: Tokens, kind: int, bits: int) -> np.ndarray:
    """The hashed n-grams that end at each token, ``bits`` of the shard in front: the word
    before the last alone, it with the word, the last with the word, or all three."""
    keys = np.full(len(tokens.words), kind + 1, dtype=np.uint64)
    for value, part, kinds in ((tokens.before(tokens.words, 2, END), _PART[0], (0, 1, 3)),
                               (tokens.before(tokens.words, 1, END), _PART[1], (2, 3)), (tokens.words, _PART[2], (1, 2, 3))):
        if kind in kinds:
            keys += value * part
    return mix(mix(keys)) >> np.uint64(64 - GRAM_BITS - bits)


def distinct_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, the order that sorts all keys, and where each distinct one begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(keys)])
    return ordered[heads], order, heads


def summed(values: np.ndarray, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], heads) if len(heads) else np.empty(0, dtype=np.int64)


def given_back(values: np.ndarray, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """What every key gets, from the ``values`` of the distinct ones."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.repeat(values, np.diff(np.append(heads, len(order))))
    return out


def packed_numbers(values: np.ndarray) -> bytes:
    """How many numbers, how many bytes each takes, and their first bytes, their second bytes and so on, compressed."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    width = -(-int(values.max()).bit_length() // 8) if len(values) else 0
    return len(values).to_bytes(4, "little") + bytes([width]) + pa.compress(planes[:width].tobytes(), "zstd", asbytes=True)


def unpacked_numbers(packed: bytes) -> np.ndarray:
    size, width = int.from_bytes(packed[:4], "little"), packed[4]
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(packed[5:], size * width, "zstd"), dtype=np.uint8).reshape(width, size).T
    return out.view(np.uint64)[:, 0]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return packed_numbers(np.diff(keys, prepend=keys[:1] * np.uint64(0)) if len(keys) else keys)


def unpacked_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(packed), dtype=np.uint64)


def shard_bounds(keys: np.ndarray, shards: int, width: int) -> np.ndarray:
    """Where every shard's run of sorted keys begins, and the end; a key's shard is in front of ``width`` bits."""
    return np.append(np.searchsorted(keys, np.arange(shards, dtype=np.uint64) << np.uint64(width)), len(keys))


ASKED = "block long, kind int, shard int, keys binary, counts binary"
ANSWERED = "block long, kind int, shard int, counts binary"


def asked(block: DataFrame, words: Broadcast, bits: int) -> DataFrame:
    """Per block, kind and shard the distinct n-grams, or words that are not hot, and how often training texts hold them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = words.value
        for row in one_by_one(batches):
            tokens = tokens_of(row, v.own, v.own_class)
            training = tokens.training.astype(np.int64)
            for kind in range(KINDS):
                if kind < GRAMS:
                    keys, width, ones = grams(tokens, kind, bits), GRAM_BITS, training
                else:
                    cold = v.cold(tokens.words)
                    keys, width, ones = tokens.words[cold], 64 - bits, training[cold]
                keys, order, heads = distinct_places(keys)
                counts, edges = summed(ones, order, heads), shard_bounds(keys, 1 << bits, width)
                if kind < GRAMS:
                    keys &= np.uint64((1 << GRAM_BITS) - 1)
                parts = [[pack(x[a:b]) for a, b in zip(edges[:-1], edges[1:])] for pack, x in ((packed_keys, keys), (packed_numbers, counts))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(1 << bits, row["block"])), pa.array(np.full(1 << bits, kind, dtype=np.int32)),
                     pa.array(np.arange(1 << bits, dtype=np.int32)), *[pa.array(p, pa.binary()) for p in parts]],
                    [c.split()[0] for c in ASKED.split(", ")])

    return block.select("block", "held_out", "offsets", "text").mapInArrow(ask, ASKED)


def answered(told: DataFrame) -> DataFrame:
    """The counts over all training texts of what every block asked for, in its order."""

    def answer(table: pa.Table) -> pa.Table:
        held = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        sizes = [len(x) for x in held]
        held = np.concatenate(held)
        _, order, heads = distinct_places(held)
        del held
        counts = np.concatenate([unpacked_numbers(x) for x in table["counts"].to_pylist()]).astype(np.int64)
        counts = given_back(summed(counts, order, heads), order, heads)
        parts = [packed_numbers(x) for x in np.split(counts, np.cumsum(sizes)[:-1])]
        return pa.table([table["block"], table["kind"], table["shard"], pa.array(parts, pa.binary())],
                        [c.split()[0] for c in ANSWERED.split(", ")])

    return told.groupBy("kind", "shard").applyInArrow(answer, ANSWERED)


def triples(block: DataFrame, words: Broadcast) -> DataFrame:
    """``history, counts``: how often each class follows each history."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, dtype=np.int64)
        for row in one_by_one(batches):
            tokens = tokens_of(row, words.value.own, words.value.own_class)
            cells = tokens.histories() * CLASSES + tokens.classes
            total += np.bincount(cells[tokens.training], minlength=CLASSES ** 3)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], ["cell", "n"])

    cells = block.select("held_out", "offsets", "text").mapInArrow(add_up, "cell int, n long")
    return cells.groupBy("cell").agg(F.sum("n").alias("n")).groupBy(
        F.floor(F.col("cell") / CLASSES).cast("int").alias("history")).agg(
        F.collect_list(F.struct((F.col("cell") % CLASSES).alias("k"), "n")).alias("counts"))  # at most CLASSES items


def feature_rows(history: np.ndarray) -> np.ndarray:
    """The hashed rows of the weight table that are active for each history."""
    h = history.astype(np.uint64)
    c = np.uint64(CLASSES)
    cells = [np.zeros_like(h), (h % c) + np.uint64(1), (h // c) + np.uint64(1_000), h + np.uint64(10_000)]
    return np.stack([(mix(x) % np.uint64(FEATURES)).astype(np.int64) for x in cells], axis=1)


def log_softmax(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    logits = weights[feature_rows(history)].sum(axis=1)
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(statistics: DataFrame, class_tokens: np.ndarray) -> np.ndarray:
    """Weights of the class softmax, starting from the classes' shares.  Each round adds up, per task, gradient and
    curvature of the histories it holds; a task sends one row per weight."""
    weights = np.zeros((FEATURES, CLASSES))
    weights[feature_rows(np.zeros(1, dtype=np.int64))[0, 0]] = np.log((class_tokens + 0.5) / (class_tokens + 0.5).sum())
    for _ in range(ROUNDS):
        shared = statistics.sparkSession.sparkContext.broadcast(weights)

        def gradient(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            slope, bend = np.zeros((FEATURES, CLASSES)), np.zeros((FEATURES, CLASSES))
            for batch in batches:
                history = batch["history"].to_numpy()
                seen = np.zeros((len(history), CLASSES))
                for i, items in enumerate(batch["counts"]):
                    for item in items:
                        seen[i, item["k"]] = item["n"]
                p = np.exp(log_softmax(shared.value, history))
                size = seen.sum(axis=1, keepdims=True)
                for rows in feature_rows(history).T:
                    np.add.at(slope, rows, seen - size * p)
                    np.add.at(bend, rows, size * p * (1 - p))
            f, k = np.nonzero(bend)
            yield pd.DataFrame({"f": f, "k": k, "slope": slope[f, k], "bend": bend[f, k]})

        summed = statistics.mapInPandas(gradient, "f int, k int, slope double, bend double").groupBy("f", "k").agg(
            F.sum("slope").alias("slope"), F.sum("bend").alias("bend")).toArrow()  # at most FEATURES * CLASSES rows
        f, k = summed["f"].to_numpy(), summed["k"].to_numpy()
        step = STEP * (summed["slope"].to_numpy() - RIDGE * weights[f, k]) / (summed["bend"].to_numpy() + RIDGE)
        weights[f, k] += np.clip(step, -MOST, MOST)
        shared.unpersist()
    return weights


def log10_chained(lowest: np.ndarray, seen: list[tuple[np.ndarray, np.ndarray]], prior: float, less: np.ndarray) -> np.ndarray:
    """log10 P of every token from P0 and, per feature, ``(n(feature, word), n(feature))``, of which each counts ``less``."""
    out = np.empty(len(lowest))
    for here in (slice(at, at + STRIDE) for at in range(0, len(lowest), STRIDE)):
        p, fewer = lowest[here], less[here]
        for both, feature in seen:
            p = (prior * p + (both[here] - fewer)) / ((prior - fewer) + feature[here])
        out[here] = np.log10(p)
    return out


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
          "scores array<double>, left_out array<double>")


def scored(block: DataFrame, answers: DataFrame, words: Broadcast, log10_class: np.ndarray) -> DataFrame:
    """Per document its counts, and for every one of ``PRIORS`` its score and that with each training token left out of the counts."""
    shared = block.sparkSession.sparkContext.broadcast(log10_class)

    def finish(texts: pa.Table, told: pa.Table) -> pa.Table:
        v: Vocabulary = words.value
        row, told = texts.to_pylist()[0], told.sort_by([("kind", "ascending"), ("shard", "ascending")])
        held = np.array(row["held_out"], dtype=bool)
        tokens = tokens_of(row, v.own, v.own_class)
        shards = told.num_rows // KINDS
        bits = shards.bit_length() - 1

        def found(kind: int, keys: np.ndarray) -> np.ndarray:
            counts = [unpacked_numbers(x) for x in told["counts"].slice(kind * shards, shards).to_pylist()]
            return given_back(np.concatenate(counts).astype(np.int64), *distinct_places(keys)[1:])

        cold = v.cold(tokens.words)
        n = np.full(len(tokens.words), v.ends, dtype=np.int64)
        n[cold] = found(GRAMS, tokens.words[cold])
        hot = ~cold & (tokens.words != END)
        n[hot] = v.hot_count[found_in(v.hot, tokens.words[hot])[0]]
        skipped, skip, pair, triple = (found(kind, grams(tokens, kind, bits)) for kind in range(GRAMS))
        # A word is followed as often as it occurs, and so is a pair of words; a text's start is followed once.
        seen = [(skip, skipped), (pair, tokens.before(n, 1, v.ends)), (triple, tokens.before(pair, 1, v.ends))]
        k = tokens.classes
        by_class, whole = 10.0 ** shared.value[tokens.histories(), k].astype(np.float64), v.class_tokens + 0.5 * (v.class_types + 1)
        lowest = by_class * (n + 0.5) / whole[k]
        one_less = tokens.training.astype(np.int64)
        lower = by_class * (n - one_less + 0.5) / (whole[k] - one_less)
        scores = np.stack([tokens.sums(log10_chained(lowest, seen, p, np.zeros_like(one_less))) for p in PRIORS], axis=1)
        left_out = np.stack([tokens.sums(log10_chained(lower, seen, p, one_less)) for p in PRIORS], axis=1)
        left_out[held] = 0
        base = tokens.sums(np.log10(n + 0.5) - np.log10(v.tokens + 0.5 * (v.types + 1)))
        places = pa.array(np.arange(len(held) + 1, dtype=np.int32) * len(PRIORS))
        return pa.table([
            pa.array(row["doc_id"], pa.int64()), pa.array(held), pa.array(np.diff(np.append(tokens.firsts, len(k)))),
            pa.array(tokens.sums((n > 0).astype(np.int64))), pa.array(base),
            *[pa.ListArray.from_arrays(places, pa.array(x.ravel())) for x in (scores, left_out)]],
            [c.split()[0] for c in SCORED.split(", ")])

    return block.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORED)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    training = docs.filter(~held_out(F.col("doc_id")))
    counts = stored(word_counts(training), "word-counts")
    words = vocabulary(counts, training.count())
    shared = docs.sparkSession.sparkContext.broadcast(words)
    block = stored(text_blocks(docs), "text-blocks")
    weights = train(stored(triples(block, shared), "triples"), words.class_tokens)
    log10_class = (log_softmax(weights, np.arange(CLASSES ** 2)) / np.log(10)).astype(np.float32)
    size = block.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(0, (size // SHARD_BYTES).bit_length()), 64 - GRAM_BITS)
    rows = stored(scored(block, answered(asked(block, shared, bits)), shared, log10_class), "scores")
    sums = rows.agg(*[F.sum(F.col("left_out")[i]) for i in range(len(PRIORS))]).first()
    best = int(np.argmax([x or 0.0 for x in sums]))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"),
                       "base_score", F.col("scores")[best].alias("score"))


def op3(docs: DataFrame) -> DataFrame:
    return score(docs)
