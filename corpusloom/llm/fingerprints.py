"""Document fingerprints from improbable features.

Every window of 64 bytes has an entropy; its rarity is the number of windows of
all documents with that entropy (one histogram of ``BINS`` counts over the whole
corpus).  Among each run of 64 windows the rarest one, leftmost in a tie, gains a
point, and windows with enough points are the document's features.  Features go
into Bloom filters of 2,048 bits; a filter that holds 160 features is full and the
next one is chained to it.  Two fingerprints are compared filter by filter: bits
in common, less what chance gives, over the most that is possible; each filter of
the shorter chain counts with its best partner.

All sums are whole numbers, so equal texts have equal fingerprints.  Texts under
64 bytes are one feature.  Null and empty texts have an empty fingerprint; it is
like another empty one (1) and unlike any other (0).  Rows with equal ``doc_id``
follow each other by text hash; null ids come first.  Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import stored
from corpusloom.llm.words import BLOCK_BYTES, blocks, mix

WINDOW = 64
BINS = 1_001
TRIVIAL = 100  # windows below this entropy are features only where there are no others
POINTS = 16
BITS = 2_048
HASHES = 5
FILTER_FEATURES = 160
RANGE_ROWS = 2_000
MAX_RANGES = 65_536  # bounds the ranges' first ids, which every task gets
PART = 1 << 18  # bytes whose counts stay in the processor's cache

_C = np.arange(WINDOW + 1, dtype=float)
_TERM = np.round(np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0.0) * 65_536).astype(np.int64)
_GAIN = np.concatenate([[0], np.diff(_TERM)])
_FULL = int(_TERM[WINDOW])
_WEIGHTS = np.random.Generator(np.random.PCG64(8)).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy class (0 to 1,000) of every window of 64 bytes."""
    windows = len(data) - WINDOW + 1
    if windows <= 0:
        return np.empty(0, dtype=np.int16)
    ahead, behind = np.ones(len(data), dtype=np.uint8), np.ones(len(data), dtype=np.uint8)
    for a in range(0, len(data), PART):
        # Pairs whose first byte lies in this part.
        stop = min(a + PART, len(data))
        for k in range(1, WINDOW):
            last = min(stop, len(data) - k)
            if last <= a:
                break
            same = (data[a:last] == data[a + k:last + k]).view(np.uint8)
            ahead[a:last] += same
            behind[a + k:last + k] += same
    steps = _GAIN[behind[WINDOW:]] - _GAIN[ahead[:windows - 1]]
    first = int(_TERM[np.bincount(data[:WINDOW], minlength=256)].sum())
    repeats = first + np.concatenate([[0], np.cumsum(steps)])
    return ((_FULL - repeats) * (BINS - 1) // _FULL).astype(np.int16)


def valid_windows(offsets: np.ndarray, size: int) -> np.ndarray:
    """Whether a window lies inside one text."""
    good = np.zeros(size + 1, dtype=np.int8)
    long = np.diff(offsets) >= WINDOW
    good[offsets[:-1][long]] += 1
    good[offsets[1:][long] - WINDOW + 1] -= 1
    return np.cumsum(good[:size], dtype=np.int8) > 0


def histogram(texts: pa.Array) -> np.ndarray:
    total = np.zeros(BINS, dtype=np.int64)
    for _, _, data, offsets in blocks(texts):
        classes = entropies(data)
        if len(classes):
            total += np.bincount(classes[valid_windows(offsets, len(classes))], minlength=BINS)
    return total


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of every entropy class, the rarest first, trivial ones last."""
    order = np.lexsort((-np.arange(BINS), counts))
    rank = np.empty(BINS, dtype=np.int64)
    rank[order] = np.arange(BINS)
    rank[:TRIVIAL] += BINS
    return rank


def _features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, text number)`` of the features of a block of texts, in order."""
    classes = entropies(data)
    sizes = np.diff(offsets)
    hashes, owners = [], []
    long = np.flatnonzero(sizes >= WINDOW)
    if len(long):
        key = (rank[classes] << 32) | np.arange(len(classes))
        least, span = key, 1
        while span < WINDOW:  # smallest of 64 windows by doubling
            step = min(span, WINDOW - span)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            span += step
        windows = sizes[long] - WINDOW + 1
        runs = np.maximum(windows - WINDOW + 1, 0)
        points = np.zeros(len(classes), dtype=np.int32)
        mine = np.zeros(len(least) + 1, dtype=np.int8)
        with_runs = runs > 0
        np.add.at(mine, offsets[long][with_runs], 1)
        np.add.at(mine, (offsets[long] + runs)[with_runs], -1)
        if len(least):
            picked = least[np.cumsum(mine[:len(least)], dtype=np.int8) > 0] & 0xFFFFFFFF
            points += np.bincount(picked, minlength=len(classes)).astype(np.int32)
        need = np.zeros(len(classes) + 1, dtype=np.int32)
        enough = np.minimum(POINTS, np.maximum(1, -(-runs // 4))).astype(np.int32)
        np.add.at(need, offsets[long], enough)
        np.add.at(need, offsets[long] + windows, -enough)
        chosen = np.flatnonzero((points > 0) & (points >= np.cumsum(need[:len(classes)])))
        owner = np.searchsorted(offsets, chosen, side="right") - 1
        lone = np.setdiff1d(long, owner)  # few windows, or none with enough points
        if len(lone):
            best = []
            for i in lone.tolist():
                a, b = int(offsets[i]), int(offsets[i + 1]) - WINDOW + 1
                p = points[a:b]
                best.append(a + int(np.argmax(p)) if p.any() else int(key[a:b].min() & 0xFFFFFFFF))
            chosen, owner = np.concatenate([chosen, best]), np.concatenate([owner, lone])
            order = np.argsort(chosen, kind="stable")
            chosen, owner = chosen[order], owner[order]
        for at in range(0, len(chosen), 65_536):
            some = chosen[at:at + 65_536].astype(np.int64)
            cells = data[some[:, None] + np.arange(WINDOW)].astype(np.uint64) + np.uint64(1)
            hashes.append(mix((cells * _WEIGHTS).sum(axis=1, dtype=np.uint64)))
        owners.append(owner)
    short = np.flatnonzero((sizes > 0) & (sizes < WINDOW))
    if len(short):
        cells = np.zeros((len(short), WINDOW), dtype=np.uint64)
        for row, i in enumerate(short.tolist()):
            cells[row, :sizes[i]] = data[offsets[i]:offsets[i + 1]].astype(np.uint64) + np.uint64(1)
        hashes.append(mix((cells * _WEIGHTS).sum(axis=1, dtype=np.uint64)))
        owners.append(short)
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return h[order], o[order]


def fingerprints(texts: list[str] | pa.Array, rank: np.ndarray) -> list[np.ndarray]:
    """Per text its chain of filters, an array of ``(filters, 256)`` bytes."""
    if not isinstance(texts, (pa.Array, pa.ChunkedArray)):
        texts = pa.array(texts, type=pa.large_string())
    chains = []
    for first, last, data, offsets in blocks(texts):
        hashes, owner = _features(data, offsets, rank)
        count = np.bincount(owner, minlength=last - first)
        filters = -(-count // FILTER_FEATURES)
        base = np.cumsum(filters) - filters
        number = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
        at = (base[owner] + number // FILTER_FEATURES) * BITS
        bits = np.zeros(int(filters.sum()) * BITS, dtype=bool)
        for k in range(HASHES):
            bits[at + ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits).reshape(-1, BITS // 8)
        chains += [packed[b:b + n] for b, n in zip(base.tolist(), filters.tolist())]
    return chains


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    set_a, set_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = np.empty(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1, dtype=np.int64)
        chance = set_a[i] * set_b / BITS
        most = np.minimum(set_a[i], set_b)
        best[i] = np.max(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0))
    return float(best.mean())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def corpus_rarity(docs: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            total += histogram(batch.column(0))
        classes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int32()), pa.array(total[classes], pa.int64())], ["c", "n"])

    rows = docs.select("text").mapInArrow(count, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BINS, dtype=np.int64)
    for r in rows:
        counts[r["c"]] = r["n"]
    return rarity(counts)


LEAST = -(2**62)  # stands for a null id


def with_next(docs: DataFrame, rows: int) -> DataFrame:
    """Documents in ranges of ``doc_id``, each range sorted and followed by the
    first document of the next one (``tail``); after the last comes the first."""
    ids = stored(docs.select(F.coalesce("doc_id", F.lit(LEAST)).alias("id")).repartitionByRange(
        max(1, min(MAX_RANGES, rows // RANGE_ROWS)), "id").select("id", F.spark_partition_id().alias("part")), "ids")
    firsts = np.array(sorted(r[1] for r in ids.groupBy("part").agg(F.min("id")).collect()), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(id_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, id_.to_numpy(dtype=np.int64), side="right") - 1)

    @F.pandas_udf("boolean")
    def opens(id_: pd.Series) -> pd.Series:
        return id_.isin(firsts)

    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "__id", F.coalesce("doc_id", F.lit(LEAST)))
    ranged = whole.withColumn("__range", range_of("__id")).withColumn("__opens", opens("__id"))
    before = F.pmod(F.col("__range") - 1, F.lit(len(firsts)))
    places = F.when(F.col("__opens"), F.array(
        F.struct(F.col("__range").alias("r"), F.lit(False).alias("tail")), F.struct(before.alias("r"), F.lit(True).alias("tail")))
    ).otherwise(F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("tail"))))
    spread = ranged.withColumn("__to", F.explode(places)).select(
        "__id", "text", F.col("__to.r").alias("__range"), F.col("__to.tail").alias("__tail"))
    return spread.repartition("__range").sortWithinPartitions("__range", "__tail", "__id", F.xxhash64("text"))


def op8(docs: DataFrame) -> DataFrame:
    rows = docs.count()
    if rows == 0:
        return docs.select("doc_id").filter("false").selectExpr(
            "doc_id", "0L as n_chars", "'' as edited_sha256", "'' as fingerprint", "'' as edited_fingerprint",
            "0.0D as near_edited", "0.0D as near_next")
    rank = corpus_rarity(docs)
    ordered = with_next(docs, rows)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from base64 import b64encode
        from hashlib import sha256

        def written(chain: np.ndarray) -> str:
            return b64encode(chain.tobytes()).decode()

        waiting: list[tuple] = []  # the last row seen and its chain
        for whole in batches:
            cuts = [0]
            size = whole["text"].str.len().to_numpy()
            room = 0
            for i, n in enumerate(size.tolist()):
                if room > BLOCK_BYTES:
                    cuts.append(i)
                    room = 0
                room += n
            for a, b in zip(cuts, [*cuts[1:], len(whole)]):
                batch = whole.iloc[a:b]
                chains = fingerprints(batch["text"].tolist(), rank)
                seen = [*waiting, *zip(batch["__range"].tolist(), batch["__tail"].tolist(), batch["__id"].tolist(),
                                       batch["text"].tolist(), chains)]
                pairs = [(x, y) for x, y in zip(seen, seen[1:]) if x[0] == y[0] and not x[1]]
                waiting = seen[-1:]
                changed = [edited(x[3], y[3]) for x, y in pairs]
                after = fingerprints(changed, rank)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if x[2] == LEAST else x[2] for x, _ in pairs], dtype="Int64"),
                    "n_chars": [len(x[3]) for x, _ in pairs],
                    "edited_sha256": [sha256(t.encode()).hexdigest() for t in changed],
                    "fingerprint": [written(x[4]) for x, _ in pairs],
                    "edited_fingerprint": [written(c) for c in after],
                    "near_edited": [likeness(x[4], c) for (x, _), c in zip(pairs, after)],
                    "near_next": [likeness(x[4], y[4]) for x, y in pairs],
                })

    return ordered.mapInPandas(digest, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                       "edited_fingerprint string, near_edited double, near_next double")
