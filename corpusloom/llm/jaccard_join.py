"""N-gram Jaccard join: a size-aware heavy-light join of word-shingle sets.

Documents with equal sets form a class (a 64-bit digest and the size); only classes
are joined.  Two sets of sizes n and m link when they share at least
``t(n, m) = ceil(3 (n + m) / 7)`` shingles.

* Light sets, up to ``boundary()`` shingles, post all their subsets of the sizes
  t(n, m) that partners can need: equal subsets are shared by every link.
* Heavy sets, and light ones that a heavy one can link with, post the first
  ``n - ceil(0.75 n) + 1`` shingles of a common order into inverted lists: sets that
  link share one of them.  The order goes by how often parts of the corpus share a
  shingle, rare ones first; any order gives the same links, this one keeps lists
  short.

The boundary is the largest size at which the subsets cost no more than posting
and checking the shingles of the list.

A posting list is never crossed with itself.  First every set is checked against
one pivot of each of its lists, the set with the largest part of its keys in other
sets too (an original rather than one of its copies, whose edits are theirs alone),
and the links found are joined into components.  Only lists that still hold several components need more: there sets
of *different* components are paired, where the places of the shared shingle leave
room for a link, so copies and near copies of one text,
however many, cost one check a set and list at most.  A pair is first bounded by
the sets' histograms (shingles per hash cell: the cell-wise minima add up to no less
than what the sets share), then every pair that is left is checked on the whole sets.

Texts: lower-cased A-Z, words ``[^\\x20\\x09-\\x0D]+``, shingles of five words, fewer
words are one shingle.  Null, empty and blank texts have empty sets and link with
nothing.  A null ``doc_id`` is larger than any other; repeated rows belong to one
class; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.graph import components
from corpusloom.llm.tables import bounded_batches, packed, stored, unpacked
from corpusloom.llm.words import blocks, mix, shingle_sets

CHECK_COST = 3  # a candidate's check, in postings
OFTEN = 2  # documents of one batch that share a shingle
LAST_SHINGLES = 1 << 20  # most shared shingles, which the common order puts last
FILTER_BITS = 1 << 27  # size of the filter of posted keys, whatever the input
FILTER_HASHES = 3
PER_CELL = 2  # shingles in a cell of a set's histogram, at most, about
FULL = 255  # a cell counts no further
_U = np.uint64


def needed(n: int, m: int) -> int:
    return -(-3 * (n + m) // 7)


def partners(n: int) -> range:
    """Sizes a set of ``n`` can link with."""
    return range(-(-3 * n // 4), 4 * n // 3 + 1)


def subset_sizes(n: int) -> list[int]:
    return sorted({needed(n, m) for m in partners(n)} - {0})


def list_length(n: int) -> int:
    return n - -(-3 * n // 4) + 1


@lru_cache(None)
def boundary(check_cost: int = CHECK_COST) -> int:
    """Largest size up to which enumerating subsets is the cheaper way."""
    n = 1
    while sum(comb(n + 1, c) for c in subset_sizes(n + 1)) <= list_length(n + 1) * (1 + check_cost):
        n += 1
    return n


def digest(one: np.ndarray) -> int:
    """Class of a set; 0 is kept for the empty set."""
    if len(one) == 0:
        return 0
    parts = np.array([np.bitwise_xor.reduce(mix(one + _U(1))), one.sum(dtype=np.uint64), len(one)], dtype=np.uint64)
    h = mix((parts * np.array([1, 3, 5], dtype=np.uint64)).sum(keepdims=True, dtype=np.uint64))
    return int(h.view(np.int64)[0]) or 1


@dataclass
class Order:
    """The most shared shingles, sorted by hash, and how often parts of the corpus share them."""

    shingles: np.ndarray
    counts: np.ndarray

    def sorted(self, one: np.ndarray) -> np.ndarray:
        if len(self.shingles) == 0:
            return one
        at = np.minimum(np.searchsorted(self.shingles, one), len(self.shingles) - 1)
        return one[np.lexsort((one, np.where(self.shingles[at] == one, self.counts[at], 0)))]


def keys_of(one: np.ndarray, late: Order) -> tuple[np.ndarray, np.ndarray]:
    """The keys under which a set is posted, and each one's place in the common order (0 for subsets)."""
    n, edge = len(one), boundary()
    keys, places = [], []
    if n <= edge:
        for c in subset_sizes(n):
            subsets = np.array(list(combinations(one.tolist(), c)), dtype=np.uint64).reshape(-1, c)
            keys.append(mix(mix(subsets + np.arange(1, c + 1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) + _U(c)))
            places.append(np.zeros(len(subsets), dtype=np.int64))
    if partners(n)[-1] > edge:
        keys.append(late.sorted(one)[:list_length(n)])
        places.append(np.arange(len(keys[-1])))
    unique, at = np.unique(np.concatenate(keys), return_index=True)
    return unique, np.concatenate(places)[at]


def sets_of(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, data, offsets in blocks(texts):
        yield first, shingle_sets(data, offsets)


def often_shared(docs: DataFrame) -> Order:
    """The shingles that documents of one batch share, at most ``LAST_SHINGLES``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, np.ndarray] = {}
            for _, sets in sets_of(batch.column(0)):
                seen |= {digest(s): s for s in sets}
            both = np.concatenate([np.empty(0, dtype=np.uint64), *seen.values()])
            h, n = np.unique(both, return_counts=True)
            often = n >= OFTEN
            yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

    rows = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "h").limit(LAST_SHINGLES).toArrow()
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    by_hash = np.argsort(h)
    return Order(h[by_hash], n[by_hash].astype(np.int32))


def live_lists(docs: DataFrame, late: Order) -> DataFrame:
    """``key`` of the lists that several classes are posted to; a task posts each class it meets once."""
    shared = docs.sparkSession.sparkContext.broadcast(late)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = {0}
        for batch in batches:
            for _, sets in sets_of(batch.column(0)):
                keys, classes = [], []
                for s in sets:
                    d = digest(s)
                    if d not in met:
                        met.add(d)
                        keys.append(keys_of(s, shared.value)[0])
                        classes.append(d)
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)),
                         pa.array(np.repeat(np.array(classes, dtype=np.int64), [len(k) for k in keys]))], ["key", "class"])

    lists = docs.select("text").mapInArrow(one, "key long, class long").groupBy("key").agg(
        F.min("class").alias("first"), F.max("class").alias("last"))
    live = stored(lists.filter("first <> last").select("key"), "live-lists")
    shared.destroy()
    return live


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the keys; a crowded one only lets more through."""
    shift = 64 // FILTER_HASHES
    bits = F.array(*[F.shiftrightunsigned("key", shift * k).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in range(FILTER_HASHES)])
    words = keys.select(F.explode(bits).alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def passes(keys: np.ndarray, live: np.ndarray) -> np.ndarray:
    shift = 64 // FILTER_HASHES
    good = np.ones(len(keys), dtype=bool)
    for k in range(FILTER_HASHES):
        bit = (keys >> _U(shift * k)) & _U(FILTER_BITS - 1)
        good &= (live[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) > 0
    return good


def cells_of(one: np.ndarray) -> np.ndarray:
    """Histogram of a set over a power of two of hash cells."""
    cells = 1 << max(0, (len(one) // PER_CELL).bit_length())
    return np.minimum(np.bincount((one & _U(cells - 1)).astype(np.int64), minlength=cells), FULL).astype(np.uint8)


def may_link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two histograms leave room for a link."""
    if a.max() == FULL or b.max() == FULL:
        return True
    a, b = a.astype(np.int32), b.astype(np.int32)
    n, m = int(a.sum()), int(b.sum())
    while len(a) > len(b):
        a = a[:len(a) // 2] + a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] + b[len(b) // 2:]
    return int(np.minimum(a, b).sum()) >= needed(n, m)


SURVEYED = "doc_id long, mark long, n long, class long, keys array<long>, places array<int>, shared int, cells binary"


def survey(docs: DataFrame, late: Order, live: np.ndarray) -> DataFrame:
    """Every document's size and class, stored; with the first of a class that a task meets
    its keys that other classes may have too and, if there are any, its histogram."""
    context = docs.sparkSession.sparkContext
    shared_late, shared_live = context.broadcast(late), context.broadcast(live)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = {0}
        for batch in batches:
            for first, sets in sets_of(batch.column(2)):
                classes, keys, places, shared, cells = [], [], [], [], []
                for s in sets:
                    d = digest(s)
                    classes.append(d)
                    mine, place = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
                    if d not in met:
                        met.add(d)
                        mine, place = keys_of(s, shared_late.value)
                        posted = len(mine)
                        good = passes(mine, shared_live.value)
                        mine, place = mine[good], place[good]
                    keys.append(mine)
                    places.append(place)
                    shared.append(1_000 * len(mine) // posted if len(mine) else 0)
                    cells.append(cells_of(s).tobytes() if len(mine) else None)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(classes, pa.int64()), _lists(keys), _lists(places).cast(pa.list_(pa.int32())),
                    pa.array(shared, pa.int32()), pa.array(cells, pa.binary())],
                    ["doc_id", "mark", "n", "class", "keys", "places", "shared", "cells"])

    found = stored(docs.select("doc_id", mark().alias("mark"), "text").mapInArrow(one, SURVEYED), "survey")
    shared_late.destroy()
    shared_live.destroy()
    return found


def mark() -> Column:
    """Tells texts of one ``doc_id`` apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    places = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(arrays).view(np.int64) if arrays else [], pa.int64()))


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that the histograms do not rule out."""

    def room(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link(np.frombuffer(x.as_buffer(), dtype=np.uint8), np.frombuffer(y.as_buffer(), dtype=np.uint8))
                    for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("class").alias("a"), F.col("cells").alias("ca"))
    right = sets.select(F.col("class").alias("b"), F.col("cells").alias("cb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb").mapInArrow(room, "a long, b long")


def whole_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``class, shingles`` of the given classes, read from the texts again and stored."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(classes.select(F.col("class").alias("key"))))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = {0}
        for batch in batches:
            for _, sets in sets_of(batch.column(0)):
                found = {}
                for s in sets:
                    d = digest(s)
                    if d not in met:
                        met.add(d)
                        found[d] = s
                ids = np.array(list(found), dtype=np.int64)
                some = np.flatnonzero(passes(ids.view(np.uint64), shared.value))
                whole = list(found.values())
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), _lists([whole[i] for i in some])], ["class", "shingles"])

    sets = stored(docs.select("text").mapInArrow(one, "class long, shingles array<long>").join(
        classes, "class", "left_semi").dropDuplicates(["class"]), "sets")
    shared.destroy()
    return sets


def checked(docs: DataFrame, pairs: DataFrame, histograms: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets link; a pair of sets meets in the JVM, one pair at a time."""
    pairs = stored(bounded(pairs, histograms), "bounded")
    classes = stored(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "classes")
    sets = whole_sets(docs, classes)
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    links = pairs.join(left, "a").join(right, "b").select(
        "a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("both"))
    return links.filter("100 * common >= 75 * (both - common)").select("a", "b")


def joinable(n: Column, place: Column, m: Column, other_place: Column) -> Column:
    """Sizes that can link, and places that leave enough shingles behind them.

    Of a list that two linked sets share first in the common order, all they share
    lies at or after their places."""
    fits = (4 * n >= 3 * m) & (4 * m >= 3 * n)
    return fits & (7 * (n - place) >= 3 * (n + m)) & (7 * (m - other_place) >= 3 * (n + m))


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents with their classes, and ``node, label`` of linked classes."""
    bounded_batches(docs)
    late = often_shared(docs)
    live = live_lists(docs, late)
    members = survey(docs, late, key_filter(live))

    with_keys = members.filter(F.size("keys") > 0)
    histograms = stored(with_keys.select("class", "n", "cells").dropDuplicates(["class"]), "histograms")
    posted = with_keys.select("class", "n", "shared", F.explode(F.arrays_zip("keys", "places")).alias("p")).select(
        "class", "n", "shared", F.col("p.keys").alias("key"), F.col("p.places").alias("place"))
    postings = stored(posted.join(live, "key").dropDuplicates(["key", "class"]), "postings")
    pivots = postings.groupBy("key").agg(F.max(F.struct("shared", "class", F.col("n").alias("m"), F.col("place").alias("other_place"))).alias("p")).select(
        "key", F.col("p.class").alias("pivot"), "p.m", "p.other_place")
    able = joinable(F.col("n"), F.col("place"), F.col("m"), F.col("other_place"))
    stars = stored(postings.join(pivots, "key").filter((F.col("class") != F.col("pivot")) & able).select(
        F.col("class").alias("a"), F.col("pivot").alias("b")).distinct(), "stars")
    links = stored(checked(docs, stars, histograms), "links")

    labels = components(links)
    labelled = postings.join(labels, postings["class"] == labels["node"], "left").select(
        "key", "class", "n", "place", F.coalesce("label", "class").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    rest = stored(labelled.join(mixed, "key"), "mixed-lists")
    other = rest.select("key", F.col("class").alias("b"), F.col("n").alias("m"), F.col("place").alias("other_place"), F.col("label").alias("other"))
    pairs = rest.join(other, "key").filter((F.col("label") < F.col("other")) & able).select(
        F.col("class").alias("a"), "b").distinct()
    fresh = pairs.join(stars.select("a", "b"), ["a", "b"], "left_anti").join(
        stars.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    more = stored(checked(docs, fresh, histograms), "more-links")
    if more.isEmpty():
        return members.select("doc_id", "mark", "n", "class"), labels
    return members.select("doc_id", "mark", "n", "class"), components(
        labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))


def labelled(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n, class, label`` of every row, stored; rows of a component share a label."""
    members, labels = linked_classes(docs)
    return stored(members.join(labels, members["class"] == labels["node"], "left").select(
        "doc_id", "mark", "n", "class", F.coalesce("label", "class").alias("label")), "labelled")


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, class, component_id`` of every row."""
    named = labelled(docs)
    # A class of empty sets links nothing; its documents answer for themselves.
    least = named.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component"))
    return named.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "class",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest ``doc_id``; all columns pass through.

    A null ``doc_id`` is larger than any other.  Rows that share a ``doc_id`` are told apart by their sets: of
    different texts with the smallest one the one with the smaller class stays, in all its rows."""
    named = labelled(docs.select("doc_id", "text")).filter("n > 0")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "class")
    least = named.groupBy("label").agg(F.min(rank).alias("least"))
    gone = stored(named.withColumn("rank", rank).join(least, "label").filter("rank <> least").select(
        F.col("doc_id").alias("id"), "mark").distinct(), "near-copies")
    rows = packed(docs, "text").withColumn("of", mark())
    left = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("of") == F.col("mark")), "left_anti")
    return unpacked(left, docs.columns)


def op10(docs: DataFrame) -> DataFrame:
    return groups(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
