"""Words and word shingles of many texts at once, as numpy arrays.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Everything works on the
UTF-8 bytes of an Arrow string column, so no Python object is made per word; a
word is represented by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SHINGLE = 5
BLOCK_BYTES = 4_000_000  # texts handled at once; one longer text is handled alone
SEGMENT_BYTES = 1 << 16  # bytes hashed at once, longer only for a longer word
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)

_rng = np.random.Generator(np.random.PCG64(20))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = _BYTE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finalizer, so that every bit depends on every bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def blocks(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of runs of texts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1, first + 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, bounds)``: byte places of all words; the words of text
    ``i`` are ``bounds[i]:bounds[i + 1]``."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]  # a text ends the word before it
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:][offsets[1:] > 0] - 1
    ends[edges] = inside[edges]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1 - start, np.searchsorted(start, offsets)


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base from 1 on, and those of its inverse from 0 on."""
    up = np.multiply.accumulate(np.full(size, _BASE, dtype=np.uint64))
    down = np.full(size, pow(int(_BASE), -1, 1 << 64), dtype=np.uint64)
    down[:1] = 1
    return up, np.multiply.accumulate(down)


def word_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A polynomial of the bytes of every word, from one running sum over a segment of the bytes."""
    hashes, ends, at = np.empty(len(start), dtype=np.uint64), start + length, 0
    while at < len(start):
        first = int(start[at])
        last = max(int(np.searchsorted(ends, first + SEGMENT_BYTES, side="right")), at + 1)
        size = int(ends[last - 1]) - first
        up, down = _powers(max(SEGMENT_BYTES, size))
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_LETTER[data[first:first + size]] * up[:size], out=sums[1:])
        begins = start[at:last] - first
        hashes[at:last] = (sums[ends[at:last] - first] - sums[begins]) * down[begins]
        at = last
    return mix(hashes + length.astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    ordered = np.sort(values)
    first = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text.  Fewer words than ``size``
    make one shingle of all of them, no words an empty set."""
    start, length, bounds = word_spans(data, offsets)
    words = word_hashes(data, start, length)
    full = max(len(words) - size + 1, 0)
    rolled = np.zeros(full, dtype=np.uint64)
    for k in range(size):
        rolled += words[k:k + full] * _PLACE[k]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(distinct(rolled[a:b - size + 1]))
        elif b > a:
            sets.append(mix((words[a:b] * _PLACE[:b - a]).sum(keepdims=True, dtype=np.uint64) + _U(b - a)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets
