"""Word hashes against their definition, and what hashing holds."""

import tracemalloc

import numpy as np
import pyarrow as pa

from corpusloom.llm import words as w


def spans(texts):
    _, _, data, offsets = next(w.blocks(pa.array(texts)))
    return data, *w.word_spans(data, offsets)[:2]


def test_hashes_are_polynomials_of_the_bytes():
    long = "q" * (w.SEGMENT_BYTES + 5)
    data, start, length = spans(["One two", None, "", f"é {long} b", " x" * w.SEGMENT_BYTES])
    texts = [bytes(data[a:a + n]).lower() for a, n in zip(start.tolist(), length.tolist())]
    assert texts[2:5] == ["é".encode(), long.encode(), b"b"]
    known = {}
    for text in set(texts):
        total, power = len(text), 1
        for byte in text:
            power = power * int(w._BASE) % 2**64
            total += int(w._BYTE[byte]) * power
        known[text] = total % 2**64
    expected = w.mix(np.array([known[t] for t in texts], dtype=np.uint64))
    assert np.array_equal(w.word_hashes(data, start, length), expected)


def test_hashing_holds_a_segment_and_not_numbers_for_every_byte():
    data, start, length = spans(["abcdefghi " * 200_000])
    w.word_hashes(data[:9], start[:1], length[:1])
    tracemalloc.start()
    w.word_hashes(data, start, length)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(data)
