"""The whole score against a plain reading of the model, with counts of n-grams of words in dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import language_model as lm
from corpusloom.llm.words import word_hashes

ORDERED = [(i, "red fox saw blue owl near old oak") for i in range(10)]
TURNED = "fed rox baw slue wol ear nold koa"
ROWS = [*ORDERED, (20, TURNED), (21, ""), (22, None), (23, "fox owl fox owl saw"), (23, "fox owl fox owl saw"),
        (None, "blue owl near unseen"), (1, "owl blue saw fox red oak"), (31, "old oak saw red fox"), (40, "FOX saw\nred owl")]


def training(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


def tokens(text):
    return [None, None, *(text or "").lower().split(), None]


def grams(text):
    t = tokens(text)
    for x, y, z in zip(t, t[1:], t[2:]):
        yield ("skip", x), ("skip", x, z), ("last", y), ("last", y, z), ("both", x, y), ("both", x, y, z)


def plain_scores(rows, vocabulary, weights):
    """Per prior the scores, and the sum over the training texts with each token left out."""
    v, words, table = vocabulary, Counter(), Counter()
    for doc_id, text in rows:
        if training(doc_id):
            words.update(tokens(text)[2:])
            table.update(g for kinds in grams(text) for g in kinds)
    own = dict(zip(v.own.tolist(), v.own_class.tolist()))
    by_class = lm.log_softmax(weights, np.arange(lm.CLASSES ** 2))

    def word_class(word):
        if word is None:
            return 0
        data, start, length = np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word.encode())])
        return own.get(int(word_hashes(data, start, length)[0]), int(lm.suffix_class(data, start, length)[0]))

    def log10(text, prior, less):
        total, t = 0.0, tokens(text)
        for (x, y, z), kinds in zip(zip(t, t[1:], t[2:]), grams(text)):
            a, b, c = map(word_class, (x, y, z))
            p = math.exp(by_class[a * lm.CLASSES + b, c]) * (words[z] - less + 0.5) / (
                v.class_tokens[c] - less + 0.5 * (v.class_types[c] + 1))
            for feature, both in zip(kinds[::2], kinds[1::2]):
                p = (table[both] - less + prior * p) / (table[feature] - less + prior)
            total += math.log10(p)
        return total

    scores = [[log10(text, prior, 0) for _, text in rows] for prior in lm.PRIORS]
    return scores, [sum(log10(text, prior, 1) for doc_id, text in rows if training(doc_id)) for prior in lm.PRIORS]


@pytest.mark.parametrize("share, shard, batch", [(1 << 20, 1 << 23, 2_000), (20, 64, 2)])
def test_score_counts_the_ngrams_of_words(spark, monkeypatch, share, shard, batch):
    """All words hot in one shard and one block; few hot, many shards and several blocks of one task."""
    made, vocabulary, train = {}, lm.vocabulary, lm.train
    monkeypatch.setattr(lm, "vocabulary", lambda *a: made.setdefault("vocabulary", vocabulary(*a)))
    monkeypatch.setattr(lm, "train", lambda *a: made.setdefault("weights", train(*a)))
    monkeypatch.setattr(lm, "HOT_SHARE", share)
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    if batch == 2:
        monkeypatch.setattr(lm, "RUN_BYTES", 40)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(2)
        got = sorted((repr(r["doc_id"]), r["n_tokens"], round(r["score"], 3)) for r in lm.op3(docs).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    scores, left_out = plain_scores(ROWS, made["vocabulary"], made["weights"])
    best = scores[int(np.argmax(left_out))]
    wanted = sorted((repr(i), len(tokens(t)) - 2, round(s, 3)) for (i, t), s in zip(ROWS, best))
    assert [g[:2] for g in got] == [w[:2] for w in wanted]
    assert np.allclose([g[2] for g in got], [w[2] for w in wanted], atol=0.002)


def test_words_of_one_class_differ_as_histories(spark, monkeypatch):
    """Classes alone cannot tell these texts apart: all words end alike and are none of the frequent ones."""
    monkeypatch.setattr(lm, "OWN", 1)
    pairs = [("b%dxy" % i, "c%dxy" % i) for i in range(40)]
    kept = [i for i in range(1_000) if training(i)]
    rows = [(i, f"{a} {b}") for i, (a, b) in zip(kept, pairs) for _ in range(5)]
    held = [i for i in range(1_000, 2_000) if not training(i)]
    rows += [(held[0], " ".join(pairs[4])), (held[1], f"{pairs[4][0]} {pairs[7][1]}")]
    got = {r["doc_id"]: r for r in lm.op3(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["doc_id"] >= 1_000}
    met, never_met = got[held[0]], got[held[1]]
    assert math.isclose(met["base_score"], never_met["base_score"]) and met["score"] > never_met["score"] + 0.3


def test_numbers_are_packed_and_unpacked():
    values = np.array([0, 1, 255, 256, 2**40 - 1], dtype=np.uint64)
    assert lm.unpacked_numbers(lm.packed_numbers(values)).tolist() == values.tolist()
    assert lm.unpacked_keys(lm.packed_keys(values)).tolist() == values.tolist()
    assert lm.unpacked_numbers(lm.packed_numbers(values[:0])).tolist() == lm.unpacked_keys(lm.packed_keys(values[:0])).tolist() == []
    assert lm.unpacked_numbers(lm.packed_numbers(values[:1])).tolist() == [0]
