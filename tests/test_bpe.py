import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import token_queries
from corpusloom.operators import bpe, dictionary, token_store

TEXTS = [
    "the cat sat on the mat.  The bat's hat!", "Tiếng Việt có dấu: ế ề ệ", "aaaa aaa aa a", "x\n\n  y\tz 123 4567",
    "they'll we've don't   nbsp", "日本語 テキスト 🙂🙂", "abab ababab abcabc bcbc", "",
]


def corpus(seed=5, n=150):
    rng = random.Random(seed)
    words = ["the", "then", "there", "hen", "aaaa", "aab", "baa", "Việt", "nam", "abc", "abcd", "bcd", "dd", "ddd"]
    return TEXTS + [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("s", i, t) for i, t in enumerate(corpus())], "source string, ord long, text string")


def public(size):
    tokenizers = pytest.importorskip("tokenizers")
    tk = tokenizers.ByteLevelBPETokenizer()
    tk.train_from_iterator(corpus(), vocab_size=size, min_frequency=2, special_tokens=["<|endoftext|>"], show_progress=False)
    return tk


@pytest.mark.parametrize("top", [4096, 12])
def test_learning_equals_public_package(spark, docs, monkeypatch, top):
    monkeypatch.setattr(bpe, "TOP", top)
    tk = public(257 + 70)
    vocab = bpe.learn(bpe.word_counts(docs), 257 + 70, checkpoint_every=9)
    model = json.loads(tk.to_str())["model"]
    names = vocab.tokens()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    assert [[names[a], names[b]] for a, b, _ in vocab.merges] == merges
    assert {t: i for i, t in enumerate(names)} == model["vocab"]
    ids = {r["ord"]: r["ids"] for r in bpe.with_token_ids(docs, vocab).collect()}
    assert ids == {i: tk.encode(t).ids for i, t in enumerate(corpus())}
    report = bpe.round_trip_report(docs, vocab).first()
    assert report["broken"] == 0 and report["tokens"] == sum(map(len, ids.values()))
    assert bpe.token_counts(docs, vocab).first()["tokens"] == report["tokens"]


@pytest.mark.parametrize("share, length, segment", [(1 << 16, 64, 1 << 13), (20, 64, 3), (1 << 16, 3, 1), (1, 64, 7)])
def test_dictionary_encodes_as_the_public_package(spark, docs, monkeypatch, share, length, segment):
    """Hot words only, both kinds, long words and none hot; texts of many segments, null and empty ones."""
    monkeypatch.setattr(dictionary, "HOT_SHARE", share)
    monkeypatch.setattr(dictionary, "HOT_BYTES", length)
    monkeypatch.setattr(dictionary, "SEGMENT", segment)
    tk = public(257 + 70)
    vocab = bpe.learn(bpe.word_counts(docs), 257 + 70)
    more = docs.unionByName(spark.createDataFrame([("s", 9_000, None)], docs.schema))
    rows = dictionary.encoded_texts(more, vocab).collect()
    assert {r["ord"]: r["ids"] for r in rows} == {i: tk.encode(t).ids for i, t in enumerate(corpus())} | {9_000: []}
    assert len(rows) == len(corpus()) + 1


def test_dictionary_holds_every_word_once(spark, docs):
    words = dictionary.word_dictionary(docs.unionByName(docs), bpe.Vocabulary(()))
    assert words.count() == words.select("word").distinct().count() == bpe.word_counts(docs).count()
    tagged = spark.createDataFrame([(0, "a!<|endoftext|> b"), (1, "")], "ord long, text string")
    rows = dictionary.encoded_texts(tagged, bpe.Vocabulary(()))
    narrow = bpe.with_token_ids(tagged, bpe.Vocabulary(()))
    assert sorted(rows.collect()) == sorted(narrow.select("ord", "ids").collect())


def test_stored_counts_equal_public_package(spark, docs, tmp_path):
    tk, store = public(257 + 40), str(tmp_path / "tokens")
    vocab = bpe.learn(bpe.word_counts(docs), 257 + 40)
    rows = docs.withColumn("source", F.when(F.col("ord") % 3 == 0, "a").otherwise("b"))
    for name, part in (("1", F.col("ord") < 50), ("2", F.col("ord") >= 50), ("2", F.col("ord") >= 50)):
        token_store.add_delivery(rows.filter(part), vocab, store, name)
    sizes = [len(tk.encode(t).ids) for t in corpus()]
    got = {r["source"]: (r["docs"], r["tokens"]) for r in token_store.stored_counts(spark, store, vocab).collect()}
    assert got == {"a": (len(sizes[::3]), sum(sizes[::3])), "b": (len(sizes) - len(sizes[::3]), sum(sizes) - sum(sizes[::3]))}
    weighted, report = token_store.stored_audit(spark, store, vocab, {"a": 3}, budget=10_000)
    assert {r["source"]: r["weighted_tokens"] for r in weighted.collect()} == {"a": 3 * got["a"][1], "b": got["b"][1]}
    assert report.first()["budget_gap_or_surplus"] == 3 * got["a"][1] + got["b"][1] - 10_000
    with pytest.raises(token_store.OtherVocabulary):
        token_store.stored_counts(spark, store, bpe.Vocabulary(vocab.merges[:-1]))


def test_special_token_in_text(spark):
    df = spark.createDataFrame([("a!<|endoftext|> b<|endoftext|>",)], "text string")
    vocab = bpe.Vocabulary(())
    ids = bpe.with_token_ids(df, vocab).first()["ids"]
    raw = vocab.token_bytes()
    assert [i for i in ids if i == 0] == [0, 0] and b"".join(raw[i] for i in ids).decode() == "a!<|endoftext|> b<|endoftext|>"
    assert len(ids) == 2 + len("a! b")


def test_pair_counts(spark):
    words = spark.createDataFrame([("aaa", 2), ("ab", 5)], "word string, freq long")
    state = words.select(bpe.symbols(F.col("word")).alias("symbols"), "freq")
    got = sorted(r["freq"] for r in bpe.pair_counts(state).collect())
    assert got == [4, 5]


def test_tables(spark):
    vocab = bpe.Vocabulary(((66, 67, 257),))
    assert vocab.merges_table(spark).first().asDict()["rank"] == 0
    assert vocab.vocab_table(spark).count() == 258
    assert vocab.roles_table(spark).first()["eos_token"] == "<|endoftext|>"
    with pytest.raises(ValueError):
        bpe.learn(spark.createDataFrame([("a", 1)], "word string, freq long"), bpe.MAX_VOCAB + 1)


def one_at_a_time(words, size, least=2):
    """Merges over byte strings, every pair counted anew for every merge."""
    ids = {t: i for i, t in enumerate(bpe.Vocabulary(()).token_bytes())}
    raw = list(ids)
    state = [([ids[bytes([b])] for b in w.encode()], n) for w, n in words]
    merges = []
    while len(raw) < size:
        counts = Counter()
        for w, n in state:
            for pair in zip(w, w[1:]):
                counts[pair] += n
        (left, right), n = min(counts.items(), key=lambda x: (-x[1], x[0]), default=((0, 0), 0))
        if n < least:
            break
        if raw[left] + raw[right] not in ids:
            ids[raw[left] + raw[right]] = len(raw)
            raw.append(raw[left] + raw[right])
        merged = ids[raw[left] + raw[right]]
        merges.append((left, right, merged))
        for w, _ in state:
            i = 0
            while i < len(w) - 1:
                if (w[i], w[i + 1]) == (left, right):
                    w[i:i + 2] = [merged]
                i += 1
    return tuple(merges)


@pytest.mark.parametrize("top, symbols", [(4_096, 1_000_000), (40, 1_000_000), (4_096, 60)])
def test_learns_until_no_pair_is_left(spark, docs, monkeypatch, top, symbols):
    monkeypatch.setattr(bpe, "TOP", top)
    monkeypatch.setattr(bpe, "PART_SYMBOLS", symbols)
    rng = random.Random(3)
    words = [("".join(rng.choices("aab", k=rng.randrange(1, 9))), rng.randrange(1, 4)) for _ in range(30)]
    words = list(dict(words).items())
    table = spark.createDataFrame(words, "word string, freq long")
    assert bpe.learn(table).merges == one_at_a_time(words, 50_257)


def test_queries_learn_the_whole_vocabulary(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(bpe, "learn", lambda words, size, least: sizes.append((size, least)) or bpe.Vocabulary(()))
    docs = spark.createDataFrame([("s", 0, "a")], "source string, ord long, text string")
    token_queries._vocabulary(docs)
    assert sizes == [(50_257, 2)]


def test_rounds_start_with_few_pairs_and_write_the_words(spark, monkeypatch):
    """The first round does not cut the whole words at every level of pairs, and equal merges come out of any schedule."""
    words = spark.createDataFrame([("abcabc", 9), ("ab", 5), ("xabcy", 4), ("aaaa", 3), ("bc", 2), ("é\U0001f600é", 2)], "word string, freq long")
    asked, bounded = [], bpe._bounded_parts
    monkeypatch.setattr(bpe, "_bounded_parts", lambda state, ranked, most: asked.append(most) or bounded(state, ranked, most))
    merges = bpe.learn(words, 300)
    assert asked[0] == bpe.FIRST_TOP < bpe.TOP
    monkeypatch.setattr(bpe, "FIRST_TOP", 1)
    assert bpe.learn(words, 300, checkpoint_every=1) == merges and len(merges.merges) > 10


def test_python_sees_texts_in_bounded_batches_and_each_word_once(spark, tmp_path, monkeypatch):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    docs = spark.createDataFrame([("a", "the cat é", 1), ("b", "the cat <|endoftext|> the", 2), ("b", "", 3), (None, None, 4), (None, "the", 5)],
                                 "source string, text string, ord long")
    vocab = bpe.learn(bpe.word_counts(docs), 270)
    rows = bpe.with_token_ids(docs, vocab)
    assert int(spark.conf.get(setting).rstrip("bB")) <= 16 << 20
    sizes = {r["ord"]: len(r["ids"]) for r in rows.collect()}
    assert sizes[3] == sizes[4] == 0 and "pandas" not in rows._jdf.queryExecution().toString().lower()
    counts = bpe.token_counts(docs, vocab)
    assert {r["source"]: r["tokens"] for r in counts.collect()} == {
        "a": sizes[1], "b": sizes[2] + sizes[3], None: sizes[5]}
    assert {r["source"]: r["broken"] for r in bpe.round_trip_report(docs.filter("text is not null"), vocab).collect()} == {"a": 0, "b": 0, None: 0}


def test_words_side_by_side_merge_as_one_by_one(spark, docs):
    """Merges that overlap, that spell a known token, long words, the special token and no merges at all."""
    rng = random.Random(8)
    words = list({"".join(rng.choices("aab", k=rng.randrange(1, 90))) for _ in range(400)}) + ["<|endoftext|>", "é\U0001f600", "", " " * 70]
    table = spark.createDataFrame([(w, 2) for w in words if w], "word string, freq long")
    learned = bpe.learn(table, 400)
    known = bpe.Vocabulary(learned.merges[:20] + ((66, 67, 257), (67, 66, 67), (67, 67, 66)) + learned.merges[20:])
    for vocab in (learned, known, bpe.Vocabulary(())):
        flat, begin, count = bpe.word_ids(vocab)(pa.array(words))
        one = bpe._word_encoder(vocab)
        assert [flat[i:i + n].tolist() for i, n in zip(begin, count)] == [[ord(c) - bpe.FIRST for c in one(w)] for w in words]


def test_encoding_shuffles_no_words(spark, docs):
    """Texts are encoded where they are read: what is shuffled does not grow with their words."""
    plan = dictionary.encoded_texts(docs, bpe.Vocabulary(()))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "Aggregate" not in plan
    words = dictionary.word_dictionary(docs, bpe.Vocabulary(())).filter("hot")._jdf.queryExecution().optimizedPlan().toString()
    assert words.index("ArrowEvalPython") < words.index("Filter")  # rare words are not encoded for the broadcast


def test_encoding_counts_the_words_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "src1", "a b a b"), (2, "src1", None)], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    calls, count = [], bpe.word_counts
    for module in (bpe, dictionary):
        monkeypatch.setattr(module, "word_counts", lambda *a, **b: calls.append(1) or count(*a, **b))
    rows = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in token_queries.bpe_encode(spark, str(tmp_path)).collect()}
    a, blank = (bpe._BYTE_ID[ord(x)] for x in "a ")
    assert len(calls) == 1 and rows == {1: (5, f"{a} 257 {blank} {a} 257"), 2: (0, "")}


def test_encoding_of_texts_that_share_a_key_or_have_none(spark):
    texts = spark.createDataFrame([(1, "b a"), (1, "b a"), (1, "c"), (2, "c b"), (None, "a")], "ord long, text string")
    rows = sorted(dictionary.encoded_texts(texts, bpe.Vocabulary(())).collect(), key=str)
    a, b, c, blank = (bpe._BYTE_ID[ord(x)] for x in "abc ")
    shared = [b, b, c, blank, a, blank, a]
    assert [(r["ord"], r["ids"]) for r in rows] == [(1, shared)] * 3 + [(2, [c, blank, b]), (None, [])]
