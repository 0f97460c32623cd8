"""Scores, toxicity, packing, fingerprints and the Jaccard join against brute force."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import fingerprints, graph, jaccard_join, language_model, packing, toxicity

GAP = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in GAP.split((text or "").translate(LOWER)) if w]


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


@pytest.mark.parametrize("op", [language_model.op3, packing.op7, fingerprints.op8, jaccard_join.op10])
def test_no_documents(no_docs, op):
    assert op(no_docs).count() == 0


# --- language model ---
def base_scores(rows):
    counts = Counter()
    for i, t, *_ in rows:
        if crc(i) % 5 != 1:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t, *_ in rows:
        tokens = [*words(t), None]
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((i, crc(i) % 5 == 1, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(score, 4)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [1 << 20, 50])
def test_base_scores(docs, rows, monkeypatch, share):
    monkeypatch.setattr(language_model, "HOT_SHARE", share)
    got = language_model.op3(docs).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
                   for r in got), key=repr) == base_scores(rows)


def test_model_beats_single_words(spark, given):
    df = spark.createDataFrame([(i, t) for i, t, _ in given], "doc_id long, text string")
    held = [r for r in language_model.op3(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_class_softmax_is_a_distribution():
    weights = np.random.default_rng(1).normal(size=(language_model.FEATURES, language_model.CLASSES))
    total = np.exp(language_model.log_softmax(weights, np.arange(100))).sum(axis=1)
    assert np.allclose(total, 1)


# --- toxicity ---
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    terms = ["=idiot", "=moron", "lowei", "=bad", "=moronic"]
    matcher = toxicity.Matcher(terms)
    alphabet = "idotmrnlweacx"
    rng = np.random.default_rng(3)
    tried = ["idiot", "idoit", "idit", "idiiot", "xdiot", "bad", "bed", "loweischaft", "lowischaft", "moroni", "", "é"]
    tried += ["".join(rng.choice(list(alphabet), rng.integers(1, 9))) for _ in range(3_000)]
    tried += [t.lstrip("=")[:i] + c + t.lstrip("=")[i + k:] for t in terms for i in range(7) for k in (0, 1) for c in ("x", "")]
    for word in tried:
        found = []
        for t, term in enumerate(terms):
            plain = term.lstrip("=")
            ends = [word] if term.startswith("=") else [word[:k] for k in range(len(word))]
            least = min((edit_distance(e, plain) for e in ends), default=9)
            if least == 0 or (least == 1 and term.startswith("=") and len(plain) >= toxicity.FUZZY_LENGTH):
                found.append((least, t))
        assert matcher.find(word) == min(found, default=None), word


def test_learns_terms_and_context(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"{a}{b}{c}o" for a, b, c in itertools.product("bdfgk", "aeiou", "lmnrs")]
    texts, labels = [], []
    for i in range(600):
        body = list(rng.choice(vocabulary, 40))
        bad = i % 6 == 0
        if bad:
            body.insert(5, ["snorfle", "grumpet", "snorfled"][i // 6 % 3])
        elif i % 31 == 1:
            body.insert(5, 'he said "snorfle" once')
        texts.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    texts += [(1_000, "you snorfel kala snorfl bako"), (1_001, ""), (1_002, None), (1_003, "kala bako")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    scored = {r["doc_id"]: r for r in toxicity.op4(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert len(scored) == len(texts)
    held = [(i, y) for i, y in labels if crc(i) % 3 == 1]
    assert all(scored[i]["held_out"] and scored[i]["predicted"] == y for i, y in held)
    assert scored[1_000]["score"] > scored[1_003]["score"] and scored[1_001]["score"] == scored[1_002]["score"]


def test_chances_do_not_depend_on_the_sample(spark):
    whole, capped = {0: 54_000, 1: 6_000}, {0: 6_000, 1: 6_000}
    for belief, weight in ((toxicity.MISSPELLED, 2.0), (0.5, 1.0)):
        unseen = [toxicity._chance(0, 0, size, 0.1, belief, weight) for size in (whole, capped)]
        assert unseen == [belief, belief] and belief < toxicity.THRESHOLD
    # As many rows, of which the same part is toxic in all labelled rows.
    assert abs(toxicity._chance(5, 5, whole, 0.1) - toxicity._chance(9, 1, capped, 0.1)) < 1e-9


def test_without_labels(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.op4(docs, none).collect()
    assert len(got) == len(rows) and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    assert toxicity.drop_toxic(docs, none).columns == docs.columns


# --- packing ---
def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_bounds_are_best():
    rng = np.random.default_rng(7)
    for _ in range(30):
        lengths = sorted(rng.choice(np.arange(1, 60), 9, replace=False).tolist())
        counts = rng.integers(1, 50, 9).tolist()
        for buckets in (1, 2, 4, 12):
            best = min(padding(lengths, counts, {*inner, lengths[-1]})
                       for k in range(min(buckets, 9)) for inner in itertools.combinations(lengths[:-1], k))
            bounds = packing.best_bounds(lengths, counts, buckets)
            assert len(bounds) <= buckets and padding(lengths, counts, bounds) == best


def test_packing(docs, rows, monkeypatch):
    monkeypatch.setattr(packing, "CONTEXT", 1_000)
    got = packing.batches(packing.pieces(docs, 1_000)).collect()
    texts = defaultdict(list)
    for r in sorted(got, key=lambda r: r["piece"]):
        texts[r["doc_id"]].append(r["text"])
        assert r["n_tokens"] == len(words(r["text"])) <= 1_000
    for i, t, *_ in rows:
        if i != 3:
            assert "".join(texts[i]) == (t or "")
    places = [(r["bucket"], r["batch"], r["slot"]) for r in got]
    assert len(set(places)) == len(places)
    for r in got:
        assert max(r["n_tokens"], 1) <= r["padded"] and (r["slot"] + 1) * r["padded"] <= max(packing.TOKEN_BUDGET, r["padded"])
    lengths = packing.piece_lengths(docs, 1_000).collect()
    assert Counter(map(tuple, lengths)) == Counter((r["doc_id"], r["piece"], r["n_tokens"]) for r in got)


def test_batches_follow_the_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "TOKEN_BUDGET", 30)
    monkeypatch.setattr(packing.batches, "__defaults__", (packing.BUCKETS, 30, None))
    # 300 rows in the order of a mix: every third from b, ten documents of it again and again.
    rows = [(1_000 + i // 3 % 10, "one two three") if i % 3 == 2 else (i, "one two three") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "x"), mode="append")
    spark.createDataFrame([(7_000, "one two three")], "doc_id long, text string").repartition(3).limit(0).write.parquet(
        str(tmp_path / "x"), mode="append")
    got = packing.pack(spark.read.parquet(str(tmp_path / "x"))).collect()
    got = sorted(got, key=lambda r: (r["batch"], r["slot"]))
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    for k in range(30):
        batch = [r["doc_id"] for r in got if r["batch"] == k]
        assert abs(sum(i >= 1_000 for i in batch) - len(batch) / 3) < 1 and len(set(batch)) == len(batch) == 10


# --- fingerprints ---
def test_entropy_classes():
    rng = np.random.default_rng(4)
    for data in (rng.integers(0, 256, 500), rng.integers(97, 102, 300), np.full(100, 65), np.arange(64)):
        data = data.astype(np.uint8)
        for i, c in enumerate(fingerprints.entropies(data)):
            seen = Counter(data[i:i + 64].tolist())
            h = -sum(n / 64 * math.log2(n / 64) for n in seen.values())
            assert abs(h / 6 * 1_000 - c) <= 1.01


def test_fingerprints(docs, rows):
    got = fingerprints.op8(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by = {r["doc_id"]: r for r in got}
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for row, following in zip(order, order[1:] + order[:1]):
        text, after, r = row[1] or "", following[1] or "", by[row[0]]
        half = len(text) // 2
        if row[0] != 3:
            changed = text[:len(text) - half] + after[:half]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
            assert (r["near_edited"] == 1) or changed != text
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by[1]["fingerprint"] == by[3]["fingerprint"] and by[4]["fingerprint"] == by[5]["fingerprint"] == ""
    assert by[1]["near_next"] > 0.8  # the next text differs by one word


def test_blocks_do_not_change_fingerprints(given, monkeypatch):
    texts = [t for _, t, _ in given][:60]
    counts = np.arange(fingerprints.BINS)
    rank = fingerprints.rarity(counts)
    whole = fingerprints.fingerprints(texts, rank)
    alone = [fingerprints.fingerprints([t], rank)[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(whole, alone))
    assert all(fingerprints.likeness(a, a) == 1 for a in whole)
    assert all(len(base64.b64encode(a.tobytes())) >= 340 for a in whole)


# --- Jaccard join ---
def brute_components(rows):
    sets = []
    for i, t, *_ in rows:
        w = words(t)
        sets.append((i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    lists = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            lists[x].append(k)
    for a, b in {p for ks in lists.values() for p in itertools.combinations(ks, 2)}:
        s, t = sets[a][1], sets[b][1]
        if 100 * len(s & t) >= 75 * len(s | t):
            label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return Counter((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets))


def joined(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.op10(df).collect())


def test_join_awkward(docs, rows):
    assert joined(docs) == brute_components(rows)


def test_join_given(spark, given):
    assert joined(spark.createDataFrame([(i, t) for i, t, _ in given], "doc_id long, text string")) == brute_components(given)


@pytest.mark.parametrize("cost", [0, 3, 200])
def test_join_small_and_chained_sets(spark, monkeypatch, cost):
    """Sets around every boundary, chains of links, and lists that hold several components."""
    jaccard_join.boundary.cache_clear()
    monkeypatch.setattr(jaccard_join, "CHECK_COST", cost)
    monkeypatch.setattr(jaccard_join, "boundary", lambda edge=jaccard_join.boundary(cost): edge)
    rng = np.random.default_rng(cost)
    rows = []
    for family in range(30):
        size = int(rng.integers(1, 24))
        now = [f"f{family}x{k}" for k in range(size + 4)]
        for _ in range(12):
            rows.append((len(rows), " ".join(now)))
            now = list(now)
            for _ in range(int(rng.integers(0, 3))):
                if rng.random() < 0.5 and len(now) > 1:
                    now.pop(0 if rng.random() < 0.5 else -1)
                else:
                    now.append(f"f{family}y{rng.integers(0, 9)}")
    shared = " ".join(f"s{k}" for k in range(20))
    rows += [(len(rows) + k, " ".join(f"u{k}v{j}" for j in range(k % 9)) + " " + shared) for k in range(40)]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_one_of_each_group_stays(docs, rows):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for (i, _, c), _ in brute_components(rows).items() if i is None or i == c}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_no_text_goes_with_another_of_its_id(spark):
    words = [f"w{k}" for k in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(1, text), (None, near), (2, near), (2, "an unrelated text of its own that stays"), (3, None), (3, None), (None, "x")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter([rows[0], rows[3], rows[4], rows[5], rows[6]])
    same = [(7, text), (7, near), (7, text), (None, near)]
    kept = jaccard_join.keep_one(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in kept} == {7} and len({r["text"] for r in kept}) == 1


def test_batches_are_bounded_in_bytes(spark, docs):
    from corpusloom.llm import tables
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    tables.bounded_batches(docs)
    assert int(spark.conf.get(setting).rstrip("bB")) == tables.BATCH_BYTES
    spark.conf.set(setting, "1000")
    tables.bounded_batches(docs)
    assert spark.conf.get(setting) == "1000"
    spark.conf.unset(setting)


def test_matcher_forgets(monkeypatch):
    found = {w: toxicity.Matcher(["=stupid", "idio"]).find(w) for w in ("stupid", "stupit", "idiotic", "other", "stuppid")}
    monkeypatch.setattr(toxicity, "STATES", 3)
    small = toxicity.Matcher(["=stupid", "idio"])
    assert {w: small.find(w) for w in found} == found == {w: small.find(w) for w in found}


def test_components(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1_000, 1_000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(path + star + [(5_000, 4_000)], "a long, b long")
    got = {r["node"]: r["label"] for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1_000 + i: 1_000 for i in range(300)}, 4_000: 4_000, 5_000: 4_000}
