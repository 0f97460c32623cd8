import hashlib
import random
import unicodedata

import pytest

from corpusloom.operators import dedup as D
from corpusloom.operators.order import ROW_BITS


def key(text):
    return hashlib.sha256(unicodedata.normalize("NFC", text).encode()).hexdigest()


def sequential(rows, opted, min_paragraph, min_document):
    """The rule as one pass over the rows in order: {ord: (status, changed, text)}."""
    raw, final, paragraphs, out = set(), set(), {}, {}
    for ord_, text in sorted(rows, key=lambda r: r[0]):
        text = text or ""
        if not text:
            out[ord_] = ("empty", False, "")
            continue
        if key(text) in raw:
            out[ord_] = ("raw_duplicate", False, text)
            continue
        raw.add(key(text))
        source, clean = ord_ >> ROW_BITS, text.strip()
        if opted is None or source in opted:
            seen, kept = paragraphs.setdefault(source, set()), []
            for p in filter(None, (p.strip() for p in text.split("\n\n"))):
                if len(p) >= min_paragraph and key(p) in seen:
                    continue
                if len(p) >= min_paragraph:
                    seen.add(key(p))
                kept.append(p)
            clean = "\n\n".join(kept).strip()
        changed = clean != text.strip()
        if len(clean) < min_document:
            status = "short"
        else:
            status = "final_duplicate" if key(clean) in final else "kept"
            final.add(key(clean))
        out[ord_] = (status, changed, clean)
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    paras = ["aaaaaaaa", "bbbbbbbbb", "écccccccc", "écccccccc", "short", "  padded para ", "dddddddddd\neeee"]
    rows = []
    for i in range(n):
        source = rng.choice([0, 0, 0, 1, 2])
        text = "\n\n".join(rng.choices(paras + [f"unique {rng.randrange(60)}"], k=rng.randrange(5)))
        text = rng.choice(["", " ", "\n\n\n"]) + text + rng.choice(["", " ", "\xa0"])
        rows.append(((source << ROW_BITS) + i, None if rng.random() < 0.02 else text))
    return rows


@pytest.mark.parametrize("seed, opted, parts", [(1, None, 1), (2, [0, 2], 7), (3, [], 3), (4, None, 5)])
def test_staged_equals_sequential(spark, seed, opted, parts):
    rows = corpus(seed)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    docs = spark.createDataFrame(shuffled, "ord long, text string").repartition(parts)
    got = D.deduplicate(docs, min_paragraph=8, min_document=12, paragraph_sources=opted)
    want = sequential(rows, opted, 8, 12)
    assert {r["ord"]: (r["status"], r["changed"], r["text"]) for r in got.collect()} == want
    report = D.dedup_report(got).collect()
    assert all(r["removed_docs"] == r["removed_by_doc_dedup"] + r["removed_as_too_short"] for r in report)
    totals = D.dedup_totals(D.dedup_report(got)).first()
    kept = sum(s == "kept" for s, _, _ in want.values())
    assert (totals["total_original_docs"], totals["total_deduped_docs"]) == (len(rows), kept)
    assert totals["duplicate_rate"] == round((len(rows) - kept) / len(rows), 4)


@pytest.mark.parametrize("empty", [False, True])
def test_observed_report_equals_the_one_read_again(spark, tmp_path, empty):
    texts = [t for _, t in corpus(4)]
    rows = [] if empty else [(((i % 3) << ROW_BITS) + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "ord long, text string").repartition(5)
    decided, report = D.observed_report(D.deduplicate(docs, min_paragraph=8, min_document=12, paragraph_sources=[0, 2]), [0, 1, 2, 7])
    decided.write.parquet(str(tmp_path / "decisions"))
    again = {r["source_ord"]: r for r in D.dedup_report(spark.read.parquet(str(tmp_path / "decisions"))).collect()}
    got = {r["source_ord"]: r for r in report().collect()}
    assert set(got) == {0, 1, 2, 7} and {k: got[k] for k in again} == again
    assert len(again) == (0 if empty else 3) and got[7]["original_docs"] == 0 and got[7]["duplicate_rate"] == 0.0


def test_second_run_removes_nothing(spark):
    docs = spark.createDataFrame(corpus(9), "ord long, text string")
    once = D.kept_texts(D.deduplicate(docs, min_paragraph=8, min_document=12))
    again = D.deduplicate(once, min_paragraph=8, min_document=12)
    assert again.filter("status <> 'kept' or changed").count() == 0


def test_defaults(spark):
    long = "x" * 49
    rows = [(0, f"{long}\n\n{long}"), (1, "y" * 50 + "\n\n" + "z" * 20), (2, "q" * 19), (3, "y" * 50 + "\n\nnew text after the cut"),
            (4, "w" * 20 + " "), (5, "w" * 20)]
    got = {r["ord"]: r for r in D.deduplicate(spark.createDataFrame(rows, "ord long, text string")).collect()}
    assert got[0]["text"] == rows[0][1] and not got[0]["changed"]
    assert (got[2]["status"], got[3]["text"], got[5]["status"]) == ("short", "new text after the cut", "final_duplicate")


def test_one_text_holds_a_third(spark):
    rows = [(i, "the same long boilerplate paragraph, repeated everywhere, of enough length" + ("" if i % 3 == 0 else f"\n\nown text number {i}"))
            for i in range(3000)]
    got = D.deduplicate(spark.createDataFrame(rows, "ord long, text string").repartition(8))
    assert {r["ord"]: r["status"] for r in got.collect()} == {o: s for o, (s, _, _) in sequential(rows, None, 50, 20).items()}
