"""Toxicity by a learned lexicon, found through Levenshtein automata.

The lexicon holds whole words and proper beginnings of words (a stem counts only
where more follows) that labelled training rows show to be toxic.  A trie of it is intersected with the Levenshtein automaton of
one edit: a state is the set of (trie node, edits) that a word read so far can be
in, and states are built once and kept, so a word costs one table step a
character.  A window of words around a hit tells quotation from abuse.

A text's score is one minus the product, over its distinct hits, of the chance
that the hit means nothing: learned per word, for exact and for misspelled hits
(stems must be spelled right); for stems, which clean words share now and then,
by how often any of them occurs; and for quoted hits no more than what texts with
quoted hits alone show.  Texts without hits, empty and null ones too, have
the share of toxic rows among such training texts.

Labels are learned from rows whose crc32(doc_id) mod 3 is not 1, from at most
``FIT_ROWS`` rows of either label (those with the smallest hash).  Without usable
labels every score is 0.  Repeated rows get equal scores; extra columns do not
matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import bounded_batches, packed, stored, uniform, unpacked

FIT_ROWS = 6_000  # labelled rows of either label that are learned from
MAX_TERMS = 2_000  # size of the lexicon
MIN_ROWS = 4  # toxic rows that a term needs
EVIDENCE = 14.0  # nats that a term's rows must differ from chance
RATIO = 3  # times as frequent in toxic rows as in clean ones
PREFIXES = range(3, 9)
FUZZY_LENGTH = 5  # shorter words must be spelled right
STEM_LEVELS = 6  # occurrences of stems that are told apart
WINDOW = 4  # words on either side
MISSPELLED = 0.6  # belief in a misspelled word that no row shows; alone it marks no text
THRESHOLD = 0.7
SEED = 4
QUOTED, NOTHING, STEMS = -1, -2, -3  # in the place of a term
CACHE = 100_000  # remembered words
STATES = 20_000  # built states
WORD = re.compile(r"[^\W_]+")
# Words that report speech, and marks of quotation.
REPORTS = {"said", "says", "quoted", "quote", "called", "wrote", "word", "term", "insult", "slur"}
QUOTES = "\"'“”„«»‘’"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def features(text: str) -> set[str]:
    """Whole words as ``=word``, proper beginnings as they are."""
    words = set(WORD.findall(text.lower()))
    return {f"={w}" for w in words} | {w[:k] for w in words for k in PREFIXES if len(w) > k}


class Matcher:
    """The lexicon's trie, intersected with the automaton of one edit."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}  # node of a whole word -> term
        self.stems: dict[int, int] = {}
        self.size = [len(t.lstrip("=")) for t in terms]
        for number, term in enumerate(terms):
            node = 0
            for ch in term.lstrip("="):
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                node = self.children[node][ch]
            (self.ends if term.startswith("=") else self.stems)[node] = number
        self.alphabet = {ch for edges in self.children for ch in edges}
        self.forget()

    def forget(self) -> None:
        """Start over with no states and no words; they are built again as needed."""
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stem_hit: list[tuple[int, int] | None] = []
        self.word_hit: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})
        self.known: dict[str, tuple[int, int] | None] = {}

    def _state(self, items: set[tuple[int, int]]) -> int:
        closed = set(items)
        for node, edits in items:
            if edits == 0:  # a missing character
                closed |= {(child, 1) for child in self.children[node].values()}
        members = frozenset(closed)
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            self.steps.append({})
            self.stem_hit.append(self._best(members, self.stems, 0))
            self.word_hit.append(self._best(members, self.ends, 1))
        return self.states[members]

    def _best(self, members: frozenset, ends: dict[int, int], most: int) -> tuple[int, int] | None:
        hits = [(edits, ends[node]) for node, edits in members if node in ends and edits <= most]
        return min(((e, t) for e, t in hits if e == 0 or self.size[t] >= FUZZY_LENGTH), default=None)

    def _step(self, state: int, ch: str) -> int:
        after = set()
        for node, edits in self.members[state]:
            edges = self.children[node]
            if ch in edges:
                after.add((edges[ch], edits))
            if edits == 0:  # an extra or another character
                after.add((node, 1))
                after |= {(child, 1) for child in edges.values()}
        # What one edit reaches is not needed where no edit reaches it too.
        after = {(n, e) for n, e in after if e == 0 or (n, 0) not in after}
        return self._state(after) if after else -1

    def find(self, word: str) -> tuple[int, int] | None:
        """``(edits, term)`` of the best term in ``word``, or nothing."""
        if word in self.known:
            return self.known[word]
        if len(self.known) >= CACHE or len(self.members) >= STATES:
            self.forget()
        state, best = self.start, None
        for ch in word:
            hit = self.stem_hit[state]  # a character follows
            if hit is not None and (best is None or hit < best):
                best = hit
            key = ch if ch in self.alphabet else ""
            steps = self.steps[state]
            if key not in steps:
                steps[key] = self._step(state, key)
            state = steps[key]
            if state < 0:
                break
        else:
            hit = self.word_hit[state]
            if hit is not None and (best is None or hit < best):
                best = hit
        self.known[word] = best
        return best

    def hits(self, text: str) -> Counter:
        """How often ``(term, edits, quoted)`` occurs in a text."""
        lowered = text.lower()
        words = WORD.findall(lowered)
        toxic = {w for w in set(words) if self.find(w) is not None}
        if not toxic:
            return Counter()
        spans = list(WORD.finditer(lowered))
        found: Counter = Counter()
        for i, span in enumerate(spans):
            if span.group() in toxic:
                edits, term = self.find(span.group())
                around = spans[max(0, i - WINDOW):i + WINDOW + 1]
                before, after = lowered[around[0].start():span.start()], lowered[span.end():around[-1].end() + 1]
                marked = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
                reported = any(s.group() in REPORTS for s in around)
                found[term, edits, marked or reported] += 1
        return found


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    # Per term: toxic, given a hit without an edit and given one with an edit.
    chance: list[tuple[float, float]] = field(default_factory=list)
    stems: list[float] = field(default_factory=list)  # toxic, given so many occurrences of stems
    quoted: float = 0.0  # toxic, given quoted hits only
    nothing: float = 0.0  # toxic, given no hit

    def score(self, hits: Counter) -> float:
        innocent = 1.0 - self.nothing
        plain = [key for key in hits if not key[2]]
        for term, edits, _ in plain:
            if self.terms[term].startswith("="):
                innocent *= 1.0 - self.chance[term][edits]
        level = stem_level(hits, self.terms)
        if level:
            innocent *= 1.0 - self.stems[level]
        if hits and not plain:
            innocent *= 1.0 - min(self.quoted, max(self.chance[term][edits] for term, edits, _ in hits))
        return min(max(1.0 - innocent, 0.0), 1.0)


def stem_level(hits: Counter, terms: list[str]) -> int:
    return min(STEM_LEVELS, sum(n for (t, _, quoted), n in hits.items() if not quoted and not terms[t].startswith("=")))


def _chance(toxic: float, clean: float, rows: dict[int, int], share: float, belief: float = 0.5, weight: float = 1.0) -> float:
    """P(toxic | seen): the seen rows weighted back to the labels' own share of toxic
    rows, and a belief of ``weight`` rows, whatever the sizes of the two samples."""
    seen = toxic + clean
    bad, good = share * toxic / rows[1], (1 - share) * clean / rows[0]
    return ((seen * bad / (bad + good) if bad + good else 0.0) + weight * belief) / (seen + weight)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """At most ``FIT_ROWS`` training texts of either label, and the share of toxic labels."""
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    order = uniform(SEED, "doc_id")
    chosen = [usable.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(FIT_ROWS) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    once = stored(texts.dropDuplicates(["text", "toxic"]).select("text", "toxic"), "toxicity-sample")
    return once, counts.get(1, 0) / max(1, sum(counts.values()))


def candidates(rows: DataFrame, size: dict[int, int]) -> DataFrame:
    """Features with far more toxic rows than chance gives them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for f in features(text):
                    seen[f][toxic] += 1
            yield pd.DataFrame({"f": list(seen), "clean": [c[0] for c in seen.values()], "bad": [c[1] for c in seen.values()]})

    totals = rows.mapInPandas(count, "f string, clean long, bad long").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    rate = size[1] / (size[0] + size[1])
    both = F.col("bad") + F.col("clean")
    gain = F.col("bad") * F.log(F.col("bad") / (both * rate)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - rate)))).otherwise(0.0)
    return totals.filter((F.col("bad") >= MIN_ROWS) & (F.col("bad") * size[0] > RATIO * F.col("clean") * size[1])
                         & (gain >= EVIDENCE)).select("f", "bad", gain.alias("gain")).orderBy(F.desc("bad"), "f").limit(10 * MAX_TERMS)


def lexicon(found: list[tuple[str, int, float]]) -> list[str]:
    """Of features that begin with each other the shortest, made as long as
    it can be without losing a tenth of its rows, or a whole word with more evidence;
    and whole words that make up a third of a stem, as those may be misspelled."""
    bad = {f: n for f, n, _ in found}
    evidence = {f: e for f, _, e in found}
    longer: dict[str, list[str]] = defaultdict(list)
    for f in bad:
        plain = f.lstrip("=")
        if f.startswith("="):
            longer[plain if plain in bad else plain[:-1] if plain[:-1] in bad else plain[:max(PREFIXES)]].append(f)
        else:
            longer[plain[:-1]].append(f)
    terms = set()
    for f in bad:
        plain = f.lstrip("=")
        shorter = [plain[:k] for k in PREFIXES if k < len(plain) + f.startswith("=")]
        if any(s in bad for s in shorter):
            continue
        while True:
            step = max(longer.get(f, []), key=lambda c: (bad[c], c), default=None)
            if step is None or bad[step] < 0.9 * bad[f]:
                break
            f = step
        words = [w for w in bad if w.startswith("=" + plain)]
        terms.add(max([f, *words], key=lambda w: (evidence[w], w)))
        terms.update(w for w in words if 3 * bad[w] >= bad[f])
    # Whole words first: of terms that a word matches equally well the first counts.
    return sorted(sorted(terms, key=lambda t: (-bad[t], t))[:MAX_TERMS], key=lambda t: not t.startswith("="))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows, share = sample(docs, labels)
    size = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not size[1]:
        return Model()
    if not size[0]:
        size[0] = 1
    found = candidates(rows, size).collect()
    terms = lexicon([(r["f"], r["bad"], r["gain"]) for r in found])

    def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows by label and: term and edits, only quoted hits, no hit at all."""
        matcher = Matcher(terms)
        for batch in batches:
            seen: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                hits = matcher.hits(text)
                plain = {(t, e) for t, e, quoted in hits if not quoted}
                exact = any(e == 0 for _, e in plain)
                # A misspelled hit is judged where no exact one explains the label.
                seen.update((toxic, t, e) for t, e in plain if e == 0 or not exact)
                words = any(terms[t].startswith("=") for t, _ in plain)
                level = stem_level(hits, terms)
                if level and not words:
                    seen[toxic, STEMS, level] += 1
                if not plain:
                    seen[toxic, QUOTED if hits else NOTHING, 0] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["toxic", "term", "edits", "n"])

    counts = rows.mapInPandas(observe, "toxic int, term int, edits int, n long").groupBy("toxic", "term", "edits").agg(
        F.sum("n").alias("n")).collect()
    n = Counter({(r["toxic"], r["term"], r["edits"]): r["n"] for r in counts})

    def chance(term: int, edits: int, belief: float, weight: float) -> float:
        return _chance(n[1, term, edits], n[0, term, edits], size, share, belief, weight)

    # A misspelled word is believed to mean the word rather than not, until rows say otherwise.
    each = [(chance(t, 0, 0.5, 1.0), chance(t, 1, MISSPELLED if term.startswith("=") else 0.5, 2.0)) for t, term in enumerate(terms)]
    # More occurrences never mean less.
    levels = [0.0]
    for level in range(1, STEM_LEVELS + 1):
        levels.append(max(levels[-1], chance(STEMS, level, 0.5, 1.0)))
    return Model(terms, each, levels, chance(QUOTED, 0, 0.3, 5.0), min(chance(NOTHING, 0, 0.5, 1.0), THRESHOLD / 2))


def scorer(model: Model):
    """A column function: score of a text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model.terms)
        for texts in batches:
            yield pd.Series([model.score(matcher.hits(t)) if t else model.nothing for t in texts], dtype="float64")

    return score


def scored(docs: DataFrame, labels: DataFrame, target: str = "score") -> DataFrame:
    """``docs`` plus the score of every text."""
    return bounded_batches(docs).withColumn(target, scorer(fit(docs, labels))(F.col("text")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold; all columns pass through, whatever their names."""
    score = scorer(fit(docs.select("doc_id", "text"), labels))
    return unpacked(packed(bounded_batches(docs), score("text").alias("score")).filter(F.col("score") < THRESHOLD), docs.columns)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
