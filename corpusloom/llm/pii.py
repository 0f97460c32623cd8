"""Personal data: patterns propose spans, checksums confirm them, words nearby
adjust the score.

All of it is column expressions over one text; nothing is shuffled.  Positions
are code points.  They come from the lengths of the pieces between the matches,
summed in proportion to their number, so a text of any length costs time in proportion to it.

Null and empty texts have no spans.  Repeated rows are rows of their own; other
columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import running_sum
from corpusloom.functions.text import let

CONTEXT = 40  # code points before a span that are searched for a context word
THRESHOLD = 0.5
BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``guard`` is a cheap condition it needs, ``check``
    confirms a match; ``words`` nearby raise ``score`` by ``BONUS``."""

    name: str
    pattern: str
    guard: tuple[str, ...]
    score: float
    words: str


# The possessive quantifiers and look-behinds match exactly what the plain
# patterns match; they only keep long runs of letters or digits from costing
# quadratic time and repeated groups from recursing.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         ("@",), 0.9, r"mail|contact|write to"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", (".",), 0.6, r"\bip\b|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", (), 0.9, r"card|visa|master|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), 0.6, r"phone|tel|call|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [0-9]{1,3})?)",
         (), 0.9, r"iban|account|bank"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", ("-",), 0.3, r"ssn|social security|insurance"),
)
BASE = 4  # the first kinds are kept whenever their check holds
ORDER = {kind.name: i for i, kind in enumerate(KINDS)}


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its own digits summed; the total ends in 0."""
    doubled = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0


def mod97(c: Column) -> Column:
    """ISO 7064: first four characters to the end, letters as 10 to 35, remainder 1."""
    compact = F.replace(c, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def step(rest: Column, ch: Column) -> Column:
        letter = ch.between("A", "Z")
        return F.when(letter, (rest * 100 + F.ascii(ch) - 55) % 97).otherwise(
            (rest * 10 + F.ascii(ch) - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda ch: ch != ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return F.rlike(match, F.lit(rf"^{part}\.{part}\.{part}\.{part}$"))
    if kind == "card":
        digits = digits_of(match)
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits_of(match)).between(10, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & mod97(match)
    return F.lit(True)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double,text:string>>"


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in order."""
    rank = ORDER[kind.name]

    def located(found: Column) -> Column:
        gaps = F.split(text, kind.pattern, -1)
        return let(gaps, lambda g: let(
            running_sum(F.transform(found, lambda m, i: F.length(m) + F.length(F.get(g, i)))),
            lambda ends: F.filter(
                F.transform(found, lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.lit(rank).alias("rank"),
                    F.get(ends, i).alias("end"),
                    F.lit(kind.name).alias("kind"),
                    (F.lit(kind.score) + F.when(F.rlike(F.lower(F.right(F.get(g, i), F.lit(CONTEXT))), F.lit(kind.words)),
                                                BONUS).otherwise(0.0)).alias("score"),
                    m.alias("text"))),
                lambda s: confirmed(kind.name, s["text"]) & (F.lit(rank < BASE) | (s["score"] >= THRESHOLD)))))

    needed = F.rlike(text, F.lit("[0-9]")) if kind.name != "email" else F.lit(True)
    for part in kind.guard:
        needed = F.contains(text, F.lit(part)) & needed
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast(SPANS)
    return F.when(needed, let(hits, lambda found: F.when(F.size(found) > 0, located(found)).otherwise(none))
                  ).otherwise(none).cast(SPANS)


def find(docs: DataFrame, text: str = "text", target: str = "pii") -> DataFrame:
    """Add ``target``: all spans by start, then kind, as structs."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(target, F.sort_array(F.concat(*[spans_of(whole, k) for k in KINDS])))


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"))
    count = lambda i: F.size(F.filter("pii", lambda s: s["rank"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{KINDS[i].name}") for i in range(BASE)],
        F.sha2(written(F.filter("pii", lambda s: s["rank"] < BASE)), 256).alias("base_sha256"),
        written(F.col("pii")).alias("spans"))


def _sql() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [0-9]{1,3})?)",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    steps = []
    for name, pattern in plain.items():
        steps.append(f"""
{name}_m AS (SELECT id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g
  FROM d WHERE regexp_matches(t, '{pattern}')),
{name}_i AS (SELECT id, m, g, unnest(range(1, len(m) + 1)) AS i FROM {name}_m),
{name} AS (SELECT id, m[i] AS m, lower(right(g[i], {CONTEXT})) AS ctx,
    CAST(list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT) AS s
  FROM {name}_i),""")
    luhn_sum = ("list_sum([CASE WHEN j % 2 = 0 THEN CAST(r[j + 1] AS INT) ELSE "
                "(CAST(r[j + 1] AS INT) * 2) % 10 + CAST(r[j + 1] AS INT) // 5 END FOR j IN range(0, length(r))]) % 10 = 0")
    mod = ("list_reduce(list_prepend(0, [CASE WHEN c BETWEEN 'A' AND 'Z' THEN ascii(c) - 55 ELSE ascii(c) - 48 END "
           "FOR c IN string_split(substr(b, 5) || substr(b, 1, 4), '')]), "
           "lambda a, x: CASE WHEN x > 9 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END) = 1")
    return f"""
WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents), {''.join(steps)}
spans AS (
  SELECT id, s, 0 AS rank, s + length(m) AS e, 'email' AS kind FROM email
  UNION ALL SELECT id, s, 1, s + length(m), 'ip' FROM ip
    WHERE list_max([TRY_CAST(p AS HUGEINT) FOR p IN string_split(m, '.')]) <= 255
  UNION ALL SELECT id, s, 2, s + length(m), 'card' FROM (
    SELECT *, reverse(regexp_replace(m, '[^0-9]', '', 'g')) AS r FROM card) WHERE length(r) BETWEEN 14 AND 19 AND {luhn_sum}
  UNION ALL SELECT id, s, 3, s + length(m), 'phone' FROM phone
    WHERE length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 10 AND 15
  UNION ALL SELECT id, s, 4, s + length(m), 'iban' FROM (SELECT *, replace(m, ' ', '') AS b FROM iban)
    WHERE length(b) BETWEEN 15 AND 34 AND {mod}
  UNION ALL SELECT id, s, 5, s + length(m), 'ssn' FROM ssn
    WHERE regexp_matches(ctx, '{KINDS[5].words}')),
one AS (
  SELECT id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip,
    count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < {BASE}) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY id)
SELECT id AS doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN one USING (id)"""


SQL = _sql()
