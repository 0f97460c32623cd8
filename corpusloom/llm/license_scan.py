"""Licence notices by sentences: known sentences become identifiers, sequences of
identifiers are matched against ordered licence rules.

A text is normalised once: line ends become newlines, marks of comments and lists at
the beginning of a line go, A-Z is lower-cased.  It is cut into units at blank lines,
after ``. ! ? ;`` before white space and after ``:`` at the end of a line.  A unit's
lines, with runs of other characters than letters and digits as one space, are looked up
alone and with the ``LINES - 1`` lines that follow in the unit, so a wrapped sentence is found like one
on a line of its own.  A known sentence is a whole one, or has a gap: how it begins and ends
is known, and a name or a further clause stands in between.  Of known sentences that
begin on one line the longest counts, and none that lies inside another one.
A known sentence becomes its identifier, another line that speaks of a licence ``?``,
others nothing.  The rules are tried in order on
the identifier sequence; all rules that match are reported, and each identifier
belongs to the first rule that takes it.

Null and empty texts have no notice.  Repeated rows are rows of their own; extra
columns do not matter.  Only texts and units with a word that every known sentence
has one of are looked up at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let

LINES = 16  # lines over which a known sentence may be wrapped
# Normalised licence sentences and their identifiers, one letter each.
SENTENCES = {
    "released under the mit license": "M",
    "licensed under the mit license": "M",
    "this project is licensed under the mit license": "M",
    "the mit license mit": "M",
    "mit license": "M",
    "spdx license identifier mit": "M",
    "licensed under the apache license version 2 0": "A",
    "licensed under the apache license version 2 0 the license": "A",
    "apache license version 2 0": "A",
    "spdx license identifier apache 2 0": "A",
    "you may not use this file except in compliance with the license": "a",
    "you may obtain a copy of the license at": "b",
    "this work is licensed under the gnu general public license version 3": "G",
    "licensed under the gnu general public license version 3": "G",
    "gnu general public license version 3": "G",
    "spdx license identifier gpl 3 0 only": "H",
    "spdx license identifier gpl 3 0 or later": "g",
    "cc0 1 0 universal": "Z",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "P",
    "all rights reserved": "R",
    "spdx license identifier gpl 2 0 only": "X",
    "spdx license identifier gpl 2 0 or later": "x",
    "spdx license identifier bsd 2 clause": "D",
    "spdx license identifier bsd 3 clause": "T",
    "spdx license identifier isc": "I",
    "isc license": "I",
    "the isc license": "I",
    "spdx license identifier mpl 2 0": "P",
    "mozilla public license version 2 0": "P",
    # "v. 2.0" is cut behind the "v."
    "this source code form is subject to the terms of the mozilla public license v": "P",
    "spdx license identifier epl 2 0": "E",
    "spdx license identifier zlib": "z",
    "spdx license identifier unlicense": "U",
    "this is free and unencumbered software released into the public domain": "U",
    "spdx license identifier bsl 1 0": "o",
    "distributed under the boost software license version 1 0": "o",
    "boost software license version 1 0": "o",
    "either version 2 of the license or at your option any later version": "j",
    "either version 2 1 of the license or at your option any later version": "k",
    "either version 3 of the license or at your option any later version": "l",
    "version 2 of the license": "J",
    "version 2 1 of the license": "K",
    "version 3 of the license": "L",
}
# Licences of Creative Commons by their parts, version and identifier.
COMMONS = {
    ("by", "4 0"): "C", ("by sa", "4 0"): "S", ("by nc", "4 0"): "N", ("by nd", "4 0"): "V", ("by nc sa", "4 0"): "W", ("by nc nd", "4 0"): "Y",
    ("by", "3 0"): "c", ("by sa", "3 0"): "s", ("by nc", "3 0"): "y", ("by nd", "3 0"): "v", ("by nc sa", "3 0"): "w", ("by nc nd", "3 0"): "q",
}
_PARTS = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
for (_parts, _version), _id in COMMONS.items():
    _long = " ".join(_PARTS[p] for p in _parts.split())
    _kind = "international" if _version == "4 0" else "unported"
    SENTENCES |= {f"{_begin}cc {_parts} {_version}": _id for _begin in ("licensed under ", "this work is licensed under ", "spdx license identifier ")}
    SENTENCES |= {f"this work is licensed under {_a}creative commons {_long} {_version} {_kind} license": _id for _a in ("a ", "the ")}
# How a sentence with a gap begins and ends, and its identifier.
GAPS = {
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", ""): "m",
    ("the above copyright notice and this permission notice", "portions of the software"): "n",
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ""): "i",
    ("permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", ""): "i",
    ("redistribution and use in source and binary forms with or without modification are permitted", ""): "B",
    ("redistributions of source code must retain the above copyright", ""): "1",
    ("redistributions in binary form must reproduce the above copyright", ""): "2",
    ("all advertising materials mentioning features or use of this software", ""): "4",
    ("", "be used to endorse or promote products derived from this software without specific prior written permission"): "3",
    ("permission is granted to anyone to use this software for any purpose including commercial applications", ""): "z",
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software", ""): "o",
    ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ""): "E",
    ("this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0", ""): "E",
    ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", ""): "e",
}
# GNU licences by family, version and what follows it, and the identifier of a header in one sentence.
LATER = " or at your option any later version"
GNU = {
    ("", "2", LATER): "x", ("", "2", ""): "X", ("", "3", LATER): "g", ("", "3", ""): "H",
    ("lesser ", "2 1", LATER): "p", ("lesser ", "2 1", ""): "Q", ("lesser ", "3", LATER): "r", ("lesser ", "3", ""): "O",
    ("library ", "2", LATER): "d", ("library ", "2", ""): "F", ("affero ", "3", LATER): "h", ("affero ", "3", ""): "5",
}
# Behind a semicolon the version is a sentence of its own.
GNU_TERMS = {"": "u", "lesser ": "t", "library ": "t", "affero ": "f"}


def _gnu(family: str) -> str:
    return (f"you can redistribute it and or modify it under the terms of the gnu {family}general public license "
            "as published by the free software foundation")


GAPS |= {("", _gnu(family)): name for family, name in GNU_TERMS.items()}
for (_family, _version, _after), _id in GNU.items():
    GAPS |= {("", f"{_gnu(_family)} {_either}version {_version} of the license{_after}"): _id for _either in (("either ",) if _after else ("",))}
# Rules in order; a pattern is over identifiers, "." stands for one
# sentence of another meaning in between.
RULES = (
    ("BSD-4-Clause", "R?B[^B]?12[^B]?4[^B]?3"),
    ("BSD-3-Clause", "R?B[^B]?12[^B]?3|T"),
    ("BSD-2-Clause", "R?B[^B]?12|D"),
    ("MIT", "M?R?mn|M"),
    ("ISC", "I?R?i|I"),
    ("Apache-2.0", "A?ab|A"),
    ("GPL-2.0-or-later", "uj|x"),
    ("GPL-2.0-only", "uJ|X"),
    ("GPL-3.0-or-later", "ul|g"),
    ("GPL-3.0-only", "uL|H"),
    ("GPL-3.0", "G"),
    ("LGPL-2.0-or-later", "tj|d"),
    ("LGPL-2.0-only", "tJ|F"),
    ("LGPL-2.1-or-later", "tk|p"),
    ("LGPL-2.1-only", "tK|Q"),
    ("LGPL-3.0-or-later", "tl|r"),
    ("LGPL-3.0-only", "tL|O"),
    ("AGPL-3.0-or-later", "fl|h"),
    ("AGPL-3.0-only", "fL|5"),
    *[(f"CC-{parts.upper().replace(' ', '-')}-{version.replace(' ', '.')}", name) for (parts, version), name in COMMONS.items()],
    ("CC0-1.0", "Z"),
    ("MPL-2.0", "P"),
    ("EPL-2.0", "E"),
    ("EPL-1.0", "e"),
    ("Unlicense", "U"),
    ("Zlib", "z"),
    ("BSL-1.0", "o"),
    ("proprietary", "R"),
)
# Every known sentence has one of these words, and so has what speaks of a licence.
WORDS = ("licens", "licenc", "permission", "redistribution", "reserved", "cc0", "endorse", "advertising", "unencumbered")
GUARD = "|".join(WORDS)
SPEAKS = "licen[sc]e"
BREAK = r"\r\n?"
MARKS = r"\n[ \t#*/;%!<>|-]*"
CUT = r"[.!?;]+[ \t\n]+|:[ \t]*\n|\n\n+"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def units(text: Column) -> Column:
    """The units of a text, still with their line ends."""
    plain = F.regexp_replace(F.concat(F.lit("\n"), lower_ascii(text)), BREAK, "\n")
    return F.split(F.regexp_replace(plain, MARKS, "\n"), CUT, -1)


def identifier(sentence: Column) -> Column:
    """Of a known sentence, else null."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    gaps = [F.when(F.startswith(sentence, F.lit(begin)) & F.endswith(sentence, F.lit(end))
                   & (F.length(sentence) >= len(begin) + len(end)), name) for (begin, end), name in GAPS.items()]
    return F.coalesce(F.element_at(known, sentence), *gaps)


def guarded(text: Column) -> Column:
    """Whether one of ``WORDS`` occurs; a search for a plain word costs less than a pattern."""
    return let(F.lower(text), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in WORDS]))


def unit_identifiers(unit: Column) -> Column:
    """The identifiers of a unit that has a guard word."""
    words = F.transform(F.split(unit, "\n"), lambda line: F.trim(F.regexp_replace(line, "[^a-z0-9]+", " ")))

    def of(lines: Column) -> Column:
        def longest(_: Column, i: Column) -> Column:
            ends = F.sequence(i, F.least(i + LINES, F.size(lines)) - 1)
            found = F.transform(ends, lambda j: F.struct(j.alias("j"), let(
                F.array_join(F.slice(lines, i + 1, j - i + 1), " "), identifier).alias("id")))
            return F.array_max(F.filter(found, lambda x: x["id"].isNotNull()))

        def step(state: Column, at: Column) -> Column:
            new = F.coalesce(at["best"]["j"] > state["reach"], F.lit(False))
            other = (at["i"] > state["reach"]) & F.rlike(F.get(lines, at["i"]), F.lit(SPEAKS))
            return F.struct(
                F.when(new, at["best"]["j"]).otherwise(state["reach"]).alias("reach"),
                F.concat(state["ids"], F.when(new, at["best"]["id"]).when(other, "?").otherwise("")).alias("ids"))

        starts = F.transform(lines, lambda line, i: F.struct(i.alias("i"), longest(line, i).alias("best")))
        return F.aggregate(starts, F.struct(F.lit(-1).alias("reach"), F.lit("").alias("ids")), step, lambda s: s["ids"])

    return let(F.filter(words, lambda line: line != ""), of)


def identifiers(text: Column) -> Column:
    """The identifier sequence of a text, one character a sentence."""
    return F.array_join(F.transform(F.filter(units(text), guarded), unit_identifiers), "")


def licences(ids: Column) -> Column:
    """Names of the rules that match, in rule order; what a rule takes is gone for the next."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(pattern).alias("pattern")) for name, pattern in RULES])

    def step(state: Column, rule: Column) -> Column:
        hit = F.rlike(state["rest"], rule["pattern"])
        return F.struct(
            F.when(hit, F.concat(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"),
            F.when(hit, F.regexp_replace(state["rest"], rule["pattern"], F.lit("_"))).otherwise(state["rest"]).alias("rest"))

    start = F.struct(F.array().cast("array<string>").alias("found"), ids.alias("rest"))
    return F.aggregate(rules, start, step, lambda s: s["found"])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences, n_known, n_unknown``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select("doc_id", F.when(guarded(text), identifiers(text)).otherwise("").alias("sentence_ids"))
    return seen.select(
        "doc_id", "sentence_ids",
        F.when(F.col("sentence_ids") != "", licences(F.col("sentence_ids"))).otherwise(
            F.array().cast("array<string>")).alias("licences"),
        F.length(F.replace("sentence_ids", F.lit("?"), F.lit(""))).cast("long").alias("n_known"),
        (F.length("sentence_ids") - F.length(F.replace("sentence_ids", F.lit("?"), F.lit("")))).cast("long").alias("n_unknown"))


def op5(docs: DataFrame) -> DataFrame:
    return scan(docs).withColumn("licences", F.array_join("licences", ","))


def _sql() -> str:
    known = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    names, rest = [], "ids"
    for name, pattern in RULES:
        names.append(f"CASE WHEN regexp_matches({rest}, '{pattern}') THEN '{name}' END")
        rest = f"regexp_replace({rest}, '{pattern}', '_', 'g')"
    gaps = " ".join(f"WHEN starts_with(p, '{begin}') AND ends_with(p, '{end}') AND length(p) >= {len(begin) + len(end)} THEN '{name}'"
                    for (begin, end), name in GAPS.items())
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH m AS (SELECT MAP {{{known}}} AS known),
d AS (SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(chr(10) || {lower}, '{BREAK}', chr(10), 'g'), '{MARKS}', chr(10), 'g'), '{CUT}') AS us
  FROM documents WHERE regexp_matches(text, '(?i){GUARD}')),
u AS (SELECT doc_id, unnest(us) AS u, generate_subscripts(us, 1) AS un FROM d),
l AS (SELECT doc_id, un, [w FOR w IN [trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')) FOR x IN string_split(u, chr(10))] IF w <> ''] AS ls
  FROM u WHERE regexp_matches(u, '{GUARD}')),
s AS (SELECT doc_id, un, ls, unnest(range(1, len(ls) + 1)) AS i FROM l),
c AS (SELECT doc_id, un, ls, i, unnest(range(i, least(i + {LINES}, len(ls) + 1))) AS j FROM s),
f AS (SELECT doc_id, un, i, j, array_to_string(ls[i:j], ' ') AS p FROM c),
k AS (SELECT doc_id, un, i, j, coalesce(known[p], CASE {gaps} END) AS id FROM f, m),
b AS (SELECT doc_id, un, i, max(j) AS j, arg_max(id, j) AS id FROM k WHERE id IS NOT NULL GROUP BY doc_id, un, i),
q AS (SELECT s.doc_id, s.un, s.i, ls[s.i] AS line, j, id, coalesce(max(j) OVER (PARTITION BY s.doc_id, s.un ORDER BY s.i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach
  FROM s LEFT JOIN b ON s.doc_id = b.doc_id AND s.un = b.un AND s.i = b.i),
i AS (SELECT doc_id, string_agg(CASE WHEN j > reach THEN id WHEN i > reach AND regexp_matches(line, '{SPEAKS}') THEN '?' ELSE '' END, '' ORDER BY un, i) AS ids
  FROM q GROUP BY doc_id),
a AS (SELECT d.doc_id, coalesce(ids, '') AS ids FROM documents d LEFT JOIN i USING (doc_id))
SELECT doc_id, ids AS sentence_ids, concat_ws(',', {', '.join(names)}) AS licences,
  CAST(length(replace(ids, '?', '')) AS BIGINT) AS n_known, CAST(length(ids) - length(replace(ids, '?', '')) AS BIGINT) AS n_unknown
FROM a"""


SQL = _sql()
