"""Personal data, exact copies, licences, mixing and sharding against plain Python."""

import glob
import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_queries import rows_of  # noqa: E402

from corpusloom.llm import exact_dedup, license_scan, mixing, pii, sharding  # noqa: E402
from corpusloom.llm.catalog import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(
            d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if passes(k, m.group())]
    return [s for _, _, s in sorted(found)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    db = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    df, result = QUERIES[name](spark, FOLDER), db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(result.columns, result.fetchall())


@pytest.mark.parametrize("op", [pii.op1, exact_dedup.op2, license_scan.op5, mixing.op6, sharding.op9])
def test_no_documents(no_docs, op):
    assert op(no_docs).count() == 0


def test_pii_awkward(spark, docs, rows):
    got = Counter((r["doc_id"], r["base_sha256"]) for r in pii.op1(docs).collect())
    want = Counter((r[0], hashlib.sha256(",".join(base_spans(r[1])).encode()).hexdigest()) for r in rows)
    assert got == want
    spans = next(r["spans"] for r in pii.op1(docs).collect() if r["doc_id"] == 14)
    assert re.sub(r"[:0-9]+", "", spans) == "email,phone,card,ip,iban,ssn"


TRICKY = [
    "a@b.c@d.e f@g", "x@y.z_q@r.s", "u@a.b.x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255", "99999999999999999999.1.1.1",
    "4111-1111-1111-1111-", "4111 1111  1111 1111", "4111111111111111 4111111111111112", "+1 (5(((( 5", "+12345678901 +1234567890123456",
    "é€😀 a@b.cd 😀 10.0.0.1", "a@" + "b" * 5_000 + ".c", "9" * 5_000, "." * 300 + "a@b.c" * 200, "no digits", "+4 5 6 7 8 9 0 1 2 3 4 5 . .",
]


def test_pii_tricky(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for r in pii.op1(df).collect():
        own = base_spans(TRICKY[r["doc_id"]])
        assert [s for s in r["spans"].split(",") if s and s.split(":")[0] in BASE] == own, TRICKY[r["doc_id"]][:80]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s.startswith(k) for s in own) for k in BASE]


def test_pii_many_spans(spark):
    text = "call a@b.cd at 10.0.0.1 now " * 4_000
    row = pii.op1(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_email"], row["n_ip"]) == (4_000, 4_000)
    assert row["spans"] == ",".join(base_spans(text))


def same(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_copies(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[same(r[1])].append(r[0])
    got = exact_dedup.op2(docs).collect()
    assert len(got) == len(rows)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    text = {r[0]: same(r[1]) for r in rows}
    for r in got:
        t = text[r["doc_id"]]
        assert (r["keep_id"], r["group_size"]) == (keep[t], len(groups[t]))
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert sum(r["kept"] for r in got) == len(groups)


def test_drop_copies_keeps_rows_whole(docs, rows):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    got = [tuple(r) for r in left.collect()]
    assert len(got) == len({same(r[1]) for r in rows}) and set(got) <= set(rows)


def test_repeated_row_stays_once(spark):
    df = spark.createDataFrame([(2, "a"), (2, "a"), (2, "a"), (None, "b"), (None, "b")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["kept"]) for r in exact_dedup.op2(df).collect())
    assert got == [("2", False), ("2", False), ("2", True), ("None", False), ("None", True)]


def test_licences(docs):
    got = {r["doc_id"]: r for r in license_scan.op5(docs).collect()}
    assert got[15]["licences"] == "MIT,Apache-2.0" and got[15]["sentence_ids"] == "AM"
    assert got[1]["licences"] == "" and got[4]["n_known"] == 0


def test_licence_sequences(spark):
    full = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction.\nThe above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software.")
    df = spark.createDataFrame([(1, "MIT License\n" + full), (2, "Under a strange license of ours."), (3, "All rights reserved.")],
                               "doc_id long, text string")
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in license_scan.op5(df).collect()}
    assert got == {1: ("Mmn", "MIT"), 2: ("?", ""), 3: ("R", "proprietary")}


WRAPPED = {
    "MIT": """Permission is
hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software
without restriction.

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License,
Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of
the License at""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
}


@pytest.mark.parametrize("mark, end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n"), (";; ", "\n")])
def test_wrapped_licences(spark, mark, end):
    texts = [(k, "".join(mark + line + end for line in t.split("\n"))) for k, t in WRAPPED.items()]
    # A blank line ends a sentence.
    texts.append(("", WRAPPED["GPL-3.0-or-later"].replace("modify\n", "modify\n\n")))
    df = spark.createDataFrame(texts, "doc_id string, text string")
    assert {r["doc_id"]: r["licences"] for r in license_scan.op5(df).collect()} == {k: k for k, _ in texts}


# Notices as they stand in files.
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
_BSD = """Copyright (c) 2020, Foo Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
_NAME = """Neither the name of Foo Inc. nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission."""
_GNU = """Copyright (C) 2020 Foo
This program is free software; you can redistribute it and/or modify
it under the terms of the GNU {} as published by
the Free Software Foundation; {}.

This program is distributed in the hope that it will be useful. See the GNU
{} for more details."""


def _gnu(name, version):
    return _GNU.format(name, version, name)


FULL = [
    ("MIT", _GRANT), ("MIT", "MIT License\n\nCopyright (c) 2020 Foo\n\n" + _GRANT), ("MIT", "Copyright 2020 Foo. All rights reserved.\n" + _GRANT),
    ("BSD-2-Clause", _BSD), ("BSD-3-Clause", _BSD + "3. " + _NAME),
    ("BSD-3-Clause", _BSD + "3. The name of the author may not be used to endorse or promote products\n   derived from this software without specific prior written permission."),
    ("BSD-4-Clause", _BSD + "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n"
                            "   This product includes software developed by Foo.\n4. " + _NAME),
    ("GPL-2.0-or-later", _gnu("General Public License", "either version 2 of the License, or\n(at your option) any later version")),
    ("GPL-2.0-only", _gnu("General Public License", "version 2 of the License")),
    ("GPL-3.0-or-later", _gnu("General Public License", "either version 3 of the License, or\n(at your option) any later version")),
    ("GPL-3.0-or-later", _gnu("General Public License", "either version 3 of the License, or\n(at your option) any later version").replace(";", ",")),
    ("GPL-2.0-or-later", _gnu("General Public License", "either version 2 of the License, or\n(at your option) any later version").replace(";", ",")),
    ("LGPL-2.1-or-later", _gnu("Lesser General Public\nLicense", "either\nversion 2.1 of the License, or (at your option) any later version")),
    ("LGPL-3.0-only", _gnu("Lesser General Public License", "version 3 of the License")),
    ("AGPL-3.0-or-later", _gnu("Affero General Public License", "either version 3 of the License, or\n(at your option) any later version")),
    ("ISC", "ISC License\n\nCopyright (c) 2020, Foo\n\nPermission to use, copy, modify, and/or distribute this software for any\n"
            "purpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not\ndistributed with this file, so be it."),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://example.org/epl"),
    ("EPL-1.0", "This program and the accompanying materials\nare made available under the terms of the Eclipse Public License v1.0\nwhich accompanies this distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy."),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty.\n\nPermission is granted to anyone to use this software for any purpose,\n"
             "including commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file.)"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-3.0", "SPDX-License-Identifier: CC-BY-ND-3.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("proprietary", "(c) Foo. All rights\nreserved."),
]


@pytest.mark.parametrize("mark, end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n")])
def test_licences_as_they_occur(spark, mark, end):
    rows = [(i, "int x;" + end * 2 + "".join(mark + line + end for line in t.split("\n")) + end + "int y = f(x);") for i, (_, t) in enumerate(FULL)]
    rows += [(1_000, None), (1_001, ""), (1_002, "licen" * 9_000), (1_003, "a license\n" * 2_000), (1_004, "MIT License\n" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.op5(df).collect()}
    assert {i: got[i]["licences"] for i in range(len(FULL))} == {i: name for i, (name, _) in enumerate(FULL)}
    assert [got[1_000 + i]["sentence_ids"] for i in range(5)] == ["", "", "", "?" * 2_000, "M" * 500]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert {r[0]: r[1] for r in con.sql(f"SELECT doc_id, sentence_ids FROM ({license_scan.SQL})").fetchall()} == {i: r["sentence_ids"] for i, r in got.items()}


def test_known_sentences_have_a_guard_word():
    known = [*license_scan.SENTENCES, *(f"{begin} {end}" for begin, end in license_scan.GAPS)]
    assert [k for k in known if not re.search(license_scan.GUARD, k)] == []
    assert {*license_scan.SENTENCES.values(), *license_scan.GAPS.values()} <= set("".join(p for _, p in license_scan.RULES))


def test_period_deviates_less_than_a_block(spark):
    for units in ([1], [500, 300, 200], [333, 333, 334], [900, 1, 99], [7] * 30 + [400]):
        total, done = sum(units), [0] * len(units)
        for slot, lane in enumerate(mixing.period(spark, units), 1):
            done[lane] += 1
            for n, a in zip(done, units):
                assert abs(n - Fraction(slot * a, total)) < 1
        assert done == units


def test_mixing_loses_nothing(docs, rows):
    turns = mixing.op6(docs).collect()
    first = Counter((r["doc_id"], r["source"]) for r in turns if r["epoch"] == 0)
    assert first == Counter((r[0], r[3]) for r in rows)
    blocks = defaultdict(set)
    for r in turns:
        blocks[r["slot"]].add(r["source"])
        assert r["epoch"] < mixing.MAX_EPOCHS
    assert all(len(s) == 1 for s in blocks.values())
    assert mixing.mix(docs).columns == docs.columns


def test_mixing_keeps_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 2)
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(1_000)], "doc_id long, source string")
    turns = mixing.schedule(df, {"a": 3, "b": 1}).collect()
    slots = {}
    for r in turns:
        slots[r["__slot"]] = r["source"]
    done = Counter()
    for n, slot in enumerate(sorted(slots), 1):
        done[slots[slot]] += 1
        if slot < 4 * mixing.MAX_EPOCHS * 50:
            assert abs(done["b"] - n / 4) < 1 and slot == n - 1


def test_many_sources_share_a_lane(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_LANES", 5)
    df = spark.createDataFrame([(i, f"s{i % 40}") for i in range(400)], "doc_id long, source string")
    assert {r["doc_id"] for r in mixing.op6(df).collect() if r["epoch"] == 0} == set(range(400))


def test_shards(docs, rows):
    got = sharding.op9(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_written_shards(spark, docs, rows, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)


def test_written_files_follow_the_slots(spark, docs, rows, tmp_path):
    """Whole rows, each shard's files in the order of its slots without gaps."""
    path = str(tmp_path / "out")
    sharding.write_shards(docs.withColumn("row", sharding.F.lit(1)).withColumn("id", sharding.F.lit(2)), path, 3)
    placed = Counter((r["doc_id"], r["shard"]) for r in sharding.place(docs, 3).collect())
    found = Counter()
    for shard in range(3):
        folder = tmp_path / "out" / f"shard={shard}"
        slots = []
        for file in sorted(folder.glob("part-*")):
            part = pq.read_table(file).to_pylist()
            slots += [r["slot_"] for r in part]
            found.update((r["doc_id"], shard) for r in part)
            assert all(r["row"] == 1 and r["id"] == 2 for r in part)
        assert slots == list(range(len(slots)))
    assert found == placed and sum(found.values()) == len(rows)


def test_placing_writes_the_documents(docs, rows, monkeypatch):
    """The second pass writes whole documents, shard by shard, in the order of their slots."""
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 20_000)
    placed = sharding.place(docs, 3)
    parts = sorted(f.removeprefix("file://").removeprefix("file:") for f in placed.inputFiles())
    found, slots = Counter(), defaultdict(list)
    for part in parts:
        shard = int(part.split("shard=")[1].split("/")[0])
        for r in pq.ParquetFile(part).read().to_pylist():
            found[r["doc_id"], r["text"], shard] += 1
            slots[shard].append(r["slot"])
    assert all(s == list(range(len(s))) for s in slots.values())
    assert Counter((i, t) for i, t, _ in found.elements()) == Counter((r[0], r[1]) for r in rows)
    assert Counter((i, s) for i, _, s in found.elements()) == Counter((r["doc_id"], r["shard"]) for r in placed.collect())
