"""CSV read by ranges against the csv module and the engine's own reader, with borders everywhere."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import csv_ranges as cr
from corpusloom.sources import readers


@pytest.fixture
def small_ranges(spark):
    """Splits of so many bytes, down to one."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def as_csv(rows, header=("id", "text"), end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=quoting).writerows([header, *rows])
    return out.getvalue()


def read(spark, path):
    return sorted(tuple("" if x is None else x for x in r) for r in cr.read_csv_ranges(spark, path).collect())


HARD = [("1", "plain"), ("2", "two\nlines"), ("3", 'a "quote"'), ("4", '"'), ("5", '""\n""'), ("6", "comma, and\nbreak,\n,"), ("7", ""),
        ("8", "\n\n\n"), ("9", 'ends with "'), ("10", '"begins'), ("11", "a\r\nb"), ("12", 'x,"y",z'), ("13", "é ü 文\n字"), ("14", '",'), ("15", ',"')]


@pytest.mark.parametrize("size", [48, 1 << 20])
def test_borders_everywhere(spark, tmp_path, small_ranges, size):
    path = write(tmp_path / "a.csv", as_csv(HARD))
    small_ranges(size)
    assert read(spark, path) == sorted(HARD)


@pytest.mark.parametrize("end, mark, quoting", [("\n", "﻿", csv.QUOTE_ALL), ("\r\n", "", csv.QUOTE_MINIMAL), ("\r\n", "﻿", csv.QUOTE_ALL)])
def test_forms_of_files(spark, tmp_path, small_ranges, end, mark, quoting):
    path = write(tmp_path / "a.csv", mark + as_csv(HARD, end=end, quoting=quoting))
    small_ranges(90)
    assert read(spark, path) == sorted(HARD)


def test_random_cells(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    for turn in range(2):
        rows = [(str(i), "".join(rng.choice('ab",\n"') for _ in range(rng.randrange(12)))) for i in range(15)]
        path = write(tmp_path / f"{turn}.csv", as_csv(rows))
        small_ranges([25, 90][turn])
        assert read(spark, path) == sorted(rows)


@pytest.mark.parametrize("text, rows", [
    ("", []), ("id,text", []), ("id,text\n", []), ('\n\nid,text\n\n1,a\n\r\n2,"b\n\nc"\n\n', [("1", "a"), ("2", "b\n\nc")]),
    ('id,text\n1,5" pipe\n2,a "b" c\n3,"x"\n', [("1", '5" pipe'), ("2", 'a "b" c'), ("3", "x")]),
    ('"id","te\nxt"\n1,a\n', [("1", "a")]), ('id,text\n1,"never closed\nto the end', None), ("id,text\n1\n2,a,b\n", [("1", ""), ("2", "a")]),
])
@pytest.mark.parametrize("size", [30])
def test_odd_files(spark, tmp_path, small_ranges, text, rows, size):
    path = write(tmp_path / "a.csv", text)
    small_ranges(size)
    got = read(spark, path)
    if rows is None:
        assert len(got) == 1 and got[0][0] == "1"
    else:
        assert got == rows
    names = {"": [], '"id","te\nxt"\n1,a\n': ["id", "te\nxt"]}.get(text, ["id", "text"])
    assert cr.read_csv_ranges(spark, path).columns == names


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    rows = [("1", "line\n" * 60), ("2", "b"), ("3", '"\n' * 40), ("4", "c" * 300)]
    path = write(tmp_path / "a.csv", as_csv(rows))
    small_ranges(120)
    assert read(spark, path) == sorted(rows)


def test_every_border_between_lines(spark):
    """Walks from any line on, from either state, agree with the walk over all lines."""
    lines = as_csv(HARD).split("\n")[:-1]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", cr.line_map(F.col("line"), ",").alias("code"))
    codes = [r["code"] for r in sorted(rows.collect())]
    states, whole, records = [], cr.Walk(cr.OUTSIDE), []
    for line, code in zip(lines, codes):
        states.append(whole.state)
        records.append(whole.feed(line, code))
    assert [next(csv.reader(io.StringIO("\n".join(r), newline=""))) for r in records if r][1:] == [[a, b] for a, b in HARD]
    for border in range(len(lines) + 1):
        left, right = cr.Walk(cr.OUTSIDE), cr.Walk(states[border] if border < len(lines) else whole.state)
        found = [left.feed(*x) for x in zip(lines[:border], codes[:border])]
        rest = [right.feed(*x) for x in zip(lines[border:], codes[border:])]
        crossing = [left.open + right.head] if right.head is not None else []
        assert [r for r in found + crossing + rest if r] == [r for r in records if r] or left.open == []
        assert left.state == (states[border] if border < len(lines) else whole.state)


def test_several_files(spark, tmp_path, small_ranges):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(4):
        write(folder / f"{k}.csv", as_csv([(f"{k}{i}", t) for i, t in HARD]))
    write(folder / "empty.csv", "")
    small_ranges(400)
    assert read(spark, str(folder)) == sorted((f"{k}{i}", t) for k in range(4) for i, t in HARD)
    write(folder / "other.csv", "text,id\na,1\n")
    with pytest.raises(ValueError, match="different headers"):
        cr.read_csv_ranges(spark, str(folder))


def test_as_many_tasks_as_ranges(spark, tmp_path, small_ranges):
    rows = [(str(i), f"text, of\n{i}") for i in range(2_000)]
    path = write(tmp_path / "a.csv", as_csv(rows))
    small_ranges(2_000)
    df = readers.read_csv(spark, path, {"id": None, "text": "", "other": "none"})
    assert sorted((r["id"], r["text"], r["other"]) for r in df.collect()) == sorted((a, b, "none") for a, b in rows)
    lines = cr._lines(spark, path, ",")
    assert lines.rdd.getNumPartitions() > 15
    whole = cr._inside(lines, cr._resolved(cr._summaries(lines)))
    assert whole.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 15


def test_equal_to_the_engines_reader(spark, tmp_path, small_ranges):
    path = write(tmp_path / "a.csv", as_csv(HARD * 3))
    wanted = {"id": None, "text": None}
    native = readers.read_csv(spark, path, wanted).collect()
    small_ranges(40)
    assert sorted(map(str, readers.read_csv(spark, path, wanted).collect())) == sorted(map(str, native))


@pytest.mark.parametrize("state", [cr.OUTSIDE, cr.INSIDE])
def test_lines_in_runs_are_fed_as_one_after_the_other(spark, state):
    """Runs of lines that keep the state need no step per line, and doubled quotes no fold."""
    rng = random.Random(11)
    lines = ["".join(rng.choice(['"', '""', '""""', "a", ",", "x,", "\r", ""]) for _ in range(rng.randint(0, 5))) for _ in range(4_000)]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, v string").select("i", cr.line_map(F.col("v"), ",").alias("c"))
    codes = np.array([c for _, c in sorted(map(tuple, rows.collect()))], dtype=np.int8)
    single, runs = cr.Walk(state), cr.Walk(state)
    expected = ["\n".join(r) for line, code in zip(lines, codes.tolist()) if (r := single.feed(line, code)) is not None]
    got = [r for a in range(0, len(lines), 700) for r in runs.feed_all(lines[a:a + 700], codes[a:a + 700])]
    assert got == expected and len(got) > 100
    assert (runs.state, runs.head, runs.open) == (single.state, single.head, single.open)
