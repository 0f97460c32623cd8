"""Sinks and checkpoints that do not fit each other are refused, with the reason."""

import json
import os
import shutil

import pytest

from corpusloom import schemas
from corpusloom.streaming.ingest import ingest
from corpusloom.streaming.ledger import UnsafeResume, check_resume


@pytest.fixture(scope="module")
def three_batches(spark, tmp_path_factory):
    """A source delivered and ingested three times."""
    folder = tmp_path_factory.mktemp("ingest")
    source, sink, state = (str(folder / n) for n in ("in", "sink", "state"))
    for ids in ([1, 2], [2, 3], [3, 4, 4]):
        spark.createDataFrame([(i, "t", f"x{i}", "u") for i in ids], schemas.ARTICLE).coalesce(1).write.mode("append").json(source)
        ingest(spark, source, sink, state, schemas.ARTICLE, "id").awaitTermination()
    return folder


@pytest.fixture
def copy(three_batches, tmp_path):
    target = tmp_path / "copy"
    shutil.copytree(three_batches, target)
    return target


def refused(spark, folder):
    with pytest.raises(UnsafeResume) as error:
        ingest(spark, str(folder / "in"), str(folder / "sink"), str(folder / "state"), schemas.ARTICLE, "id")
    return str(error.value)


def test_a_sound_checkpoint_goes_on(spark, copy):
    check_resume(spark, str(copy / "sink"), str(copy / "state"))
    assert sorted(r["id"] for r in spark.read.parquet(str(copy / "sink")).collect()) == [1, 2, 3, 4]
    manifests = [json.loads((copy / "sink-ledger" / str(n)).read_text()) for n in range(3)]
    assert [(m["batch"], m["rows"], m["rejected"]) for m in manifests] == [(0, 2, 0), (1, 1, 0), (2, 1, 0)]


def test_nothing_there_yet(spark, tmp_path):
    check_resume(spark, str(tmp_path / "sink"), str(tmp_path / "state"))


@pytest.mark.parametrize("text", ["", "v1\n", 'v1\n{"batchWatermarkMs":0', "v1\n{}\n", "garbage\n{}\n{}"])
def test_truncated_offsets(spark, copy, text):
    (copy / "state" / "offsets" / "2").write_text(text)
    assert "offsets of batch 2 are damaged" in refused(spark, copy)


def test_missing_offsets(spark, copy):
    os.remove(copy / "state" / "offsets" / "1")
    assert "offsets of batch 1 are missing" in refused(spark, copy)


def test_lost_checkpoint(spark, copy):
    shutil.rmtree(copy / "state")
    assert "holds no offsets" in refused(spark, copy)


def test_missing_commit(spark, copy):
    os.remove(copy / "state" / "commits" / "1")
    assert "batch 1 is not committed but later ones are" in refused(spark, copy)


def test_commit_without_offsets(spark, copy):
    os.remove(copy / "state" / "offsets" / "2")
    assert "batch 2 is committed but has no offsets" in refused(spark, copy)


def test_commit_without_manifest(spark, copy):
    os.remove(copy / "sink-ledger" / "2")
    assert "batch 2 is committed but has no manifest" in refused(spark, copy)


def test_damaged_manifest(spark, copy):
    (copy / "sink-ledger" / "1").write_text('{"batch": 1, "ro')
    assert "manifest of batch 1 is damaged" in refused(spark, copy)


def test_orphan_folder(spark, copy):
    shutil.copytree(copy / "sink" / "batch=1", copy / "sink" / "batch=7")
    assert "the folder of batch 7 has no manifest" in refused(spark, copy)


def test_lost_folder(spark, copy):
    shutil.rmtree(copy / "sink" / "batch=1")
    assert "the folder of batch 1 is gone" in refused(spark, copy)


def test_half_of_a_folder(spark, copy):
    part = next((copy / "sink" / "batch=0").glob("part-*"))
    os.remove(part)
    assert "the files of batch 0 are not those that were written" in refused(spark, copy)


def test_checkpoint_older_than_the_sink(spark, copy):
    for part in ("offsets", "commits"):
        os.remove(copy / "state" / part / "2")
    assert "the sink holds batch 2, the checkpoint ends with 1" in refused(spark, copy)


@pytest.mark.parametrize("left", ["folder and manifest", "folder", "nothing"])
def test_the_last_batch_runs_again(spark, copy, left):
    """A run that ended between its first file and its commit."""
    os.remove(copy / "state" / "commits" / "2")
    crc = copy / "state" / "commits" / ".2.crc"
    if crc.exists():
        os.remove(crc)
    if left != "folder and manifest":
        os.remove(copy / "sink-ledger" / "2")
    if left == "nothing":
        shutil.rmtree(copy / "sink" / "batch=2")
    source = (copy / "state" / "sources").exists()
    assert source
    check_resume(spark, str(copy / "sink"), str(copy / "state"))
