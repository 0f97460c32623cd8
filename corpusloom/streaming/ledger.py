"""What a sink's batches hold, written beside it, and whether a checkpoint still fits them.

Every batch that is written gets a manifest: its number, its rows and its files with
their sizes.  Before a stream goes on, the checkpoint's offsets and commits, the
manifests and the folders of the sink must tell the same story; only the last batch may
be unfinished, since the stream runs it again.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEDGER = "ledger"  # folder beside the sink


class UnsafeResume(RuntimeError):
    """Sink and checkpoint do not fit: appending could duplicate or lose rows."""


def ledger_path(sink: str) -> str:
    return f"{sink}-{LEDGER}"


class Files:
    """The few operations on small files and listings that the ledger needs, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self._path(path)))

    def names(self, path: str) -> dict[str, int]:
        """Name and size of what a folder holds, without hidden files; empty for a folder that is not there."""
        if not self.exists(path):
            return {}
        found = {s.getPath().getName(): int(s.getLen()) for s in self.fs.listStatus(self._path(path))}
        return {n: size for n, size in found.items() if not n.startswith((".", "_"))}

    def read(self, path: str) -> str:
        """Text of a small file; empty where the file system finds it damaged."""
        stream = self.fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8", "replace")
        except Py4JJavaError as error:
            if "ChecksumException" not in error.java_exception.getClass().getName():
                raise
            return ""
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Replace a small file as a whole: written aside, then renamed."""
        aside = self._path(path + ".writing")
        stream = self.fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.fs.delete(self._path(path), False)
        if not self.fs.rename(aside, self._path(path)):
            raise OSError(f"cannot rename {path}.writing")


def record_batch(spark: SparkSession, sink: str, batch_id: int, rows: int, rejected: int) -> None:
    """Write the manifest of a batch whose folder is complete."""
    files = Files(spark, sink)
    manifest = {"batch": batch_id, "rows": rows, "rejected": rejected, "files": files.names(f"{sink}/batch={batch_id}")}
    files.write(f"{ledger_path(sink)}/{batch_id}", json.dumps(manifest))


def _numbered(names: dict[str, int]) -> set[int]:
    return {int(n) for n in names if n.isdigit()}


def _readable(text: str, lines: int) -> bool:
    """A log entry of the stream: a version line, then ``lines`` lines of JSON at least."""
    version, *rest = text.split("\n")
    try:
        return version.startswith("v") and len(rest) >= lines and all(isinstance(json.loads(x), (dict, int)) for x in rest if x != "-")
    except ValueError:
        return False


def check_resume(spark: SparkSession, sink: str, checkpoint: str) -> None:
    """Raise ``UnsafeResume`` with the reason unless a stream may go on appending to ``sink``."""
    files = Files(spark, sink)

    def refuse(reason: str) -> None:
        raise UnsafeResume(f"{sink} cannot be appended to with {checkpoint}: {reason}; remove both to start fresh")

    folders = {int(n.removeprefix("batch=")) for n in files.names(sink) if n.removeprefix("batch=").isdigit()}
    offsets, commits = (_numbered(files.names(f"{checkpoint}/{part}")) for part in ("offsets", "commits"))
    manifests = _numbered(files.names(ledger_path(sink)))
    if not offsets:
        if files.exists(sink) or manifests:
            refuse("the checkpoint holds no offsets")
        if commits:
            refuse("the checkpoint has commits without offsets")
        return
    last = max(offsets)
    # The stream removes its oldest entries; what is left must have no gaps.
    missing = set(range(min(offsets), last + 1)) - offsets
    if missing:
        refuse(f"offsets of batch {min(missing)} are missing")
    for batch in sorted(offsets):
        if not _readable(files.read(f"{checkpoint}/offsets/{batch}"), 2):
            refuse(f"offsets of batch {batch} are damaged")
    if commits - offsets:
        refuse(f"batch {min(commits - offsets)} is committed but has no offsets")
    open_ = offsets - commits - {last}
    if commits:
        open_ = {b for b in open_ if b >= min(commits)}
    if open_:
        refuse(f"batch {min(open_)} is not committed but later ones are")
    if commits - manifests:
        refuse(f"batch {min(commits - manifests)} is committed but has no manifest")
    if manifests and max(manifests) > last:
        refuse(f"the sink holds batch {max(manifests)}, the checkpoint ends with {last}")
    unfinished = set() if last in commits else {last}
    if folders - manifests - unfinished:
        refuse(f"the folder of batch {min(folders - manifests - unfinished)} has no manifest")
    if manifests - folders - unfinished:
        refuse(f"the folder of batch {min(manifests - folders - unfinished)} is gone")
    for batch in sorted((manifests & offsets) - unfinished):
        try:
            written = json.loads(files.read(f"{ledger_path(sink)}/{batch}"))["files"]
        except (ValueError, KeyError):
            refuse(f"the manifest of batch {batch} is damaged")
        if written != files.names(f"{sink}/batch={batch}"):
            refuse(f"the files of batch {batch} are not those that were written")
