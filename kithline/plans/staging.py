"""Written intermediates in the shared folder of the cluster.

A staged table cuts the lineage, survives the loss of any executor, gives Catalyst true sizes, and is read back
column by column. Its row count is observed while it is written, so no second pass is needed for it.
"""

from __future__ import annotations

import copy
import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Row groups of staged tables: a writer holds one in memory.
ROW_GROUP_BYTES = 32 << 20


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    rows: int


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder stands in only for a local session that has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="kithline-")


def inputs_key(frames: Mapping[str, DataFrame], *settings: object) -> str:
    """A key of what a run's results follow from: the settings, and the files behind its inputs with their sizes and times.

    Frames that read no files are told apart by their plans."""
    digest = hashlib.sha256(repr(settings).encode("utf-8"))
    for name, df in sorted(frames.items()):
        files = sorted(df.inputFiles())
        digest.update(f"{name} {df.schema.json()} {df.semanticHash() if not files else ''}".encode("utf-8"))
        spark = df.sparkSession
        for file in files:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
            digest.update(f"{file} {status.getLen()} {status.getModificationTime()}".encode("utf-8"))
    return digest.hexdigest()[:32]


_OPENED: list[list[Staging]] = []


@contextmanager
def released() -> Iterator[None]:
    """Deletes, at its end, the tables of every ``Staging`` that was opened within it."""
    _OPENED.append([])
    try:
        yield
    finally:
        for staging in _OPENED.pop():
            staging.release()


class Staging:
    """One folder per run below the shared folder; ``put`` writes a table there and reads it back.

    With a ``key`` the folder is that key's: a run that was ended is taken up by the next one with the same key, which
    reads the tables that were finished, by their success marks, and writes only the others. The order of a run's tables
    must follow from what the key stands for."""

    def __init__(self, spark: SparkSession, folder: str | None = None, key: str | None = None):
        self.spark, self._resumes = spark, key is not None
        self.folder = os.path.join(folder or shared_folder(spark), f"linkage-{key or uuid.uuid4().hex}")
        self.reused: list[str] = []
        for opened in _OPENED[-1:]:
            opened.append(self)
        self._tables = 0

    def _finished(self, path: str) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def part(self, name: str) -> Staging:
        """A folder below this one, for the tables of a result that is made when it is first asked for: their numbers, by
        which a resumed run finds them, do not hang on what else was asked for before."""
        part = copy.copy(self)
        part.folder, part._tables = os.path.join(self.folder, name), 0
        return part

    def release(self) -> None:
        """Deletes the folder, wherever the session's file systems have it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def put(self, df: DataFrame, name: str) -> Staged:
        self._tables += 1
        path = os.path.join(self.folder, f"{self._tables:03d}-{name}")
        if self._resumes and self._finished(path):
            self.reused.append(name)
            table = self.spark.read.schema(df.schema).parquet(path)
            return Staged(table, table.count())  # from the files' footers
        count = Observation()
        mode = "overwrite" if self._resumes else "errorifexists"  # what a lost run left half-written goes
        df.observe(count, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return Staged(self.spark.read.schema(df.schema).parquet(path), int(count.get["rows"]))
