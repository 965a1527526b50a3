"""A versioned table: Parquet data in a directory for each append, and a log of snapshots that are committed by one rename.

Each snapshot names the directories that make up the table, its parent and its operation, so reading as of a snapshot is reading its
directories, and what was added between two snapshots is the difference of their lists. Paths go through Hadoop's file system, so any store that Spark
reads will do.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one (spark.checkpoint.dir). Where none is set, a local one serves a local master only."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_tidemill_scratch", None)
    if not root:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^,\]]*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark._tidemill_scratch = tempfile.mkdtemp(prefix="tidemill-")
    return f"{root}/tidemill/{name}-{uuid.uuid4().hex}"


class Files:
    """The few file operations that the log needs, on Hadoop's file system."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.jvm, self.path = jvm, jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def commit(self, path: str, text: str) -> bool:
        """Writes path as a whole, if no other writer has; False if one has. On local disks a link decides, on distributed file systems their
        rename, which never replaces a file; a plain object store needs a log store that offers as much."""
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        self._put(tmp, text)
        if self.fs.getScheme() == "file":
            here, there = (self.path(p).toUri().getPath() for p in (tmp, path))
            try:
                os.link(here, there)
                return True
            except FileExistsError:
                return False
            finally:
                self.fs.delete(self.path(tmp), False)
        done = not self.exists(path) and self.fs.rename(self.path(tmp), self.path(path))
        if not done:
            self.fs.delete(self.path(tmp), False)
        return done

    def replace(self, path: str, text: str) -> None:
        """Writes path as a whole, in place of what stands there."""
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        self._put(tmp, text)
        if self.fs.getScheme() == "file":
            os.replace(*(self.path(p).toUri().getPath() for p in (tmp, path)))
            return
        self.fs.delete(self.path(path), False)
        if not self.fs.rename(self.path(tmp), self.path(path)):
            raise OSError(f"{path} couldn't be replaced")


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, Files(spark, root)

    def exists(self) -> bool:
        return bool(self.snapshots())

    def snapshots(self) -> list[dict]:
        """All snapshots, oldest first: snapshot_id, parent_id, sequence, parent_sequence, timestamp_ms, operation, summary, data."""
        names = [n for n in self.files.names(f"{self.root}/log") if n.endswith(".json") and not n.startswith(".")]
        return [json.loads(self.files.read(f"{self.root}/log/{n}")) for n in names]

    def current(self) -> dict | None:
        found = self.snapshots()
        return found[-1] if found else None

    def _commit(self, df: DataFrame, operation: str) -> dict:
        data = f"{self.root}/data/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(data)  # counted while it is written
        rows = seen.get["rows"]
        for _ in range(20):
            last = self.current()
            n = last["sequence"] + 1 if last else 1
            kept = last["data"] if last and operation == "append" else []
            snapshot = {
                "snapshot_id": uuid.uuid4().hex, "parent_id": last and last["snapshot_id"], "sequence": n, "parent_sequence": last and last["sequence"],
                "timestamp_ms": int(time.time() * 1000), "operation": operation, "summary": {"added_rows": rows}, "data": [*kept, data],
            }
            if self.files.commit(f"{self.root}/log/{n:012d}.json", json.dumps(snapshot)):
                return snapshot
        raise RuntimeError(f"other writers kept committing to {self.root}")

    def append(self, df: DataFrame) -> dict:
        return self._commit(df, "append")

    def overwrite(self, df: DataFrame) -> dict:
        return self._commit(df, "overwrite")

    def _at(self, snapshot_id: str | None) -> dict | None:
        if snapshot_id is None:
            return self.current()
        for s in self.snapshots():
            if s["snapshot_id"] == snapshot_id:
                return s
        raise ValueError(f"no such snapshot: {snapshot_id}")

    def _read(self, paths: list[str], like: list[str]) -> DataFrame:
        if paths:
            return self.spark.read.option("mergeSchema", "true").parquet(*paths)
        if not like:
            raise ValueError(f"{self.root} has no snapshots")
        return self.spark.read.parquet(*like).limit(0)

    def read(self, snapshot_id: str | None = None) -> DataFrame:
        s = self._at(snapshot_id)
        return self._read(s["data"] if s else [], [])

    def appends(self, start: str | None = None, end: str | None = None) -> list[dict]:
        """The append snapshots after start up to end (default: now), oldest first."""
        after = self._at(start)["sequence"] if start else 0
        to = self._at(end)
        return [s for s in self.snapshots() if s["operation"] == "append" and after < s["sequence"] <= (to["sequence"] if to else 0)]

    def diff(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """What was appended after start up to end (default: now); from None, everything that the table has at end. Rows of an overwrite aren't appended."""
        to = self._at(end)
        data = (to["data"] if to else []) if start is None else [s["data"][-1] for s in self.appends(start, end)]
        return self._read(data, to["data"] if to else [])

    def added_rows(self, start: str | None = None, end: str | None = None) -> int:
        """How many rows were appended after start up to end, by the log alone."""
        return sum(s["summary"]["added_rows"] for s in self.appends(start, end))
