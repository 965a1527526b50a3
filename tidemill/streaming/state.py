"""Incremental state: typed watermarks, a ledger of merged batches, and aggregates by version, all committed by one new log entry.

A batch writes its merged aggregates to folders of its own; then one entry names them with the new watermarks and the batch's id. A crash
before the entry leaves the old state, a crash after it the new one, and a batch that is in the ledger is never merged twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.aggregates import AggSpec, merge
from tidemill.sources.snapshots import Files

LEDGER = 200  # batches the ledger remembers
EMPTY = {"version": 0, "watermarks": {}, "snapshots": {}, "ledger": [], "aggregates": {}}


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, Files(spark, root)

    def load(self) -> dict:
        """The newest state; EMPTY before the first batch. A damaged entry is an error, never a fresh start."""
        names = [n for n in self.files.names(f"{self.root}/state") if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return json.loads(json.dumps(EMPTY))
        path = f"{self.root}/state/{names[-1]}"
        try:
            found = json.loads(self.files.read(path))
            return {k: found[k] for k in EMPTY}
        except (ValueError, KeyError, TypeError) as e:
            raise RuntimeError(f"state is damaged: {path}; restore it, or delete it to go back to the entry before") from e

    def merged(self, batch_id: str) -> bool:
        return batch_id in self.load()["ledger"]

    def aggregate(self, name: str) -> DataFrame | None:
        path = self.load()["aggregates"].get(name)
        return self.spark.read.parquet(path) if path else None

    def commit(self, batch_id: str, deltas: dict[str, tuple[DataFrame, AggSpec]], watermarks: dict[str, str] | None = None, snapshots: dict[str, str] | None = None) -> bool:
        """Merges a batch's aggregates into the state; False if the batch was merged before."""
        old = self.load()
        if batch_id in old["ledger"]:
            return False
        paths = {}
        for name, (delta, spec) in deltas.items():
            before = old["aggregates"].get(name)
            new = merge(self.spark.read.parquet(before), delta, spec) if before else delta
            paths[name] = f"{self.root}/aggregates/{name}/{uuid.uuid4().hex}"
            new.write.parquet(paths[name])
        version = old["version"] + 1
        entry = {
            "version": version, "watermarks": old["watermarks"] | (watermarks or {}), "snapshots": old["snapshots"] | (snapshots or {}),
            "ledger": [*old["ledger"], batch_id][-LEDGER:], "aggregates": old["aggregates"] | paths,
        }
        if not self.files.commit(f"{self.root}/state/{version:012d}.json", json.dumps(entry)):
            raise RuntimeError(f"another batch committed version {version} of {self.root} first; run {batch_id} again")
        return True


def delta(df: DataFrame, column: str, watermark: str | None) -> DataFrame:
    """Rows after the watermark (all, if there is none). The bound is cast to the column's type, so it reaches the scan."""
    if watermark is None:
        return df
    return df.where(F.col(column) > F.lit(watermark).cast(df.schema[column].dataType))


def highest(df: DataFrame, column: str, watermark: str | None = None) -> str | None:
    """The new watermark; without new rows the old one stays."""
    found = df.agg(F.max(column).cast("string").alias("w")).first()["w"]
    return watermark if found is None else found
