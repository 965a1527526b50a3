"""Runs stages in order: retry with backoff, a time limit that cancels Spark's jobs, resume after failure, and a manifest in the run's folder."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from tidemill.sources import files
from tidemill.sources.snapshots import Files


class StageError(RuntimeError):
    def __init__(self, stage: str, batch_id: str, attempt: int, cause: BaseException):
        super().__init__(f"stage {stage} of {batch_id} failed at attempt {attempt}: {str(cause)[:500]}")
        self.stage, self.batch_id, self.attempt = stage, batch_id, attempt


@dataclass(frozen=True)
class Stage:
    """run takes (spark, outputs of earlier stages) and returns this stage's tables. inputs: (stage, table) it reads, for the lineage."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]
    inputs: tuple[str, ...] = ()


@dataclass
class Runner:
    spark: SparkSession
    root: str
    stages: list[Stage]
    config: dict = field(default_factory=dict)
    attempts: int = 3
    base_s: float = 1.0
    max_s: float = 30.0
    limit_s: float | None = None
    always: tuple[str, ...] = ()  # stages that a resumed run never skips

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.config, sort_keys=True).encode()).hexdigest()

    def manifest(self, batch_id: str) -> dict | None:
        """The newest manifest of a batch."""
        f = Files(self.spark, self.root)
        names = [n for n in f.names(f"{self.root}/{batch_id}/manifest") if n.endswith(".json") and not n.startswith(".")]
        return json.loads(f.read(f"{self.root}/{batch_id}/manifest/{names[-1]}")) if names else None

    def _save(self, m: dict) -> None:
        m["revision"] += 1
        if not Files(self.spark, self.root).commit(f"{self.root}/{m['batch_id']}/manifest/{m['revision']:06d}.json", json.dumps(m)):
            raise RuntimeError(f"another run is writing {m['batch_id']}")

    def _once(self, stage: Stage, folder: str, tables: dict[str, DataFrame]) -> dict[str, dict]:
        group = f"tidemill-{folder}"
        sc = self.spark.sparkContext
        got, failed = {}, []

        def work() -> None:
            try:
                sc.setJobGroup(group, stage.name, interruptOnCancel=True)
                for name, df in stage.run(self.spark, tables).items():
                    path = f"{folder}/{name}"
                    got[name] = {"path": path, "rows": files.write(df, path), "columns": df.columns}
            except Exception as e:  # handed to the caller's thread
                failed.append(e)

        t = InheritableThread(target=work, daemon=True)
        t.start()
        t.join(self.limit_s)
        if t.is_alive():
            sc.cancelJobGroup(group)
            t.join(10)
            raise TimeoutError(f"{stage.name} took over {self.limit_s} s")
        if failed:
            raise failed[0]
        return got

    def run(self, batch_id: str, fail_at: str | None = None) -> dict:
        """The manifest of a finished run. A failed batch of the same configuration goes on after its last good stage."""
        m = self.manifest(batch_id)
        if not (m and m["status"] == "failed" and m["config"] == self.digest()):
            m = {"batch_id": batch_id, "config": self.digest(), "stages": {}, "revision": m["revision"] if m else 0}
        m["status"], fresh = "running", False
        tables: dict[str, DataFrame] = {}
        for stage in self.stages:
            done = m["stages"].get(stage.name)
            if done and not fresh and stage.name not in self.always and all(files.exists(self.spark, f"{t['path']}/_SUCCESS") for t in done["tables"].values()):
                done["skipped"] = True
            else:
                fresh = True
                for attempt in range(1, self.attempts + 1):
                    began = time.time()
                    try:
                        if fail_at == stage.name:
                            raise RuntimeError("failure asked for")
                        # Each attempt has a folder of its own: what a late task of an earlier one writes is never read.
                        made = self._once(stage, f"{self.root}/{batch_id}/{stage.name}/r{m['revision']}a{attempt}", tables)
                        m["stages"][stage.name] = {"tables": made, "attempt": attempt, "seconds": round(time.time() - began, 3), "inputs": list(stage.inputs)}
                        break
                    except Exception as e:
                        if attempt == self.attempts or fail_at == stage.name:
                            m["status"], m["error"] = "failed", f"{stage.name}: {str(e)[:500]}"
                            self._save(m)
                            raise StageError(stage.name, batch_id, attempt, e) from e
                        time.sleep(min(self.base_s * 2 ** (attempt - 1), self.max_s))
            for name, t in m["stages"][stage.name]["tables"].items():
                tables[f"{stage.name}.{name}"] = self.spark.read.parquet(t["path"])
        m["status"] = "success"
        m.pop("error", None)
        self._save(m)
        return m


def lineage(manifest: dict) -> list[tuple[str, str]]:
    """Edges from each input to each table of a stage, of tables that the run has made."""
    made = {f"{s}.{t}" for s, x in manifest["stages"].items() for t in x["tables"]}
    return [(i, f"{s}.{t}") for s, x in manifest["stages"].items() for i in x["inputs"] if i in made for t in x["tables"]]
