"""Run events (START, COMPLETE, FAIL) as JSON lines files, one for each event; what can't be written never stops a run."""

from __future__ import annotations

import json
import logging
import resource
import uuid
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tidemill.sources.snapshots import Files

LOG = logging.getLogger("tidemill")
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "tidemill")


def memory_mb() -> float | None:
    """The most memory that the driver's Python has taken so far."""
    try:
        return round(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, 1)
    except (OSError, ValueError):
        return None


class JsonLines(logging.Formatter):
    """Log records as JSON lines, with batch and stage where the record has them."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "message": record.getMessage()}
        out |= {k: getattr(record, k) for k in ("batch", "stage") if hasattr(record, k)}
        return json.dumps(out, ensure_ascii=False)


def logging_to(stream, level: str = "INFO", as_json: bool = False) -> logging.Handler:
    """Adds a handler to the package's log; an unknown level is an error."""
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonLines() if as_json else logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    LOG.setLevel(level.upper())
    LOG.addHandler(handler)
    return handler


class Emitter:
    def __init__(self, spark: SparkSession, folder: str, batch: str):
        self.files, self.folder, self.batch, self.n = Files(spark, folder), folder, batch, 0

    def __call__(self, kind: str, job: str, inputs: list[str] = (), outputs: list[str] = (), error: BaseException | None = None) -> None:
        """One event. The run's id follows from batch and job, so a repeated run has the same."""
        event = {
            "eventType": kind, "eventTime": datetime.now(UTC).isoformat(), "run": {"runId": str(uuid.uuid5(SPACE, f"{self.batch}/{job}"))}, "job": {"namespace": "tidemill", "name": job},
            "inputs": [{"namespace": "tidemill", "name": n} for n in inputs], "outputs": [{"namespace": "tidemill", "name": n} for n in outputs],
        }
        if error is not None:
            event["run"]["facets"] = {"errorMessage": {"message": str(error)[:500]}}
        self.n += 1
        try:
            self.files.replace(f"{self.folder}/{datetime.now(UTC):%Y%m%d%H%M%S%f}-{self.n:04d}.json", json.dumps(event) + "\n")
        except Exception as e:  # events are never worth a run
            LOG.warning("event %s of %s wasn't written: %s", kind, job, e, extra={"batch": self.batch, "stage": job})
