"""Over the batches of a root: statistics, alerts, health and retention, all read from the batches' own files."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.parsing import percent
from tidemill.sources.snapshots import Files

METRICS = "batch string, status string, mode string, seconds double, finished_ms bigint, error string, dq_score double, quarantined map<string,bigint>, quarantined_rows bigint, memory_mb double, stages array<struct<stage:string,status:string,seconds:double,rows_out:bigint>>"


def batches(spark: SparkSession, root: str) -> DataFrame:
    """One row for each batch that has metrics."""
    f = Files(spark, root)
    paths = [p for n in f.names(root) if n.startswith("B-") and f.exists(p := f"{root}/{n}/metrics.json")]
    return spark.read.schema(METRICS).json(paths, multiLine=True) if paths else spark.createDataFrame([], METRICS)


def statistics(found: DataFrame) -> DataFrame:
    """One row: batches in all and by status, and the average, lowest and highest quality in percent."""
    score = percent(F.col("dq_score"))
    n = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(s)
    average = F.floor(F.avg(score) * 10000 + 0.5) / 10000
    return found.agg(F.count("*").alias("total"), n("success"), n("failed"), average.alias("avg_dq"), F.min(score).alias("min_dq"), F.max(score).alias("max_dq"))


def alerts(found: DataFrame, min_score: float = 0.95, max_s: float = 300.0, max_mb: float | None = None) -> DataFrame:
    """batch and its alerts (joined by ;), for the batches that have any."""
    reasons = {"dq_score": percent(F.col("dq_score")) < min_score * 100, "duration": F.col("seconds") > max_s, "status": F.col("status") == "failed"}
    if max_mb is not None:
        reasons["memory"] = F.col("memory_mb") > max_mb
    hit = [F.when(mask, F.lit(name)) for name, mask in reasons.items()]
    return found.select("batch", F.concat_ws(";", *hit).alias("alert")).where("alert != ''")


def failure_rate(found: DataFrame, last: int = 10) -> float:
    """The share of failed ones among the newest batches."""
    newest = [r["status"] for r in found.orderBy(F.desc("finished_ms"), F.desc("batch")).limit(last).select("status").collect()]
    return sum(s == "failed" for s in newest) / len(newest) if newest else 0.0


def health(spark: SparkSession, root: str, last: int = 10, most: float = 0.5) -> dict:
    found = batches(spark, root)
    newest = [r.asDict() for r in found.orderBy(F.desc("finished_ms"), F.desc("batch")).limit(last).select("batch", "status", "dq_score", "seconds").collect()]
    bad = bool(newest) and (newest[0]["status"] == "failed" or failure_rate(found, last) > most)
    return {"status": "degraded" if bad else "ok", "batches": newest}


def serve(spark: SparkSession, root: str, port: int = 0) -> ThreadingHTTPServer:
    """GET /health on a thread of its own; shutdown() ends it."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            found = health(spark, root) if self.path == "/health" else None
            body = json.dumps(found or {"error": "no such page"}).encode()
            self.send_response(404 if found is None else 200 if found["status"] == "ok" else 503)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server


def expired(spark: SparkSession, root: str, keep: int, delete: bool = False) -> list[str]:
    """Batches beyond the newest keep, oldest first; never the one that latest names. They go only if delete is set."""
    f = Files(spark, root)
    latest = f.read(f"{root}/latest").strip() if f.exists(f"{root}/latest") else ""
    found = sorted(n for n in f.names(root) if n.startswith("B-"))
    gone = [n for n in found[: max(0, len(found) - keep)] if n != latest]
    for n in gone if delete else []:
        f.fs.delete(f.path(f"{root}/{n}"), True)
    return gone
