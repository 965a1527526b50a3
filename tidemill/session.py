"""Sessions."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC and ANSI fix results; AQE re-plans joins and splits skew at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults. conf: further settings, with _ for dots (memory, cores, catalogs, s3a)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **{k.replace("_", "."): str(v) for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()
