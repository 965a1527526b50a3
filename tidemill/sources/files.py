"""CSV and Parquet sources and sinks. Raw columns are strings: parsing is the rules' and cleaning's work, and a bad value must never fail a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.parsing import all_strings
from tidemill.sources.snapshots import Files

FORMATS = ("csv", "parquet")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder of part files (one line is read)."""
    return [c.removeprefix("﻿") for c in spark.read.option("header", True).csv(path).columns]


def read(spark: SparkSession, path: str, kind: str = "csv", **options: str) -> DataFrame:
    """Every column as a string; short rows end in nulls, a byte-order mark is dropped. Parquet keeps pushdown and pruning below the casts."""
    if kind not in FORMATS:
        raise ValueError(f"no such format: {kind}")
    if kind == "parquet":
        df = spark.read.options(**options).parquet(path)
        return df.select(all_strings(df.columns))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header(spark, path))
    return spark.read.options(header="true", enforceSchema="true", mode="PERMISSIVE", **options).schema(schema).csv(path)


def write(df: DataFrame, path: str, kind: str = "parquet", files: int | None = None) -> int:
    """Replaces path by df and returns its rows, counted while they are written. files: at most so many part files."""
    if kind not in FORMATS:
        raise ValueError(f"no such format: {kind}")
    seen = Observation()
    out = (df.coalesce(files) if files else df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    out.option("header", True).csv(path) if kind == "csv" else out.option("compression", "zstd").parquet(path)
    return seen.get["rows"]


def exists(spark: SparkSession, path: str) -> bool:
    return Files(spark, path).exists(path)
