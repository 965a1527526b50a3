"""A stable number for each row of a source: its place in the order of file names, and within a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.parsing import all_strings
from tidemill.sources import files


def numbered(spark: SparkSession, path: str, kind: str = "parquet", name: str = "_row") -> DataFrame:
    """The source, all columns strings, with name: 0, 1, 2, ... No row moves: what is added up is a few numbers for each file (Parquet) or
    block of a file (CSV)."""
    if kind == "parquet":
        x = spark.read.parquet(path)
        columns = x.columns
        x = x.select(*all_strings(columns), F.col("_metadata.file_path").alias("__file"), F.lit(0).cast("bigint").alias("__block"), F.col("_metadata.row_index").alias("__at"))
    else:
        x = files.read(spark, path, kind)
        columns = x.columns
        x = x.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    parts = x.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__at").alias("__least"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)  # one row a file or block
    offsets = parts.select("__file", "__block", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__least")).alias("__offset"))
    return x.join(F.broadcast(offsets), ["__file", "__block"]).select(*[F.col(f"`{c}`") for c in columns], (F.col("__offset") + F.col("__at")).cast("bigint").alias(name))
