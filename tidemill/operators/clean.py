"""Cleaning: keep-first, fills, derived amounts, anomaly flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.parsing import fill, int_strict, num, round_product


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with one key, the first by order. An aggregation with map-side combine, so frequent keys don't meet in one task."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(*key).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"))
    return first.select("__row.*")


def fill_missing(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    return df.withColumns({c: fill(F.col(c), d) for c, d in defaults.items() if c in df.columns})


def total_amount(quantity: Column, price: Column, discount: Column | None = None, strict: bool = True) -> Column:
    """quantity * price * (1 - discount) in cents; what can't be parsed counts 0. strict: quantities with a fraction can't be parsed."""
    q = F.coalesce((int_strict(quantity) if strict else num(quantity)).cast("double"), F.lit(0.0))
    p = F.coalesce(num(price), F.lit(0.0))
    d = F.lit(0.0) if discount is None else F.coalesce(num(discount), F.lit(0.0))
    return round_product(q * p * (1 - d))


def amount_or_null(quantity: Column, price: Column) -> Column:
    """The amount before validation: null if either can't be parsed."""
    return round_product(int_strict(quantity).cast("double") * num(price))


def flag(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """df with is_anomaly, "1" for the rows whose column is among ids."""
    marks = ids.select(F.col(column).alias("__flagged")).distinct()
    return df.join(marks, F.col(column) == F.col("__flagged"), "left").withColumn("is_anomaly", F.when(F.col("__flagged").isNotNull(), "1").otherwise("0")).drop("__flagged")
