"""Data-quality rules as Columns: one pass gives good rows, bad rows with reasons, counters and outlier flags.

A rule is a mask over columns. All masks of a dataset stand in one projection, so the split and the counters read the data once each
(or once in all, if the caller persists `masked`). Uniqueness and references are joins to pre-aggregated keys, not windows, so a
frequent key is no task's burden.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.parsing import is_blank, num, timestamp_multi

#: Reason codes by kind.
REASONS = {
    "completeness": "missing_required", "uniqueness": "duplicate_key", "range": "range_violation", "allowed_values": "invalid_value",
    "format": "format_violation", "date_valid": "invalid_date", "referential": "orphan_reference",
}
ORDER = tuple(REASONS)
LEAST_FOR_OUTLIERS = 100
UNPORTABLE = re.compile(r"\\Z|\(\?<|\(\?P|\\G")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    low: float | str | None = None
    high: float | str | None = None
    values: tuple = ()
    pattern: str = ""
    reference: tuple[str, str] | None = None  # table, column
    method: str = "iqr"
    factor: float = 1.5

    def __post_init__(self):
        if self.kind not in (*REASONS, "outlier"):
            raise ValueError(f"no such rule: {self.kind}")
        if UNPORTABLE.search(self.pattern):
            raise ValueError(f"pattern can't be used on every engine: {self.pattern}")

    @property
    def reason(self) -> str:
        return f"{REASONS[self.kind]}:{self.column}"


@dataclass
class Checked:
    masked: DataFrame
    columns: list[str]
    rules: list[Rule]
    masks: list[str]
    flag: str | None = None
    outlier: Rule | None = None
    bounds: DataFrame | None = None
    line: Column | None = None

    @property
    def bad_mask(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(m) for m in self.masks], F.lit(False))

    @property
    def good(self) -> DataFrame:
        return self.masked.where(~self.bad_mask).select(*[F.col(f"`{c}`") for c in self.columns])

    @property
    def bad(self) -> DataFrame:
        """Rows that break a rule, with _reasons (and _line, if rows are numbered)."""
        reasons = F.concat_ws(";", *[F.when(F.col(m), r.reason) for r, m in zip(self.rules, self.masks, strict=True)])
        line = [] if self.line is None else [self.line.alias("_line")]
        return self.masked.where(self.bad_mask).select(*[F.col(f"`{c}`") for c in self.columns], reasons.alias("_reasons"), *line)

    @property
    def flagged(self) -> DataFrame:
        """Good rows with is_anomaly as "1" or "0"."""
        flag = F.when(F.col(self.flag), "1").otherwise("0") if self.flag else F.lit("0")
        return self.masked.where(~self.bad_mask).select(*[F.col(f"`{c}`") for c in self.columns], flag.alias("is_anomaly"))

    @property
    def stats(self) -> DataFrame:
        """rule, column_name, checked, passed, failed, pass_rate: one aggregation for all rules."""
        sums = [F.coalesce(F.sum(F.col(m).cast("bigint")), F.lit(0)).alias(m) for m in self.masks]
        rows = [F.struct(F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column_name"), F.col("n").alias("checked"), F.col(m).alias("failed")) for r, m in zip(self.rules, self.masks, strict=True)]
        if self.outlier:
            v = num(F.col(self.outlier.column))
            sums += [F.count(v).alias("__numbers"), F.coalesce(F.sum(F.col(self.flag).cast("bigint")), F.lit(0)).alias("__flags"), F.max("__lower").alias("__has")]
            found = F.struct(F.lit("outlier").alias("rule"), F.lit(self.outlier.column).alias("column_name"), F.col("__numbers").alias("checked"), F.col("__flags").alias("failed"))
            rows.append(F.when(F.col("__has").isNotNull(), found))
        one = self.masked.agg(F.count("*").alias("n"), *sums)
        out = one.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
        rate = F.when(F.col("checked") == 0, 1.0).otherwise(F.floor((F.col("checked") - F.col("failed")) / F.col("checked") * 10000 + 0.5) / 10000)
        return out.select("rule", "column_name", "checked", (F.col("checked") - F.col("failed")).alias("passed"), "failed", rate.alias("pass_rate"))


def outlier_bounds(df: DataFrame, rule: Rule) -> DataFrame:
    """One row: lower and upper bound; nulls if there are too few numbers."""
    v = num(F.col(rule.column))
    n = F.count(v)
    if rule.method == "zscore":
        mid, spread = F.avg(v), F.stddev_pop(v)
        low, high = mid - rule.factor * spread, mid + rule.factor * spread
    else:
        q1, q3 = F.percentile(v, 0.25), F.percentile(v, 0.75)
        low, high = q1 - rule.factor * (q3 - q1), q3 + rule.factor * (q3 - q1)
    enough = n >= LEAST_FOR_OUTLIERS
    return df.agg(F.when(enough, low).alias("__lower"), F.when(enough, high).alias("__upper"))


def _mask(r: Rule) -> Column:
    c = F.col(r.column)
    if r.kind == "completeness":
        return is_blank(c)
    if r.kind == "range":
        d = num(c)
        low = F.lit(True) if r.low is None else d >= float(r.low)
        high = F.lit(True) if r.high is None else d <= float(r.high)
        return F.coalesce(~(low & high) | d.isNull() | F.isnan(d), F.lit(True))
    if r.kind == "allowed_values":
        return ~is_blank(c) & ~c.isin(*r.values)
    if r.kind == "format":
        return ~is_blank(c) & ~c.rlike(f"^(?:{r.pattern})")
    if r.kind == "date_valid":
        t = timestamp_multi(c)
        low = F.lit(True) if r.low is None else t >= F.lit(r.low).cast("timestamp")
        high = F.lit(True) if r.high is None else t <= F.lit(r.high).cast("timestamp")
        return F.coalesce(~(low & high), F.lit(True))
    raise ValueError(r.kind)


def check(df: DataFrame, rules: list[Rule], references: dict[str, DataFrame] | None = None, order: list[str] | None = None, line: Column | None = None) -> Checked:
    """df checked against rules. order: columns that number the rows (for uniqueness: the first row of a key is good)."""
    references = references or {}
    columns, x = df.columns, df
    own = sorted((r for r in rules if r.kind != "outlier"), key=lambda r: ORDER.index(r.kind))
    masks = []
    for i, r in enumerate(own):
        m = f"__mask_{i}"
        masks.append(m)
        if r.kind == "uniqueness":
            if not order:
                raise ValueError("uniqueness needs an order of rows")
            place = F.struct(*[F.col(c) for c in order])
            often = df.where(~is_blank(F.col(r.column))).groupBy(F.col(r.column).alias(f"__key_{i}")).agg(F.min(place).alias(f"__first_{i}"), F.count("*").alias(f"__n_{i}"))
            x = x.join(often.where(F.col(f"__n_{i}") > 1).drop(f"__n_{i}"), F.col(r.column) == F.col(f"__key_{i}"), "left")
            x = x.withColumn(m, F.coalesce(place != F.col(f"__first_{i}"), F.lit(False)))
        elif r.kind == "referential":
            table, column = r.reference
            if table in references:
                known = references[table].where(~is_blank(F.col(column))).select(F.col(column).cast("string").alias(f"__ref_{i}")).distinct()
                x = x.join(known, F.col(r.column).cast("string") == F.col(f"__ref_{i}"), "left")
                x = x.withColumn(m, ~is_blank(F.col(r.column)) & F.col(f"__ref_{i}").isNull())
            else:
                x = x.withColumn(m, ~is_blank(F.col(r.column)))
        else:
            x = x.withColumn(m, _mask(r))
    outlier = next((r for r in rules if r.kind == "outlier"), None)
    flag = None
    if outlier:
        bounds = outlier_bounds(df, outlier)
        x = x.crossJoin(F.broadcast(bounds))  # one row
        v = num(F.col(outlier.column))
        flag = "__outlier"
        x = x.withColumn(flag, F.coalesce((v < F.col("__lower")) | (v > F.col("__upper")), F.lit(False)))
    return Checked(x, columns, own, masks, flag, outlier, None, line)


def summary(stats: list[DataFrame]) -> DataFrame:
    """One row: dq_score (passed / checked to four places, 1 if nothing was checked) and totals over datasets' stats."""
    every = reduce(DataFrame.unionByName, stats)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    out = every.agg(F.count("*").alias("rules_total"), total("checked"), total("passed"), total("failed"))
    score = F.when(F.col("checked") == 0, 1.0).otherwise(F.floor(F.col("passed") / F.col("checked") * 10000 + 0.5) / 10000)
    return out.select(score.alias("dq_score"), "rules_total", F.col("checked").alias("checks_total"), F.col("passed").alias("checks_passed"), F.col("failed").alias("checks_failed"))
