"""Lenient parsing and exact rounding as Column functions. Nothing here throws under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mean "no number", and the accepted date forms.
NULL_WORDS = ("", "null", "none", "nan")
DATE_FORMS = ("yyyy-M-d", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s")


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def fill(c: Column, default: str) -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def num(c: Column) -> Column:
    """A double; thousands separators are dropped, null words and anything else give null."""
    s = F.trim(c.cast("string"))
    return F.when(F.lower(s).isin(*NULL_WORDS), F.lit(None).cast("double")).otherwise(F.regexp_replace(s, ",", "").try_cast("double"))


def int_strict(c: Column) -> Column:
    """A bigint; numbers with a fraction give null."""
    d = num(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def timestamp_multi(c: Column) -> Column:
    """A timestamp from one of DATE_FORMS, else null."""
    s = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in DATE_FORMS])


def iso(c: Column, kind: str) -> Column:
    """A date or timestamp as its ISO string."""
    return F.date_format(c, "yyyy-MM-dd" if kind == "date" else "yyyy-MM-dd'T'HH:mm:ss")


def money(c: Column) -> Column:
    return c.cast("decimal(20,2)")


def round_product(c: Column) -> Column:
    """A double rounded half up to cents."""
    return F.floor(c * 100 + 0.5) / 100


def cents_average(total: Column, n: Column) -> Column:
    """total / n, total being a decimal with two places, rounded half up in whole cents."""
    cents = (total * 100).cast("bigint")
    return F.when(n == 0, F.lit(0.0)).otherwise(((cents * 2 + n - F.pmod(cents * 2 + n, n * 2)) / (n * 2)).cast("bigint").cast("double") / 100)


def share(part: Column, whole: Column) -> Column:
    """part / whole to four places; a whole of 0 gives 1."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(F.floor(part.cast("double") / whole.cast("double") * 10000 + 0.5) / 10000)


def percent(c: Column) -> Column:
    """A score from 0 to 1 as one from 0 to 100; others stay."""
    return F.when(c <= 1, c * 100).otherwise(c)


def all_strings(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").cast("string").alias(c) for c in columns]
