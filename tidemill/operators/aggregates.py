"""Business aggregates and their merge. Money is summed as decimals and leaves as doubles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.parsing import blank_to_null, cents_average, is_blank, money, share

UNKNOWN_CATEGORY = "未知"  # fixed value
UNKNOWN_TIER = "unknown"  # fixed value
TOP_N = 20


def amount(c: str) -> Column:
    return F.coalesce(F.sum(money(F.col(c))), F.lit(0).cast("decimal(20,2)"))


def daily_sales(sales: DataFrame) -> DataFrame:
    """sales: order_date, units, amount."""
    x = sales.groupBy("order_date").agg(F.count("*").alias("orders"), F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("units"), amount("amount").alias("r"))
    return x.select("order_date", "orders", "units", F.col("r").cast("double").alias("revenue"), cents_average(F.col("r"), F.col("orders")).alias("avg_order_value"))


def category_stats(sales: DataFrame, products: DataFrame) -> DataFrame:
    """sales: product_id, units, amount; products: product_id, category."""
    dim = products.groupBy("product_id").agg(F.max("category").alias("category"))
    # Pre-aggregated by product, so the join sees one row a product.
    by_product = sales.groupBy("product_id").agg(F.count("*").alias("n"), F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("u"), amount("amount").alias("a"))
    x = by_product.join(dim, "product_id", "left").withColumn("category", F.coalesce(blank_to_null(F.col("category")), F.lit(UNKNOWN_CATEGORY)))
    x = x.groupBy("category").agg(F.sum("n").cast("bigint").alias("orders"), F.sum("u").cast("bigint").alias("units"), F.sum("a").alias("r"))
    whole = F.sum("r").over(Window.partitionBy(F.lit(1)))  # over categories, of which there are few
    return x.select("category", "orders", "units", F.col("r").cast("double").alias("revenue"), share(F.col("r"), whole).alias("revenue_share"))


def region_channel_stats(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region", "channel").agg(F.count("*").alias("orders"), amount("amount").cast("double").alias("revenue"))


def by_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.count("*").alias("orders"), amount("amount").alias("r"))


def customer_value(sales: DataFrame, customers: DataFrame, top_n: int | None = TOP_N) -> DataFrame:
    """Customers by revenue, then id. With top_n only that many are ranked (top-k first, then a window over k rows)."""
    x = by_customer(sales)
    if top_n is not None:
        x = x.orderBy(F.desc("r"), "customer_id").limit(top_n)
        x = x.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("r"), "customer_id")).cast("bigint"))  # over top_n rows
    else:
        x = ranked(x, "r", "customer_id")
    dim = customers.groupBy("customer_id").agg(F.max("tier").alias("tier"), F.max("city").alias("city"))
    x = x.join(dim, "customer_id", "left")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return x.select("customer_id", text("tier"), text("city"), "orders", F.col("r").cast("double").alias("revenue"), "rank")


def customer_tier(sales: DataFrame, customers: DataFrame) -> DataFrame:
    dim = customers.groupBy("customer_id").agg(F.max("tier").alias("tier"))
    x = by_customer(sales).join(dim, "customer_id", "left").withColumn("tier", F.coalesce(blank_to_null(F.col("tier")), F.lit(UNKNOWN_TIER)))
    return x.groupBy("tier").agg(F.count("*").alias("customers"), F.sum("r").cast("double").alias("revenue"))


def incremental_tier(delta: DataFrame, history: DataFrame, customers: DataFrame) -> DataFrame:
    """Tiers of the delta's customers; only customers that history (customer_id, tier) hasn't are counted."""
    seen = history.groupBy("customer_id").agg(F.max("tier").alias("old_tier"), F.lit(1).alias("seen"))
    dim = customers.groupBy("customer_id").agg(F.max("tier").alias("tier"))
    x = by_customer(delta).join(seen, "customer_id", "left").join(dim, "customer_id", "left")
    tier = F.coalesce(blank_to_null(F.col("old_tier")), blank_to_null(F.col("tier")), F.lit(UNKNOWN_TIER))
    return x.groupBy(tier.alias("tier")).agg(F.sum(F.when(F.col("seen").isNull(), 1).otherwise(0)).cast("bigint").alias("customers"), F.sum("r").cast("double").alias("revenue"))


def kpi(daily: DataFrame, currency: str = "CNY") -> DataFrame:
    """One row over daily_sales; zeros if there are no days."""
    zero = lambda c, t: F.coalesce(c, F.lit(0)).cast(t)
    x = daily.agg(zero(F.sum("orders"), "bigint").alias("orders"), zero(F.sum("units"), "bigint").alias("units"), F.coalesce(F.sum(money(F.col("revenue"))), F.lit(0).cast("decimal(20,2)")).alias("r"), F.count("*").alias("days"))
    return x.select("orders", "units", F.col("r").cast("double").alias("total_revenue"), cents_average(F.col("r"), F.col("orders")).alias("avg_order_value"), "days", F.lit(currency).alias("currency"))


@dataclass(frozen=True)
class AggSpec:
    """How an aggregate merges: keys, summed columns (money or counts), dimensions (the newer non-blank value wins), derived columns."""

    name: str
    keys: tuple[str, ...]
    counts: tuple[str, ...] = ()
    money: tuple[str, ...] = ("revenue",)
    dims: tuple[str, ...] = ()
    derived: tuple[str, ...] = field(default=())


SPECS = (
    AggSpec("daily_sales", ("order_date",), ("orders", "units"), derived=("avg_order_value",)),
    AggSpec("category_stats", ("category",), ("orders", "units"), derived=("revenue_share",)),
    AggSpec("region_channel_stats", ("region", "channel"), ("orders",)),
    AggSpec("customer_value", ("customer_id",), ("orders",), dims=("tier", "city"), derived=("rank",)),
    AggSpec("customer_tier", ("tier",), ("customers",)),
)


def merge(history: DataFrame, delta: DataFrame, spec: AggSpec) -> DataFrame:
    """history and delta summed by key; derived columns are made anew."""
    both = history.withColumn("__src", F.lit(0)).unionByName(delta.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in spec.counts] + [amount(c).alias(f"__{c}") for c in spec.money]
    newest = [F.coalesce(F.max_by(F.when(~is_blank(F.col(c)), F.col(c)), F.when(~is_blank(F.col(c)), F.col("__src"))), F.lit("")).alias(c) for c in spec.dims]
    x = both.groupBy(*spec.keys).agg(*sums, *newest)
    out = [*spec.keys, *spec.dims, *spec.counts, *[F.col(f"__{c}").cast("double").alias(c) for c in spec.money]]
    for d in spec.derived:
        if d == "avg_order_value":
            out.append(cents_average(F.col("__revenue"), F.col("orders")).alias(d))
        elif d == "revenue_share":
            out.append(share(F.col("__revenue"), F.sum("__revenue").over(Window.partitionBy(F.lit(1)))).alias(d))
        elif d == "rank":
            x = ranked(x, "__revenue", spec.keys[0])
            out.append("rank")
    return x.select(*out)


def ranked(x: DataFrame, value: str, key: str, parts: int = 200) -> DataFrame:
    """x with rank, 1 being the highest value (then key). Ranks are counted in ranges of the value, so no task orders all rows."""
    cuts = x.agg(F.percentile_approx(F.col(value).cast("double"), [i / parts for i in range(1, parts)], F.lit(10000)).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    v = F.col(value).cast("double")
    band = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= v)) if cuts else F.lit(0)
    y = x.withColumn("__band", band.cast("int"))
    sizes = y.groupBy("__band").agg(F.count("*").alias("n"))
    above = Window.partitionBy(F.lit(1)).orderBy(F.desc("__band")).rowsBetween(Window.unboundedPreceding, -1)  # at most `parts` rows
    before = sizes.select("__band", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("__before"))
    w = Window.partitionBy("__band").orderBy(F.desc(value), key)
    return y.join(F.broadcast(before), "__band").withColumn("rank", (F.row_number().over(w) + F.col("__before")).cast("bigint")).drop("__band", "__before")
