"""Synthetic orders, customers and products: spark.range and seeded hashes, so any size is made in parallel and repeatably."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains, rates and defects of the synthetic tables.
REGIONS = ("华东", "华北", "华南", "西南", "西北", "东北", "华中")
CHANNELS = ("web", "app", "store")
STATUSES = ("completed", "pending", "cancelled", "refunded")
CATEGORIES = ("数码", "服饰", "家居", "食品", "美妆", "图书")
TIERS = (("bronze", 50), ("silver", 30), ("gold", 15), ("platinum", 5))
CITIES = ("上海", "北京", "广州", "深圳", "杭州", "成都", "武汉", "西安", "南京", "重庆")
RATES = {"missing": 0.02, "duplicate": 0.01, "negative_qty": 0.005, "invalid_status": 0.01, "bad_date": 0.005, "orphan_fk": 0.01, "bad_channel": 0.005, "outlier": 0.002}
BAD_DATES = ("2027-13-01", "2027-01-01", "2019-06-30", "not-a-date")
BAD_STATUSES = ("shipped", "processing", "unknown", "")
BAD_CHANNELS = ("wechat", "phone", "tv")
BASE_DATE, DAYS, SEED = "2026-08-15", 90, 42


def uniform(seed: int, what: str) -> Column:
    """A number in [0, 1) for each id and purpose."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), F.col("id")), F.lit(1 << 40)) / float(1 << 40)


def whole(seed: int, what: str, n: int) -> Column:
    return F.floor(uniform(seed, what) * n).cast("int")


def pick(seed: int, what: str, values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values))[whole(seed, what, len(values))]


def customers(spark: SparkSession, n: int = 3000, seed: int = SEED) -> DataFrame:
    at, tier = 0, None
    u = uniform(seed, "tier") * 100
    for name, weight in TIERS:
        at += weight
        tier = F.when(u < at, name) if tier is None else tier.when(u < at, name)
    joined = F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), whole(seed, "join", 4000)), "yyyy-MM-dd")
    return spark.range(1, n + 1).select(F.format_string("CUS-%06d", "id").alias("customer_id"), tier.alias("tier"), pick(seed, "city", CITIES).alias("city"), joined.alias("join_date"))


def products(spark: SparkSession, n: int = 200, seed: int = SEED) -> DataFrame:
    category = pick(seed, "category", CATEGORIES)
    x = spark.range(1, n + 1).withColumn("category", category)
    cost = F.format_string("%.2f", F.round(5 + uniform(seed, "cost") * 995, 2))
    return x.select(F.format_string("PRD-%06d", "id").alias("product_id"), F.format_string("%s-商品%03d", "category", "id").alias("name"), "category", cost.alias("cost"))


def orders(spark: SparkSession, n: int = 20_000, n_customers: int = 3000, n_products: int = 200, seed: int = SEED, rates: dict[str, float] | None = None) -> DataFrame:
    """n orders and a share of repeated ones, all columns strings, with defects at the given rates (each kind drawn by itself)."""
    rate = {**RATES, **(rates or {})}
    hit = lambda kind: uniform(seed, kind) < rate[kind]
    day = F.date_sub(F.lit(BASE_DATE).cast("date"), whole(seed, "day", DAYS))
    clock = F.format_string("%02d:%02d:%02d", whole(seed, "hour", 24), whole(seed, "minute", 60), whole(seed, "second", 60))
    gone = whole(seed, "gone", 5)
    blank = lambda c, i: F.when(hit("missing") & (gone == i), "").otherwise(c)
    price = F.when(hit("outlier"), 50_000 + uniform(seed, "high") * 150_000).otherwise(5 + uniform(seed, "price") * 1495)
    quantity = F.when(hit("negative_qty"), -1 - whole(seed, "minus", 9)).otherwise(1 + whole(seed, "qty", 20))
    x = spark.range(1, n + 1)
    x = x.unionAll(x.where(hit("duplicate")))
    customer = F.when(hit("orphan_fk"), "CUS-999999").otherwise(F.format_string("CUS-%06d", 1 + whole(seed, "customer", n_customers)))
    return x.select(
        F.format_string("ORD-%08d", "id").alias("order_id"), blank(customer, 2).alias("customer_id"), F.format_string("PRD-%06d", 1 + whole(seed, "product", n_products)).alias("product_id"),
        F.when(hit("bad_date"), pick(seed, "bad day", BAD_DATES)).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("order_date"), F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), clock).alias("created_ts"),
        blank(pick(seed, "region", REGIONS), 0).alias("region"), blank(F.when(hit("bad_channel"), pick(seed, "bad channel", BAD_CHANNELS)).otherwise(pick(seed, "channel", CHANNELS)), 1).alias("channel"),
        blank(quantity.cast("string"), 4).alias("quantity"), blank(F.format_string("%.2f", price), 3).alias("unit_price"),
        F.when(hit("invalid_status"), pick(seed, "bad status", BAD_STATUSES)).otherwise(pick(seed, "status", STATUSES)).alias("status"),
    )
