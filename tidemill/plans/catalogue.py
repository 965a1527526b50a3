"""The engine's queries over the driver's tables, each with its oracle in DuckDB SQL.

The queries call the same operators as the pipeline. The driver's tables are clean, so the rule queries read `defects`, orders with
deterministic defects of eight kinds, defined by one list of expressions that both engines share.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import parsing as P
from tidemill.operators import aggregates as A
from tidemill.operators import clean as C
from tidemill.operators.rules import REASONS, Rule, check, summary
from tidemill.plans import monitor
from tidemill.plans.batch import Batch
from tidemill.plans.config import Config
from tidemill.sources import generator
from tidemill.sources.snapshots import Files, SnapshotTable, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WATERMARK = "1996-01-01"
EVENT_WATERMARK = "2024-01-15 00:00:00"

# What a key's remainder makes of each column; the last is the column itself.
DEFECT_COLUMNS = {
    "order_id": "cast(o_orderkey as {text})",
    "customer_id": "case when o_orderkey % 100 = 17 then '-999999' when o_orderkey % 50 = 9 then '' else cast(o_custkey as {text}) end",
    "channel": "case when o_orderkey % 50 = 7 then '' when o_orderkey % 50 = 8 then '   ' else o_orderpriority end",
    "status": "case when o_orderkey % 100 = 11 then 'shipped' else o_orderstatus end",
    "price": "case o_orderkey % 200 when 3 then '-5' when 4 then 'abc' when 5 then '1,234.5' when 6 then '5.5' else cast(cast(o_totalprice as decimal(20,2)) as {text}) end",
    "day": "case o_orderkey % 200 when 13 then 'not-a-date' when 14 then '2027-13-01' when 15 then '2019-06-30' when 16 then '1996-1-5' else {day} end",
    "amount": "case when o_orderkey % 500 = 23 then o_totalprice * 1000 else o_totalprice end",
    "quantity": "case o_orderkey % 7 when 0 then '5.5' when 1 then '' else cast(o_orderkey % 20 + 1 as {text}) end",
    "place": "o_orderkey",
}


def query(name: str, oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _defects_sql() -> str:
    cols = ", ".join(f"{e.format(text='varchar', day="strftime(o_orderdate, '%Y-%m-%d')")} as {c}" for c, e in DEFECT_COLUMNS.items())
    return f"defects as (select {cols}, 0 as copy from orders union all select {cols}, 1 as copy from orders where o_orderkey % 100 = 19)"


def defects(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    cols = [f"{e.format(text='string', day="date_format(o_orderdate, 'yyyy-MM-dd')")} as {c}" for c, e in DEFECT_COLUMNS.items()]
    return orders.selectExpr(*cols, "0 as copy").unionAll(orders.where("o_orderkey % 100 = 19").selectExpr(*cols, "1 as copy"))


# The same rules in SQL: what fails.
BLANK = "({c} is null or trim({c}) = '')"
NUM = "try_cast(replace(case when lower(trim({c})) in ('', 'null', 'none', 'nan') then null else trim({c}) end, ',', '') as double)"
RULES = {
    "dq_completeness": (Rule("completeness", "channel"), BLANK.format(c="channel")),
    "dq_uniqueness": (Rule("uniqueness", "order_id"), "(row_number() over (partition by order_id order by place, copy) > 1)"),
    "dq_range": (Rule("range", "price", low=0.01, high=100000.0), f"coalesce(not ({NUM.format(c='price')} between 0.01 and 100000), true)"),
    "dq_allowed": (Rule("allowed_values", "status", values=("O", "F", "P")), f"(not {BLANK.format(c='status')} and status not in ('O', 'F', 'P'))"),
    "dq_format": (Rule("format", "channel", pattern=r"[1-3]-[A-Z]+"), f"(not {BLANK.format(c='channel')} and not regexp_matches(channel, '^(?:[1-3]-[A-Z]+)'))"),
    "dq_date_valid": (Rule("date_valid", "day", low="1992-01-01", high="1997-12-31"), "coalesce(not (coalesce(try_strptime(trim(day), '%Y-%m-%d'), try_strptime(trim(day), '%Y-%m-%dT%H:%M:%S'), try_strptime(trim(day), '%Y-%m-%d %H:%M:%S')) between timestamp '1992-01-01' and timestamp '1997-12-31'), true)"),
    "dq_referential": (Rule("referential", "customer_id", reference=("customers", "customer_id")), f"(not {BLANK.format(c='customer_id')} and customer_id not in (select cast(c_custkey as varchar) from customer))"),
}
OUTLIER = {"dq_outlier_iqr": Rule("outlier", "amount", factor=1.5), "dq_outlier_zscore": Rule("outlier", "amount", method="zscore", factor=3.0)}


def checked(spark: SparkSession, sf: str, rules: list[Rule]):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    return check(defects(spark, sf), rules, {"customers": customers}, order=["place", "copy"])


def _stat_sql(kind: str, column: str, n: str, failed: str) -> str:
    return f"select '{kind}' as rule, '{column}' as column_name, {n} as checked, {n} - {failed} as passed, {failed} as failed, case when {n} = 0 then 1.0 else floor(({n} - {failed}) / {n} * 10000 + 0.5) / 10000 end as pass_rate"


for _name, (_rule, _fails) in RULES.items():
    query(_name, f"with {_defects_sql()}, m as (select {_fails} as f from defects), s as (select count(*) as n, count(*) filter (f) as k from m) {_stat_sql(_rule.kind, _rule.column, 'n', 'k')} from s")(
        lambda spark, sf, r=_rule: checked(spark, sf, [r]).stats
    )
for _name, _rule in OUTLIER.items():
    _bounds = "select quantile_cont(amount, 0.25) - 1.5 * (quantile_cont(amount, 0.75) - quantile_cont(amount, 0.25)) as lo, quantile_cont(amount, 0.75) + 1.5 * (quantile_cont(amount, 0.75) - quantile_cont(amount, 0.25)) as hi from defects"
    if _rule.method == "zscore":
        _bounds = "select avg(amount) - 3 * stddev_pop(amount) as lo, avg(amount) + 3 * stddev_pop(amount) as hi from defects"
    query(_name, f"with {_defects_sql()}, b as ({_bounds}), s as (select count(amount) as n, count(*) filter (amount < lo or amount > hi) as k from defects, b) {_stat_sql('outlier', 'amount', 'n', 'k')} from s")(
        lambda spark, sf, r=_rule: checked(spark, sf, [r]).stats
    )

_ALL = [r for r, _ in RULES.values()]
_FAILS = {r.reason: f for r, f in RULES.values()}
_MARKED = f"{_defects_sql()}, m as (select *, {', '.join(f'{f} as f{i}' for i, f in enumerate(_FAILS.values()))} from defects)"
_ANY = " or ".join(f"f{i}" for i in range(len(_FAILS)))
_REASON_ORDER = sorted(range(len(_ALL)), key=lambda i: ("completeness", "uniqueness", "range", "allowed_values", "format", "date_valid", "referential").index(_ALL[i].kind))
_REASONS = "concat_ws(';', " + ", ".join(f"case when f{i} then '{_ALL[i].reason}' end" for i in _REASON_ORDER) + ")"


@query("dq_bad_rows", f"with {_MARKED} select order_id, customer_id, channel, status, price, day, place * 2 + copy + 2 as line, {_REASONS} as reasons from m where {_ANY}")
def dq_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    x = checked(spark, sf, _ALL)
    x.line = F.col("place") * 2 + F.col("copy") + 2
    return x.bad.select("order_id", "customer_id", "channel", "status", "price", "day", F.col("_line").alias("line"), F.col("_reasons").alias("reasons"))


@query("dq_good_rows", f"with {_MARKED} select order_id, customer_id, channel, status, price, day from m where not ({_ANY})")
def dq_good_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checked(spark, sf, _ALL).good.select("order_id", "customer_id", "channel", "status", "price", "day")


@query(
    "dq_summary",
    f"with {_MARKED}, s as (select {len(_FAILS)} as r, count(*) * {len(_FAILS)} as n, cast(sum({' + '.join(f'f{i}::int' for i in range(len(_FAILS)))}) as bigint) as k from m) "
    "select case when n = 0 then 1.0 else floor((n - k) / n * 10000 + 0.5) / 10000 end as dq_score, cast(r as bigint) as rules_total, n as checks_total, n - k as checks_passed, k as checks_failed from s",
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary([checked(spark, sf, _ALL).stats])


# Sales facts: one for each order, and one for each line.
_SALES = "sales as (select cast(o_orderdate as date) as order_date, o_custkey as customer_id, o_orderpriority as channel, cast(1 as bigint) as units, o_totalprice as amount from orders)"
_DAILY = "select order_date, count(*) as orders, cast(sum(units) as bigint) as units, cast(sum(cast(amount as decimal(20,2))) as double) as revenue, cast((2 * cast(sum(cast(amount as decimal(20,2))) * 100 as bigint) + count(*)) // (2 * count(*)) as double) / 100 as avg_order_value from sales"
_LINES = "lines as (select l_partkey as product_id, cast(l_quantity as bigint) as units, floor(l_quantity * l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100 as amount from lineitem)"
_DIM = "dim as (select c_custkey as customer_id, max(c_mktsegment) as tier, max(cast(c_nationkey as varchar)) as city from customer group by 1)"
_VALUE = "v as (select customer_id, count(*) as orders, sum(cast(amount as decimal(20,2))) as r from sales group by 1)"


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("order_date"), F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("channel"),
        F.lit(1).cast("bigint").alias("units"), F.col("o_totalprice").alias("amount"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("tier"), F.col("c_nationkey").cast("string").alias("city"))


@query("daily_sales", f"with {_SALES} {_DAILY} group by 1 order by 1")
def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return A.daily_sales(sales(spark, sf)).orderBy("order_date")


@query(
    "category_stats",
    f"with {_LINES}, d as (select p_partkey as product_id, max(p_brand) as category from part group by 1), x as (select coalesce(nullif(trim(category), ''), '未知') as category, count(*) as orders, cast(sum(units) as bigint) as units, sum(cast(amount as decimal(20,2))) as r from lines left join d using (product_id) group by 1) "
    "select category, orders, units, cast(r as double) as revenue, floor(cast(r as double) / cast(sum(r) over () as double) * 10000 + 0.5) / 10000 as revenue_share from x order by revenue desc, category",
)
def category_stats(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("units"), P.round_product(F.col("l_quantity") * F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("category"))
    return A.category_stats(lines, parts).orderBy(F.desc("revenue"), "category")


@query(
    "region_channel_stats",
    "select r_name as region, o_orderpriority as channel, count(*) as orders, cast(sum(cast(o_totalprice as decimal(20,2))) as double) as revenue from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1, 2 order by 1, 2",
)
def region_channel_stats(spark: SparkSession, sf: str) -> DataFrame:
    where = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    x = sales(spark, sf).join(where.select(F.col("c_custkey").alias("customer_id"), F.col("r_name").alias("region")), "customer_id", "left")
    return A.region_channel_stats(x).orderBy("region", "channel")


_RANKED = "select customer_id, coalesce(tier, '') as tier, coalesce(city, '') as city, orders, cast(r as double) as revenue, row_number() over (order by r desc, customer_id) as rank from v left join dim using (customer_id)"


@query("customer_value_top", f"with {_SALES}, {_VALUE}, {_DIM}, x as ({_RANKED}) select * from x where rank <= 20 order by rank")
def customer_value_top(spark: SparkSession, sf: str) -> DataFrame:
    return A.customer_value(sales(spark, sf), customers(spark, sf)).orderBy("rank")


@query("customer_value_merged", f"with {_SALES}, {_VALUE}, {_DIM} {_RANKED}")
def customer_value_merged(spark: SparkSession, sf: str) -> DataFrame:
    """All customers: history up to the watermark merged with the delta after it, ranks counted anew."""
    old, new = _split(spark, sf)
    half = lambda s: A.customer_value(s, customers(spark, sf), None)
    return A.merge(half(old), half(new), A.SPECS[3])


_TIER = "select coalesce(nullif(trim(tier), ''), 'unknown') as tier, count(*) as customers, cast(sum(r) as double) as revenue from v left join dim using (customer_id) group by 1"


@query("customer_tier", f"with {_SALES}, {_VALUE}, {_DIM} {_TIER} order by 1")
def customer_tier(spark: SparkSession, sf: str) -> DataFrame:
    return A.customer_tier(sales(spark, sf), customers(spark, sf)).orderBy("tier")


_KPI = "select cast(coalesce(sum(orders), 0) as bigint) as orders, cast(coalesce(sum(units), 0) as bigint) as units, cast(coalesce(sum(cast(revenue as decimal(20,2))), 0) as double) as total_revenue, case when coalesce(sum(orders), 0) = 0 then 0.0 else cast((2 * cast(sum(cast(revenue as decimal(20,2))) * 100 as bigint) + cast(sum(orders) as bigint)) // (2 * cast(sum(orders) as bigint)) as double) / 100 end as avg_order_value, count(*) as days, 'CNY' as currency from d"


@query("kpi", f"with {_SALES}, d as ({_DAILY} group by 1) {_KPI}")
def kpi(spark: SparkSession, sf: str) -> DataFrame:
    return A.kpi(A.daily_sales(sales(spark, sf)))


@query("kpi_empty", f"with {_SALES}, d as ({_DAILY} where amount < -1 group by 1) {_KPI}")
def kpi_empty(spark: SparkSession, sf: str) -> DataFrame:
    """No orders: a row of zeros."""
    return A.kpi(A.daily_sales(sales(spark, sf).where("amount < -1")))


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("clean_dedup", f"select * exclude (n) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(_LINE_ORDER)}) as n from lineitem) where n = 1")
def clean_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return C.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("clean_fill", f"with {_defects_sql()} select order_id, copy, case when {BLANK.format(c='channel')} then 'unknown' else channel end as channel, nullif(trim(customer_id), '') as customer_id from defects")
def clean_fill(spark: SparkSession, sf: str) -> DataFrame:
    x = C.fill_missing(defects(spark, sf), {"channel": "unknown"})
    return x.select("order_id", "copy", "channel", F.trim(P.blank_to_null(F.col("customer_id"))).alias("customer_id"))


_Q, _PR = NUM.format(c="quantity"), NUM.format(c="price")
_STRICT = f"(case when {_Q} = floor({_Q}) then cast({_Q} as bigint) end)"


@query("clean_amount", f"with {_defects_sql()} select order_id, copy, floor(coalesce(cast({_STRICT} as double), 0) * coalesce({_PR}, 0) * (1 - 0.1) * 100 + 0.5) / 100 as total_amount, floor(cast({_STRICT} as double) * {_PR} * 100 + 0.5) / 100 as raw_amount from defects")
def clean_amount(spark: SparkSession, sf: str) -> DataFrame:
    q, p = F.col("quantity"), F.col("price")
    return defects(spark, sf).select("order_id", "copy", C.total_amount(q, p, F.lit("0.1")).alias("total_amount"), C.amount_or_null(q, p).alias("raw_amount"))


_IQR = "b as (select quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.75) as q3 from defects)"


@query("clean_flag", f"with {_defects_sql()}, {_IQR}, o as (select distinct order_id from defects, b where amount < q1 - 1.5 * (q3 - q1) or amount > q3 + 1.5 * (q3 - q1)) select order_id, copy, case when order_id in (select order_id from o) then '1' else '0' end as is_anomaly from defects")
def clean_flag(spark: SparkSession, sf: str) -> DataFrame:
    x = checked(spark, sf, [OUTLIER["dq_outlier_iqr"]])
    ids = x.flagged.where("is_anomaly = '1'").select("order_id")
    return C.flag(defects(spark, sf), ids, "order_id").select("order_id", "copy", "is_anomaly")


@query("final_output", "select *, 'B-1' as _batch_id, 'orders.parquet' as _source_file from orders")
def final_output(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumns({"_batch_id": F.lit("B-1"), "_source_file": F.lit("orders.parquet")})


@query("iso_dates", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as ts from orders")
def iso_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", P.iso(F.col("o_orderdate"), "date").alias("day"), P.iso(F.col("o_orderdate"), "timestamp").alias("ts"))


# Incremental processing.
def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    x = sales(spark, sf)
    return x.where(F.col("order_date") <= WATERMARK), x.where(F.col("order_date") > WATERMARK)


@query("max_watermark", "select max(ts) as watermark from events")
def max_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").agg(F.max("ts").alias("watermark"))


@query("delta_filter", f"select event_id, ts, user_id, event_type, value from events where ts > timestamp '{EVENT_WATERMARK}'")
def delta_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.col("ts") > F.lit(EVENT_WATERMARK).cast("timestamp_ntz")).select("event_id", "ts", "user_id", "event_type", "value")


@query("merge_aggregate", f"with {_SALES} {_DAILY} group by 1")
def merge_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """History and delta merged equal the whole."""
    old, new = _split(spark, sf)
    return A.merge(A.daily_sales(old), A.daily_sales(new), A.SPECS[0])


@query(
    "incremental_tier_new",
    f"with {_SALES}, {_DIM}, h as (select distinct customer_id from sales where order_date <= date '{WATERMARK}'), v as (select customer_id, sum(cast(amount as decimal(20,2))) as r from sales where order_date > date '{WATERMARK}' group by 1) "
    "select coalesce(nullif(trim(tier), ''), 'unknown') as tier, cast(sum(case when h.customer_id is null then 1 else 0 end) as bigint) as customers, cast(sum(r) as double) as revenue from v left join h on v.customer_id = h.customer_id left join dim on v.customer_id = dim.customer_id group by 1",
)
def incremental_tier_new(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _split(spark, sf)
    history = A.customer_value(old, customers(spark, sf), None).select("customer_id", "tier")
    return A.incremental_tier(new, history, customers(spark, sf))


def _log(spark: SparkSession, sf: str) -> SnapshotTable:
    """Orders in two appends, up to the watermark and after."""
    log = SnapshotTable(spark, scratch(spark, "orders"))
    orders = table(spark, sf, "orders")
    log.append(orders.where(F.col("o_orderdate") <= F.lit(WATERMARK).cast("timestamp_ntz")))
    log.append(orders.where(F.col("o_orderdate") > F.lit(WATERMARK).cast("timestamp_ntz")))
    return log


@query("snapshot_diff", f"select * from orders where o_orderdate > timestamp '{WATERMARK}'")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    return log.diff(log.snapshots()[0]["snapshot_id"])


@query("time_travel", f"select * from orders where o_orderdate <= timestamp '{WATERMARK}'")
def time_travel(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    return log.read(log.snapshots()[0]["snapshot_id"])


@query("snapshot_read", "select * from orders")
def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).read()


@query("snapshot_list", f"select 1 as number, 'append' as operation, cast(null as bigint) as parent, count(*) filter (o_orderdate <= timestamp '{WATERMARK}') as rows from orders union all select 2, 'append', 1, count(*) filter (o_orderdate > timestamp '{WATERMARK}') from orders")
def snapshot_list(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    rows = [(s["sequence"], s["operation"], s["parent_sequence"], s["summary"]["added_rows"]) for s in log.snapshots()]
    return spark.createDataFrame(rows, "number int, operation string, parent bigint, rows bigint")


# Whole batches over a source that is written from the driver's tables with defects of its own; one run serves all queries of a session.
RAW_ORDERS = {
    "order_id": "concat('ORD-', lpad(cast(o_orderkey as {text}), 8, '0'))",
    "customer_id": "case when o_orderkey % 100 = 17 then 'none' when o_orderkey % 50 = 9 then '' else cast(o_custkey as {text}) end",
    "product_id": "cast(o_orderkey % 90 + 1 as {text})",
    "order_date": "case o_orderkey % 200 when 13 then 'not-a-date' when 14 then '2127-13-01' else {day} end",
    "region": "case when o_orderkey % 50 = 21 then '' else concat('R', cast(o_custkey % 5 as {text})) end",
    "channel": "case when o_orderkey % 100 = 11 then 'phone' when o_orderkey % 50 = 7 then '  ' when o_orderkey % 3 = 0 then 'web' when o_orderkey % 3 = 1 then 'app' else 'store' end",
    "quantity": "case o_orderkey % 200 when 3 then '-3' when 5 then '' when 9 then '5.5' else cast(o_orderkey % 20 + 1 as {text}) end",
    "unit_price": "case when o_orderkey % 200 = 4 then 'abc' when o_orderkey % 500 = 23 then '90,000.5' else cast(o_orderkey % 1000 + 5 as {text}) end",
    "status": "case when o_orderkey % 100 = 33 then 'shipped' else 'completed' end",
}
RAW_RULES = {
    "orders": (
        *[Rule("completeness", c) for c in ("order_id", "customer_id", "quantity")], Rule("uniqueness", "order_id"), Rule("range", "quantity", 1, 1000), Rule("range", "unit_price", 0.01, 100_000),
        Rule("allowed_values", "status", values=("completed",)), Rule("allowed_values", "channel", values=("web", "app", "store")), Rule("format", "order_id", pattern=r"ORD-\d{8}$"),
        Rule("date_valid", "order_date", "1992-01-01", "2099-12-31"), Rule("referential", "customer_id", reference=("customers", "customer_id")), Rule("outlier", "total_amount", factor=3.0),
    ),
    "customers": (Rule("completeness", "customer_id"), Rule("uniqueness", "customer_id")),
    "products": (Rule("completeness", "product_id"), Rule("range", "cost", 0, 100_000)),
}
TODAY = "1998-12-31"


def _raw_sql() -> str:
    cols = ", ".join(f"{e.format(text='varchar', day="strftime(o_orderdate, '%Y-%m-%d')")} as {c}" for c, e in RAW_ORDERS.items())
    return f"raw as (select {cols}, row_number() over (order by copy, o_orderkey) - 1 as line from (select *, 0 as copy from orders union all select *, 1 from orders where o_orderkey % 100 = 19))"


def _ran(spark: SparkSession, sf: str, mode: str = "") -> tuple[Batch, dict]:
    """The batch over sf's raw orders and its manifest. In high_watermark mode, a first batch up to WATERMARK came before."""
    runs = spark.__dict__.setdefault("_tidemill_runs", {})
    if (sf, mode) in runs:
        return runs[sf, mode]
    root = scratch(spark, "batches")
    cols = [F.expr(e.format(text="string", day="date_format(o_orderdate, 'yyyy-MM-dd')")).alias(c) for c, e in RAW_ORDERS.items()]
    o = table(spark, sf, "orders")
    raw = o.withColumn("copy", F.lit(0)).unionAll(o.where("o_orderkey % 100 = 19").withColumn("copy", F.lit(1))).orderBy("copy", "o_orderkey").select(*cols)
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c.select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("tier"), F.col("n_name").alias("city")).write.parquet(f"{root}/in/customers")
    table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("category"), F.col("p_retailprice").cast("string").alias("cost")).write.parquet(f"{root}/in/products")
    sources = {n: f"{root}/in/{n}" for n in ("orders", "customers", "products")}
    config = Config(root=f"{root}/run", sources=sources, rules=RAW_RULES, mode=mode)
    if mode:
        raw.where(F.col("order_date") <= WATERMARK).write.parquet(sources["orders"])
        Batch(spark, config, "B-1", WATERMARK).run()
    raw.write.mode("overwrite").parquet(sources["orders"])
    b = Batch(spark, config, "B-2" if mode else "B-1", TODAY)
    runs[sf, mode] = b, b.run()
    return runs[sf, mode]


def _mask_sql() -> list[tuple[str, str]]:
    """(reason, DuckDB predicate) of RAW_RULES' orders, in order."""
    q, p = NUM.format(c="quantity"), NUM.format(c="unit_price")
    blank = lambda c: f"coalesce(trim({c}) = '', true)"
    day = "coalesce(try_strptime(trim(order_date), '%Y-%m-%d'), null)"
    return [
        *[(f"missing_required:{c}", blank(c)) for c in ("order_id", "customer_id", "quantity")], ("duplicate_key:order_id", "row_number() over (partition by order_id order by line) > 1"),
        ("range_violation:quantity", f"coalesce(not ({q} between 1 and 1000), true)"), ("range_violation:unit_price", f"coalesce(not ({p} between 0.01 and 100000), true)"),
        ("invalid_value:status", f"not {blank('status')} and status <> 'completed'"), ("invalid_value:channel", f"not {blank('channel')} and channel not in ('web', 'app', 'store')"),
        ("format_violation:order_id", "not regexp_matches(order_id, '^ORD-[0-9]{8}$')"), ("invalid_date:order_date", f"coalesce(not ({day} between timestamp '1992-01-01' and timestamp '2099-12-31'), true)"),
        ("orphan_reference:customer_id", f"not {blank('customer_id')} and customer_id not in (select cast(c_custkey as varchar) from customer)"),
    ]


def _run_sql() -> str:
    """CTEs: raw, marked, good, bounds, clean (as after the clean stage)."""
    masks = ", ".join(f"{m} as m{i}" for i, (_, m) in enumerate(_mask_sql()))
    bad = " or ".join(f"m{i}" for i in range(len(_mask_sql())))
    q, p = NUM.format(c="quantity"), NUM.format(c="unit_price")
    strict = f"(case when {q} = floor({q}) then cast({q} as bigint) end)"
    return (
        f"{_raw_sql()}, marked as (select *, {masks}, floor(cast({strict} as double) * {p} * 100 + 0.5) / 100 as pre from raw), good as (select * from marked where not ({bad})), "
        "b as (select quantile_cont(pre, 0.25) as q1, quantile_cont(pre, 0.75) as q3 from marked), "
        f"clean as (select order_id, customer_id, product_id, order_date, coalesce(nullif(trim(region), ''), 'unknown') as region, coalesce(nullif(trim(channel), ''), 'unknown') as channel, quantity, unit_price, status, "
        f"coalesce({strict}, 0) as units, floor(coalesce(cast({strict} as double), 0) * coalesce({p}, 0) * 1 * 100 + 0.5) / 100 as total_amount, "
        "case when pre < q1 - 3.0 * (q3 - q1) or pre > q3 + 3.0 * (q3 - q1) then '1' else '0' end as is_anomaly from good, b)"
    )


_CENTS = "cast((2 * cast(r * 100 as bigint) + n) // (2 * n) as double) / 100"
_CLEAN_DAILY = "daily as (select order_date, count(*) as n, cast(sum(units) as bigint) as units, sum(cast(total_amount as decimal(20,2))) as r from clean group by 1)"
_REASONS = "concat_ws(';', " + ", ".join(f"case when m{i} then '{r}' end" for i, (r, _) in enumerate(_mask_sql())) + ")"


def _run_query(name: str, stage: str, part: str, oracle: str, mode: str = "") -> None:
    @query(name, f"with {_run_sql()}, {_CLEAN_DAILY} {oracle}")
    def one(spark: SparkSession, sf: str) -> DataFrame:
        batch, m = _ran(spark, sf, mode)
        return batch.read(m, stage, part)


_run_query("run_ingest", "ingest", "orders", f"select {', '.join(RAW_ORDERS)}, cast(line as bigint) as _row from raw")
_run_query("run_valid", "validate", "valid_orders", f"select {', '.join(RAW_ORDERS)}, cast(line as bigint) as _row from good")
_run_query("run_quarantine", "validate", "quarantine_orders", f"select {', '.join(RAW_ORDERS)}, {_REASONS} as _reasons, cast(line + 2 as bigint) as _line from marked where {_REASONS} <> ''")
_run_query("run_clean", "clean", "orders", "select * exclude (units) from clean")
_run_query("run_daily_sales", "compute", "daily_sales", f"select order_date, n as orders, units, cast(r as double) as revenue, {_CENTS} as avg_order_value from daily")
_run_query("run_kpi", "compute", "kpi", f"select orders, units, total_revenue, avg_order_value, days, currency from (select cast(sum(n) as bigint) as orders, cast(sum(units) as bigint) as units, cast(sum(r) as double) as total_revenue, cast((2 * cast(sum(r) * 100 as bigint) + sum(n)) // (2 * sum(n)) as double) / 100 as avg_order_value, count(*) as days, 'CNY' as currency from daily)")
_run_query("run_region_channel", "compute", "region_channel_stats", "select region, channel, count(*) as orders, cast(sum(cast(total_amount as decimal(20,2))) as double) as revenue from clean group by 1, 2")
_run_query("run_category", "compute", "category_stats", "select category, cast(count(*) as bigint) as orders, cast(sum(units) as bigint) as units, cast(sum(cast(total_amount as decimal(20,2))) as double) as revenue, floor(cast(sum(cast(total_amount as decimal(20,2))) as double) / cast((select sum(r) from daily) as double) * 10000 + 0.5) / 10000 as revenue_share from (select coalesce(nullif(trim(p_brand), ''), '未知') as category, clean.* from clean left join part on product_id = cast(p_partkey as varchar)) group by 1")
_run_query("run_customer_tier", "compute", "customer_tier", "select tier, count(*) as customers, cast(sum(r) as double) as revenue from (select coalesce(nullif(trim(c_mktsegment), ''), 'unknown') as tier, customer_id, sum(cast(total_amount as decimal(20,2))) as r from clean left join customer on customer_id = cast(c_custkey as varchar) group by 1, 2) group by 1")
_run_query("run_customer_value", "compute", "customer_value", "select customer_id, coalesce(c_mktsegment, '') as tier, coalesce(n_name, '') as city, v.orders, cast(r as double) as revenue, cast(rank as bigint) as rank from (select *, row_number() over (order by r desc, customer_id) as rank from (select customer_id, count(*) as orders, sum(cast(total_amount as decimal(20,2))) as r from clean group by 1)) v left join customer on customer_id = cast(c_custkey as varchar) left join nation on c_nationkey = n_nationkey where rank <= 20")
_run_query("run_output", "output", "orders_final", "select * exclude (units), 'B-1' as _batch_id, 'orders' as _source_file from clean")
_run_query("run_delta", "ingest", "orders", f"select {', '.join(RAW_ORDERS)}, cast(line as bigint) as _row from raw where order_date > (select max(order_date) from good where order_date <= '{WATERMARK}')", "high_watermark")


@query("run_quality", f"with {_run_sql()} select 'orders' as dataset, split_part(reason, ':', 1) as reason, split_part(reason, ':', 2) as column_name, checked, failed from (select count(*) as checked, {', '.join(f'count(*) filter (m{i}) as f{i}' for i in range(len(_mask_sql())))} from marked), unnest([{', '.join(f"{{'reason': '{r}', 'failed': f{i}}}" for i, (r, _) in enumerate(_mask_sql()))}]) as t(x), lateral (select x.reason as reason, x.failed as failed)")
def run_quality(spark: SparkSession, sf: str) -> DataFrame:
    batch, m = _ran(spark, sf)
    reasons = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    x = batch.read(m, "validate", "rule_stats").where("dataset = 'orders' and rule != 'outlier'")
    return x.select("dataset", reasons[F.col("rule")].alias("reason"), "column_name", "checked", "failed")


@query("run_state_daily", f"with {_run_sql()}, {_CLEAN_DAILY} select order_date, n as orders, units, cast(r as double) as revenue, {_CENTS} as avg_order_value from daily")
def run_state_daily(spark: SparkSession, sf: str) -> DataFrame:
    """History and delta, merged in the state by two incremental batches, equal one full batch."""
    batch, _ = _ran(spark, sf, "high_watermark")
    return batch.state.aggregate("daily_sales")


@query("run_state_tier", f"with {_run_sql()} select tier, count(*) as customers, cast(sum(r) as double) as revenue from (select coalesce(nullif(trim(c_mktsegment), ''), 'unknown') as tier, customer_id, sum(cast(total_amount as decimal(20,2))) as r from clean left join customer on customer_id = cast(c_custkey as varchar) group by 1, 2) group by 1")
def run_state_tier(spark: SparkSession, sf: str) -> DataFrame:
    batch, _ = _ran(spark, sf, "high_watermark")
    return batch.state.aggregate("customer_tier")


@query("run_watermark", f"with {_run_sql()} select 'orders' as dataset, max(order_date) as watermark from good where order_date <= '{TODAY}'")
def run_watermark(spark: SparkSession, sf: str) -> DataFrame:
    batch, _ = _ran(spark, sf, "high_watermark")
    return spark.createDataFrame(list(batch.state.load()["watermarks"].items()), "dataset string, watermark string")


# Operations over batches' metrics files: a folder of 60 batches, written as batches write theirs.
_BATCHES = "select id as batch, case when id % 7 = 3 then 'failed' else 'success' end as status, (900 + id * 37 % 100) / 1000.0 as dq_score, cast(id * 13 % 400 as double) as seconds from range(60)"
_BATCHES_DUCK = _BATCHES.replace("select id", "select range").replace("when id", "when range").replace(" id ", " range ").replace("(id ", "(range ").replace("+ id", "+ range")


def batches(spark: SparkSession) -> DataFrame:
    root = scratch(spark, "metrics")
    put = Files(spark, root)
    for i in range(60):
        status = "failed" if i % 7 == 3 else "success"
        put.replace(f"{root}/B-{i:03d}/metrics.json", json.dumps({"batch": str(i), "status": status, "dq_score": (900 + i * 37 % 100) / 1000, "seconds": float(i * 13 % 400), "finished_ms": i, "stages": []}))
    return monitor.batches(spark, root)


@query("batch_stats", f"with b as ({_BATCHES_DUCK}) select count(*) as total, count(*) filter (status = 'success') as success, count(*) filter (status = 'failed') as failed, floor(avg(cast(dq_score as double) * 100) * 10000 + 0.5) / 10000 as avg_dq, min(cast(dq_score as double) * 100) as min_dq, max(cast(dq_score as double) * 100) as max_dq from b")
def batch_stats(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.statistics(batches(spark))


@query("alerts", f"with b as ({_BATCHES_DUCK}) select cast(batch as varchar) as batch, concat_ws(';', case when cast(dq_score as double) < 0.95 then 'dq_score' end, case when seconds > 300 then 'duration' end, case when status = 'failed' then 'status' end) as alert from b where cast(dq_score as double) < 0.95 or seconds > 300 or status = 'failed'")
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.alerts(batches(spark))


@query("synthetic_orders")
def synthetic_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The generator's orders at its default size, seeded; its tests check the defect rates."""
    return generator.orders(spark)
