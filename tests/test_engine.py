import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.operators import clean as C
from tidemill.operators.rules import Rule, check, summary
from tidemill.plans import catalogue
from tidemill.sources import generator
from tidemill.sources.snapshots import SnapshotTable

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    df, want = catalogue.QUERIES[name](spark, SF), duck.sql(catalogue.ORACLES[name])
    rows = lambda got, cols: sorted(repr([r[i] for i in sorted(range(len(cols)), key=lambda i: cols[i])]) for r in got)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), want.columns)


def rows(spark, values, name="c"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def failing(spark, rule, values):
    return sorted(r["i"] for r in check(rows(spark, values), [rule], order=["i"]).bad.collect())


def test_uniqueness_exempts_blanks_and_keeps_the_first(spark):
    x = check(rows(spark, ["", "", None, "X", "X"]), [Rule("uniqueness", "c")], order=["i"])
    assert [r["i"] for r in x.bad.collect()] == [4]
    assert x.stats.first().asDict() == {"rule": "uniqueness", "column_name": "c", "checked": 5, "passed": 4, "failed": 1, "pass_rate": 0.8}


def test_format_is_anchored_at_the_front_only(spark):
    assert failing(spark, Rule("format", "c", pattern=r"ORD-\d{8}|b"), ["XORD-12345678", "ORD-12345678-more", "", "XORD-1b"]) == [0, 3]


def test_dates_compare_by_the_second(spark):
    assert failing(spark, Rule("date_valid", "c", high="2026-01-15"), ["2026-01-15", "2026-01-15T23:59:59", "2026-1-5", "not-a-date", "2027-13-01"]) == [1, 3, 4]


def test_range_is_inclusive_and_lenient(spark):
    assert failing(spark, Rule("range", "c", low=1, high=1000), ["0", "1", "1,000", "1001", "nan", "", None, "abc"]) == [0, 3, 4, 5, 6, 7]


def test_reference_table_that_is_missing_fails_all_values(spark):
    assert failing(spark, Rule("referential", "c", reference=("t", "c")), ["a", "", None]) == [0]


def test_outlier_needs_a_hundred_numbers(spark):
    rule = Rule("outlier", "c")
    flagged = lambda v: [r["i"] for r in check(rows(spark, v), [rule]).flagged.where("is_anomaly = '1'").collect()]
    assert flagged(["500.00"] * 100 + ["999999.00"]) == [100]
    assert flagged(["500.00"] * 98 + ["999999.00"]) == []
    assert check(rows(spark, ["1"] * 5), [rule]).stats.count() == 0


def test_empty_table(spark):
    x = check(rows(spark, []), [Rule("completeness", "c"), Rule("outlier", "c")])
    assert x.bad.count() == 0 and summary([x.stats]).first()["dq_score"] == 1.0


def test_discounts_and_keep_first(spark):
    x = spark.createDataFrame([("5", "100.00", d) for d in ("0.10", "", "abc", None)] + [("5.5", "100", "0")], "q string, p string, d string")
    got = [r[0] for r in x.select(C.total_amount(F.col("q"), F.col("p"), F.col("d"))).collect()]
    assert got == [450.0, 500.0, 500.0, 500.0, 0.0]
    y = spark.createDataFrame([(1, "a"), (0, "a"), (2, "b")], "i int, k string")
    assert sorted(map(tuple, C.keep_first(y, ["k"], ["i"]).collect())) == [(0, "a"), (2, "b")]


def test_merge(spark):
    spec = A.SPECS[0]
    cols = "order_date string, orders bigint, units bigint, revenue double, avg_order_value double"
    h, d = spark.createDataFrame([("d", 10, 1, 1000.0, 100.0)], cols), spark.createDataFrame([("d", 5, 2, 500.0, 100.0)], cols)
    assert tuple(A.merge(h, d, spec).first()) == ("d", 15, 3, 1500.0, 100.0)
    cols = "customer_id string, tier string, city string, orders bigint, revenue double, rank bigint"
    h, d = spark.createDataFrame([("a", "gold", "x", 1, 1000.0, 1)], cols), spark.createDataFrame([("b", "", "", 1, 3000.0, 1), ("a", "", "y", 1, 1.0, 2)], cols)
    got = {r["customer_id"]: (r["tier"], r["city"], r["rank"]) for r in A.merge(h, d, A.SPECS[3]).collect()}
    assert got == {"a": ("gold", "y", 2), "b": ("", "", 1)}


def test_results_do_not_depend_on_partitions(spark):
    x = generator.orders(spark, 500)
    rules = [Rule("completeness", "region"), Rule("range", "quantity", low=1, high=1000), Rule("uniqueness", "order_id")]
    got = [sorted(map(tuple, check(x.repartition(n), rules, order=["order_id"]).stats.collect())) for n in (1, 5)]
    assert got[0] == got[1]


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    first = t.append(spark.range(2))
    t.append(spark.range(2, 4))
    assert t.diff(first["snapshot_id"]).count() == 2 and t.diff(None).count() == 4 and t.read().count() == 4
    assert t.read(first["snapshot_id"]).count() == 2
    t.overwrite(spark.range(1))
    assert t.read().count() == 1 and len(t.snapshots()) == 3 and t.read(first["snapshot_id"]).count() == 2


def test_generator(spark):
    x = generator.orders(spark, 4000)
    assert x.exceptAll(generator.orders(spark, 4000)).count() == 0
    n = x.count()
    assert 4000 < n < 4100 and 10 < x.where("customer_id = 'CUS-999999'").count() < 100
