"""Whole batches: results against plain Python, incremental batches against full ones, failures, resume, reports, monitoring."""

import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from tidemill import __main__ as cli
from tidemill.plans import events, monitor
from tidemill.plans.batch import Batch
from tidemill.plans.config import DEFAULT_RULES, Config, ConfigError
from tidemill.plans.runner import StageError
from tidemill.sources import generator, rows
from tidemill.sources.snapshots import Files, SnapshotTable


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("in"))
    tables = {"orders": generator.orders(spark, 400, 60, 20), "customers": generator.customers(spark, 60), "products": generator.products(spark, 20)}
    for name, df in tables.items():
        df.coalesce(2).write.option("header", True).csv(f"{root}/csv/{name}")
        df.coalesce(2).write.parquet(f"{root}/parquet/{name}")
    return root


def config(sources, root, kind="csv", **more):
    return Config(root=str(root), sources={n: f"{sources}/{kind}/{n}" for n in ("orders", "customers", "products")}, rules=DEFAULT_RULES, format=kind, **more)


def test_full_batch(spark, sources, tmp_path):
    c = config(sources, tmp_path)
    m = Batch(spark, c, "B-full", "2026-08-15").run()
    read = lambda stage, name: Batch(spark, c, "B-full").read(m, stage, name)
    raw, good, bad = (read(s, n).collect() for s, n in (("ingest", "orders"), ("validate", "valid_orders"), ("validate", "quarantine_orders")))
    assert sorted(r["_row"] for r in raw) == list(range(len(raw))) and len(good) + len(bad) == len(raw) > 400
    by_row = {r["_row"]: r for r in raw}
    assert all(by_row[r["_line"] - 2]["order_id"] == r["order_id"] and r["_reasons"] for r in bad)
    clean = read("clean", "orders").collect()
    assert len({r["order_id"] for r in clean}) == len(clean) == len({r["order_id"] for r in good})
    kpi, daily = read("compute", "kpi").first(), read("compute", "daily_sales").collect()
    assert kpi["orders"] == len(clean) and round(sum(r["total_amount"] for r in clean), 2) == kpi["total_revenue"] == round(sum(r["revenue"] for r in daily), 2)
    assert abs(sum(r["revenue_share"] for r in read("compute", "category_stats").collect()) - 1) < 1e-3
    board, metrics = (json.loads((tmp_path / "B-full" / f).read_text()) for f in ("dashboard_data.json", "metrics.json"))
    assert board["kpi"]["orders"] == len(clean) and metrics["status"] == "success" and metrics["quarantined"]["orders"] == len(bad) and 0.9 < metrics["dq_score"] <= 1
    assert (tmp_path / "latest").read_text() == "B-full" and "| orders | completeness | order_id |" in (tmp_path / "B-full" / "quality.md").read_text()
    kinds = [json.loads(p.read_text())["eventType"] for p in sorted((tmp_path / "B-full" / "events").glob("*.json"))]
    assert kinds[0] == "START" and kinds[-1] == "COMPLETE" and len(kinds) == 7
    other = Batch(spark, config(sources, tmp_path, "parquet"), "B-parquet", "2026-08-15")
    assert other.read(other.run(), "compute", "kpi").first() == kpi


def test_incremental_equals_full_and_resumes(spark, sources, tmp_path):
    inputs = tmp_path / "in"
    everything = spark.read.parquet(f"{sources}/parquet/orders")
    for n in ("customers", "products"):
        spark.read.parquet(f"{sources}/parquet/{n}").write.parquet(f"{inputs}/parquet/{n}")
    everything.where("order_date <= '2026-07-01'").write.parquet(f"{inputs}/parquet/orders")
    c = config(inputs, tmp_path / "run", "parquet", mode="high_watermark", attempts=1)
    Batch(spark, c, "B-1", "2026-08-15").run()
    everything.write.mode("overwrite").parquet(f"{inputs}/parquet/orders")
    second = Batch(spark, c, "B-2", "2026-08-15")
    with pytest.raises(StageError):
        second.run(fail_at="compute")
    assert second.state.load()["ledger"] == ["B-1"] and json.loads((tmp_path / "run/B-2/metrics.json").read_text())["status"] == "failed"
    second = Batch(spark, c, "B-2", "2026-08-15")
    m = second.run()  # goes on after clean
    assert m["stages"]["clean"]["skipped"] and not m["stages"]["output"].get("skipped")
    state = second.state.load()
    assert state["ledger"] == ["B-1", "B-2"] and state["watermarks"]["orders"] <= "2026-08-15"
    assert second.commit(m) is False and second.state.load() == state  # a batch in the ledger changes nothing
    whole = Batch(spark, config(inputs, tmp_path / "whole", "parquet", top_n=1000), "B-w", "2026-08-15")
    w = whole.run()
    dates = [r[0] for r in spark.read.parquet(w["stages"]["clean"]["tables"]["orders"]["path"]).select("order_date").distinct().collect()]
    assert max(dates) <= "2027-01-01"
    rows_of = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    for name in ("daily_sales", "category_stats", "region_channel_stats", "customer_tier", "customer_value"):
        assert rows_of(second.state.aggregate(name)) == rows_of(whole.read(w, "compute", name)), name
    again = Batch(spark, c, "B-3", "2026-08-15")
    assert again.read(again.run(), "ingest", "orders").where(F.col("order_date").rlike("^2026")).count() == 0


def test_snapshot_batches(spark, sources, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "table"))
    everything = spark.read.parquet(f"{sources}/parquet/orders")
    t.append(everything.where("order_id < 'ORD-00000200'"))
    c = Config(root=str(tmp_path / "run"), sources={"orders": str(tmp_path / "table")}, rules={"orders": DEFAULT_RULES["orders"][:4]}, mode="snapshot")
    first = Batch(spark, c, "B-1")
    n = first.read(first.run(), "ingest", "orders").count()
    t.append(everything.where("order_id >= 'ORD-00000200'"))
    second = Batch(spark, c, "B-2")
    assert n + second.read(second.run(), "ingest", "orders").count() == everything.count()
    third = Batch(spark, c, "B-3")
    assert third.read(third.run(), "ingest", "orders").count() == 0


def test_snapshot_diff_counts_appends_alone(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    one = t.append(spark.range(3))
    t.overwrite(spark.range(10, 15))
    t.append(spark.range(20, 22))
    assert sorted(r[0] for r in t.diff(one["snapshot_id"]).collect()) == [20, 21] and t.added_rows(one["snapshot_id"]) == 2
    assert t.diff().count() == 7 and t.diff(t.current()["snapshot_id"]).count() == 0


def test_two_writers_of_one_log_entry(spark, tmp_path):
    f, path, won = Files(spark, str(tmp_path)), str(tmp_path / "log" / "1.json"), []
    threads = [threading.Thread(target=lambda i=i: won.append((f.commit(path, str(i)), i))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [str(i) for ok, i in won if ok] == [f.read(path)] and len(f.names(str(tmp_path / "log"))) == 1


def test_row_numbers_do_not_depend_on_partitions(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) as a").repartitionByRange(7, F.col("a").cast("int")).sortWithinPartitions(F.col("a").cast("int")).write.parquet(str(tmp_path / "p"))
    spark.read.parquet(str(tmp_path / "p")).orderBy(F.col("a").cast("int")).write.option("header", True).csv(str(tmp_path / "c"))
    for kind, at in (("parquet", "p"), ("csv", "c")):
        got = {r["a"]: r["_row"] for r in rows.numbered(spark, str(tmp_path / at), kind).collect()}
        assert got == {str(i): i for i in range(1000)}


def test_config(tmp_path):
    good = {"root": "r", "sources": {"orders": "o"}, "rules": {"orders": [{"kind": "referential", "column": "a", "reference": ["t", "b"]}]}, "unknown": 1}
    assert Config.of(good).rules["orders"][0].reference == ("t", "b")
    for change in ({"mode": "x"}, {"format": "orc"}, {"sources": {}}, {"root": ""}, {"top_n": 0}, {"min_score": 2}, {"rules": {"orders": [{"kind": "nope", "column": "a"}]}}, {"rules": {"orders": [{"what": 1}]}}):
        with pytest.raises(ConfigError):
            Config.of({**good, **change})
    (tmp_path / "bad.json").write_text("{")
    assert cli.main(["--config", str(tmp_path / "bad.json")]) == 2 and cli.main(["--config", str(tmp_path / "none.json")]) == 2


def test_monitoring_and_retention(spark, tmp_path):
    root, put = str(tmp_path), Files(spark, str(tmp_path))
    assert monitor.health(spark, root) == {"status": "ok", "batches": []}
    for i, (status, score, seconds) in enumerate([("success", 0.99, 10.0), ("failed", None, 400.0), ("success", 0.9, 20.0)]):
        put.replace(f"{root}/B-{i}/metrics.json", json.dumps({"batch": f"B-{i}", "status": status, "dq_score": score, "seconds": seconds, "finished_ms": i, "memory_mb": 10.0 * i}))
    put.replace(f"{root}/latest", "B-0")
    found = monitor.batches(spark, root)
    assert tuple(monitor.statistics(found).first()) == (3, 2, 1, 94.5, 90.0, 99.0)
    assert {r["batch"]: r["alert"] for r in monitor.alerts(found, max_mb=15.0).collect()} == {"B-1": "duration;status", "B-2": "dq_score;memory"}
    assert abs(monitor.failure_rate(found) - 1 / 3) < 1e-9
    server = monitor.serve(spark, root)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    assert json.loads(urllib.request.urlopen(f"{url}/health").read())["status"] == "ok"
    with pytest.raises(urllib.error.HTTPError):
        urllib.request.urlopen(f"{url}/else")
    server.shutdown()
    assert monitor.expired(spark, root, 1) == ["B-1"] and (tmp_path / "B-1").exists()
    assert monitor.expired(spark, root, 1, delete=True) == ["B-1"] and not (tmp_path / "B-1").exists() and (tmp_path / "B-0").exists()


def test_events_never_stop_a_run(spark, tmp_path):
    (tmp_path / "file").write_text("")
    events.Emitter(spark, str(tmp_path / "file" / "below"), "B-1")("START", "batch")
    assert events.memory_mb() > 1
