import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates as A
from tidemill.plans.runner import Runner, Stage, StageError, lineage
from tidemill.sources import files
from tidemill.streaming.state import StateStore, delta, highest


def test_csv_keeps_strings_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿order_id,qty\n007,1\n8\n", encoding="utf-8")
    df = files.read(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["order_id", "qty"] and sorted(map(tuple, df.collect())) == [("007", "1"), ("8", None)]
    for kind in files.FORMATS:
        assert files.write(df, str(tmp_path / kind), kind) == 2
        assert sorted(map(tuple, files.read(spark, str(tmp_path / kind), kind).collect())) == [("007", "1"), ("8", None)]
    with pytest.raises(ValueError):
        files.read(spark, "x", "xml")


def daily(spark, rows):
    return A.daily_sales(spark.createDataFrame(rows, "order_date string, units long, amount double"))


def test_state_merges_each_batch_once(spark, tmp_path):
    store, spec = StateStore(spark, str(tmp_path)), A.SPECS[0]
    one = daily(spark, [("2026-01-01", 1, 10.0), ("2026-01-01", 2, 20.0)])
    assert store.commit("b1", {"daily": (one, spec)}, {"orders": "2026-01-01"}) and not store.commit("b1", {"daily": (one, spec)})
    assert store.commit("b2", {"daily": (daily(spark, [("2026-01-01", 1, 30.0)]), spec)})
    assert [tuple(r) for r in store.aggregate("daily").select("orders", "units", "revenue", "avg_order_value").collect()] == [(3, 4, 60.0, 20.0)]
    assert store.load()["watermarks"] == {"orders": "2026-01-01"} and store.merged("b2")
    Path(tmp_path / "state" / f"{3:012d}.json").write_text("{")
    with pytest.raises(RuntimeError):
        store.load()


def test_watermarks_are_strict(spark):
    df = spark.createDataFrame([(9,), (10,), (11,)], "n int")
    assert [r["n"] for r in delta(df, "n", "9").collect()] == [10, 11]  # compared as numbers, not as text
    assert highest(df, "n") == "11" and highest(df.limit(0), "n", "9") == "9" and delta(df, "n", None).count() == 3


def test_runner_retries_resumes_and_records(spark, tmp_path):
    calls = []

    def first(s, tables):
        calls.append("first")
        if len(calls) == 1:
            raise RuntimeError("once")
        return {"t": s.range(5)}

    def second(s, tables):
        calls.append("second")
        return {"u": tables["first.t"].where(F.col("id") > 2)}

    r = Runner(spark, str(tmp_path), [Stage("first", first), Stage("second", second, ("first.t", "not.made"))], base_s=0)
    with pytest.raises(StageError):
        r.run("b", fail_at="second")
    assert calls == ["first", "first"] and r.manifest("b")["status"] == "failed"
    m = r.run("b")
    assert calls == ["first", "first", "second"] and m["status"] == "success" and m["stages"]["first"]["skipped"]
    assert m["stages"]["second"]["tables"]["u"]["rows"] == 2 and lineage(m) == [("first.t", "second.u")]
    assert json.loads(json.dumps(r.manifest("b"))) == m
    again = Runner(spark, str(tmp_path), r.stages, {"changed": 1}, base_s=0).run("b")
    assert calls[3:] == ["first", "second"] and again["status"] == "success"


def test_runner_stops_late_stages(spark, tmp_path):
    slow = Stage("slow", lambda s, t: {"x": s.range(1, 9, 1, 1).select(F.expr("java_method('java.lang.Thread', 'sleep', 5000L)"))})
    with pytest.raises(StageError):
        Runner(spark, str(tmp_path), [slow], attempts=1, limit_s=1).run("b")
