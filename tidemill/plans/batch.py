"""A batch: ingest, validate, clean, compute, output, on the stage runner; then the commit of incremental state and the batch's reports."""

from __future__ import annotations

import json
import time
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.parsing import blank_to_null, int_strict, timestamp_multi
from tidemill.operators import aggregates as A
from tidemill.operators import clean as C
from tidemill.operators.rules import check, summary
from tidemill.plans import events
from tidemill.plans.config import Config
from tidemill.plans.runner import Runner, Stage, StageError, lineage
from tidemill.sources import rows
from tidemill.sources.snapshots import Files, SnapshotTable
from tidemill.streaming.state import StateStore, delta

VERSION = "1"
AGGREGATES = ("daily_sales", "category_stats", "region_channel_stats", "customer_value", "customer_tier")
STATS = "dataset string, rule string, column_name string, checked bigint, passed bigint, failed bigint, pass_rate double"


def new_id() -> str:
    return f"B-{datetime.now(UTC):%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:6].upper()}"


class Batch:
    def __init__(self, spark: SparkSession, config: Config, batch_id: str | None = None, today: str | None = None):
        self.spark, self.config, self.batch_id = spark, config, batch_id or new_id()
        self.today = today or f"{datetime.now(UTC):%Y-%m-%d}"
        self.state = StateStore(spark, f"{config.root}/state") if config.incremental else None
        self.before = self.state.load() if self.state else {"watermarks": {}, "snapshots": {}}
        self.table = SnapshotTable(spark, config.sources["orders"]) if config.mode == "snapshot" else None
        self.upto = self.table.current()["snapshot_id"] if self.table and self.table.exists() else None

    # Stages. Each returns its tables by name; the runner writes them and reads them again.
    def ingest(self, spark: SparkSession, _: dict) -> dict[str, DataFrame]:
        out = {}
        for name, path in self.config.sources.items():
            if name == "orders" and self.table:
                raw = self.table.diff(self.before["snapshots"].get("orders"), self.upto)
                out[name] = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns], F.monotonically_increasing_id().alias("_row"))
            else:
                out[name] = rows.numbered(spark, path, self.config.format)
                if name == "orders" and self.config.mode == "high_watermark":
                    out[name] = delta(out[name], self.config.watermark, self.before["watermarks"].get("orders"))
        return out

    def validate(self, spark: SparkSession, tables: dict) -> dict[str, DataFrame]:
        """Datasets without rules are dropped. Reference tables are whole in incremental batches, too: only orders come as a delta."""
        raw = {n: tables[f"ingest.{n}"] for n in self.config.sources}
        out, stats = {}, []
        for name, rules in self.config.rules.items():
            if name not in raw:
                continue
            x = raw[name]
            if name == "orders" and {"quantity", "unit_price"} <= set(x.columns):
                x = x.withColumn("total_amount", C.amount_or_null(F.col("quantity"), F.col("unit_price")))
            got = check(x, [r for r in rules if r.column in x.columns], raw, ["_row"], F.col("_row") + 2)
            out[f"valid_{name}"] = got.good.drop("total_amount")
            out[f"quarantine_{name}"] = got.bad.drop("_row", "total_amount")
            stats.append(got.stats.withColumn("dataset", F.lit(name)))
            if got.outlier:
                out["outliers"] = got.flagged.where("is_anomaly = '1'").select("order_id")
        every = spark.createDataFrame([], STATS)
        for s in stats:
            every = every.unionByName(s)
        return {**out, "rule_stats": every}

    def clean(self, spark: SparkSession, tables: dict) -> dict[str, DataFrame]:
        x = C.keep_first(tables["validate.valid_orders"], ["order_id"], ["_row"])
        x = C.fill_missing(x, self.config.fill)
        discount = F.col("discount") if "discount" in x.columns else None
        x = x.withColumn("total_amount", C.total_amount(F.col("quantity"), F.col("unit_price"), discount))
        if "validate.outliers" in tables:
            x = C.flag(x, tables["validate.outliers"], "order_id")
        else:
            x = x.withColumn("is_anomaly", F.lit("0"))
        return {"orders": x.drop("_row")}

    def sales(self, tables: dict) -> DataFrame:
        x = tables["clean.orders"]
        return x.select("order_date", "customer_id", "product_id", "region", "channel", F.coalesce(int_strict(F.col("quantity")), F.lit(0)).alias("units"), F.col("total_amount").alias("amount"))

    def compute(self, spark: SparkSession, tables: dict) -> dict[str, DataFrame]:
        """The five aggregates and the KPI: of all orders, or in an incremental batch of its delta."""
        x = self.sales(tables)
        customers = tables.get("validate.valid_customers", spark.createDataFrame([], "customer_id string, tier string, city string"))
        products = tables.get("validate.valid_products", spark.createDataFrame([], "product_id string, category string"))
        value = A.customer_value(x, customers, None if self.config.incremental else self.config.top_n)
        history = self.state.aggregate("customer_value") if self.state else None
        tier = A.customer_tier(x, customers) if history is None else A.incremental_tier(x, history, customers)
        if history is not None:  # a known customer keeps its tier and city where the batch has none
            old = history.select("customer_id", F.col("tier").alias("__tier"), F.col("city").alias("__city"))
            keep = lambda c: F.coalesce(blank_to_null(F.col(f"__{c}")), F.col(c)).alias(c)
            value = value.join(old, "customer_id", "left").select("customer_id", keep("tier"), keep("city"), "orders", "revenue", "rank")
        daily = A.daily_sales(x)
        return {
            "daily_sales": daily, "category_stats": A.category_stats(x, products), "region_channel_stats": A.region_channel_stats(x),
            "customer_value": value, "customer_tier": tier, "kpi": A.kpi(daily, self.config.currency),
        }

    def output(self, spark: SparkSession, tables: dict) -> dict[str, DataFrame]:
        final = tables["clean.orders"].withColumns({"_batch_id": F.lit(self.batch_id), "_source_file": F.lit(self.config.sources["orders"].rstrip("/").rsplit("/", 1)[-1])})
        return {"orders_final": final, "quality": summary([tables["validate.rule_stats"].drop("dataset")])}

    def stages(self) -> list[Stage]:
        sources, rules = list(self.config.sources), [n for n in self.config.rules if n in self.config.sources]
        valid = tuple(f"validate.valid_{n}" for n in rules)
        return [
            Stage("ingest", self.ingest), Stage("validate", self.validate, tuple(f"ingest.{n}" for n in sources)),
            Stage("clean", self.clean, ("validate.valid_orders", "validate.outliers")), Stage("compute", self.compute, ("clean.orders", *valid[1:])),
            Stage("output", self.output, ("clean.orders", "validate.rule_stats")),
        ]

    def run(self, fail_at: str | None = None) -> dict:
        """The manifest of the finished batch. In an incremental one, state changes by one commit after all stages; a batch in the ledger changes nothing."""
        began, emit = time.time(), events.Emitter(self.spark, f"{self.config.root}/{self.batch_id}/events", self.batch_id)
        runner = Runner(self.spark, self.config.root, self.stages(), {**self.config.plain(), "version": VERSION}, self.config.attempts, limit_s=self.config.limit_s, always=("output",))
        emit("START", "batch")
        try:
            m = runner.run(self.batch_id, fail_at)
            if self.state:
                self.commit(m)
        except Exception as e:
            emit("FAIL", "batch", error=e)
            self.report(runner.manifest(self.batch_id) or {"stages": {}}, "failed", began, str(e))
            raise
        for stage in m["stages"]:
            emit("COMPLETE", stage, inputs=m["stages"][stage]["inputs"], outputs=list(m["stages"][stage]["tables"]))
        emit("COMPLETE", "batch")
        self.report(m, "success", began)
        return m

    def read(self, m: dict, stage: str, name: str) -> DataFrame:
        return self.spark.read.parquet(m["stages"][stage]["tables"][name]["path"])

    def commit(self, m: dict) -> bool:
        deltas = {s.name: (self.read(m, "compute", s.name), s) for s in A.SPECS}
        marks = {}
        if self.config.mode == "high_watermark":
            # Of valid rows, and never past the batch's day: one date in the far future would hide all later orders.
            c = F.col(self.config.watermark)
            day = F.date_format(timestamp_multi(c), "yyyy-MM-dd")
            found = self.read(m, "validate", "valid_orders").where(day <= self.today).agg(F.max(c)).first()[0]
            old = self.before["watermarks"].get("orders")
            if found and (old is None or found > old):
                marks["orders"] = found
        return self.state.commit(self.batch_id, deltas, marks, {"orders": self.upto} if self.upto else {})

    def report(self, m: dict, status: str, began: float, error: str = "") -> None:
        """metrics.json, dashboard_data.json, quality.md and the pointer to the newest batch; all from small tables."""
        folder, put = f"{self.config.root}/{self.batch_id}", Files(self.spark, self.config.root)
        small = lambda stage, name: [r.asDict() for r in self.read(m, stage, name).collect()] if name in m["stages"].get(stage, {}).get("tables", {}) else []
        stats, quality, kpi = small("validate", "rule_stats"), small("output", "quality"), small("compute", "kpi")
        stage_rows = {s: {"status": "success", "seconds": x["seconds"], "rows_out": sum(t["rows"] for t in x["tables"].values())} for s, x in m["stages"].items()}
        bad = {n.removeprefix("quarantine_"): t["rows"] for n, t in m["stages"].get("validate", {}).get("tables", {}).items() if n.startswith("quarantine_")}
        metrics = {
            "batch": self.batch_id, "status": status, "mode": self.config.mode or "full_load", "seconds": round(time.time() - began, 3), "finished_ms": int(time.time() * 1000), "error": error[:500],
            "dq_score": quality[0]["dq_score"] if quality else None, "quarantined": bad, "quarantined_rows": sum(bad.values()), "memory_mb": events.memory_mb(),
            "stages": [{"stage": s, **x} for s, x in stage_rows.items()],
        }
        top = lambda name, n: [r.asDict() for r in self.read(m, "compute", name).orderBy(F.desc("revenue")).limit(n).collect()] if name in m["stages"].get("compute", {}).get("tables", {}) else []
        board = {
            "batch": self.batch_id, "kpi": kpi[0] if kpi else {}, "daily": sorted(small("compute", "daily_sales"), key=lambda r: str(r["order_date"])), "category": top("category_stats", 1000), "region_channel": top("region_channel_stats", 1000),
            "top_customers": top("customer_value", self.config.top_n), "tiers": small("compute", "customer_tier"), "quality": quality[0] if quality else {}, "stages": metrics["stages"], "lineage": lineage(m),
        }
        lines = [f"# Quality of {self.batch_id}", "", f"Score: {metrics['dq_score']}", "", "| dataset | rule | column | checked | failed | pass rate |", "|---|---|---|---|---|---|"]
        lines += [f"| {r['dataset']} | {r['rule']} | {r['column_name']} | {r['checked']} | {r['failed']} | {r['pass_rate']:.4f} |" for r in sorted(stats, key=lambda r: (r["dataset"], r["rule"], r["column_name"]))]
        put.replace(f"{folder}/metrics.json", json.dumps(metrics))
        put.replace(f"{folder}/dashboard_data.json", json.dumps(board, default=str))
        put.replace(f"{folder}/quality.md", "\n".join(lines) + "\n")
        if status == "success":
            put.replace(f"{self.config.root}/latest", self.batch_id)


__all__ = ["AGGREGATES", "Batch", "StageError", "new_id"]
