"""A batch's configuration, checked before anything runs."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from tidemill.operators.rules import Rule

FORMATS = ("csv", "parquet")
MODES = ("", "full_load", "high_watermark", "snapshot")
STAGES = ("ingest", "validate", "clean", "compute", "output")


class ConfigError(ValueError):
    pass


def _one_of(value: str, allowed: tuple[str, ...], what: str) -> str:
    if value not in allowed:
        raise ConfigError(f"{what} must be one of {', '.join(a or 'empty' for a in allowed)}, not {value!r}")
    return value


@dataclass(frozen=True)
class Config:
    """root: folder of batches and state. sources: path by dataset; orders, customers and products are known to the later stages."""

    root: str
    sources: dict[str, str]
    rules: dict[str, tuple[Rule, ...]]
    format: str = "parquet"
    mode: str = ""
    watermark: str = "order_date"
    fill: dict[str, str] = field(default_factory=lambda: {"region": "unknown", "channel": "unknown"})
    top_n: int = 20
    currency: str = "CNY"
    attempts: int = 3
    limit_s: float | None = None
    min_score: float = 0.95
    max_stage_s: float = 300.0
    max_memory_mb: float = 8192.0

    def __post_init__(self):
        _one_of(self.format, FORMATS, "format")
        _one_of(self.mode, MODES, "mode")
        if not self.root:
            raise ConfigError("root is missing")
        if "orders" not in self.sources:
            raise ConfigError("sources must name orders")
        if self.top_n < 1 or self.attempts < 1:
            raise ConfigError("top_n and attempts must be 1 or more")
        if not 0 <= self.min_score <= 1:
            raise ConfigError("min_score must lie between 0 and 1")

    @property
    def incremental(self) -> bool:
        return self.mode in ("high_watermark", "snapshot")

    @classmethod
    def of(cls, raw: dict) -> Config:
        """From a parsed JSON object; rules are lists of Rule's fields by dataset."""
        known = {k: v for k, v in raw.items() if k in cls.__dataclass_fields__}
        try:
            tuples = lambda r: {k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}
            known["rules"] = {d: tuple(Rule(**tuples(r)) for r in rs) for d, rs in raw.get("rules", {}).items()}
            return cls(**known)
        except (TypeError, AttributeError) as e:
            raise ConfigError(str(e)) from e
        except ValueError as e:
            raise e if isinstance(e, ConfigError) else ConfigError(str(e)) from e

    @classmethod
    def load(cls, path: str) -> Config:
        with open(path, encoding="utf-8") as f:
            try:
                return cls.of(json.load(f))
            except json.JSONDecodeError as e:
                raise ConfigError(f"{path}: {e}") from e

    def plain(self) -> dict:
        """What the digest of a run is made of."""
        return json.loads(json.dumps({k: getattr(self, k) for k in self.__dataclass_fields__}, default=lambda o: o.__dict__, sort_keys=True))


#: Rules of the synthetic tables: fixed domains and patterns of the data.
DEFAULT_RULES = {
    "orders": (
        *[Rule("completeness", c) for c in ("order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "status")],
        Rule("uniqueness", "order_id"), Rule("range", "quantity", 1, 1000), Rule("range", "unit_price", 0.01, 100_000),
        Rule("allowed_values", "status", values=("completed", "pending", "cancelled", "refunded")), Rule("allowed_values", "channel", values=("web", "app", "store")),
        Rule("format", "order_id", pattern=r"ORD-\d{8}$"), Rule("date_valid", "order_date", "2020-01-01", "2099-12-31"),
        Rule("referential", "customer_id", reference=("customers", "customer_id")), Rule("referential", "product_id", reference=("products", "product_id")),
        Rule("outlier", "total_amount", method="iqr", factor=1.5),
    ),
    "customers": (Rule("completeness", "customer_id"), Rule("completeness", "tier"), Rule("uniqueness", "customer_id"), Rule("allowed_values", "tier", values=("bronze", "silver", "gold", "platinum"))),
    "products": (Rule("completeness", "product_id"), Rule("completeness", "category"), Rule("uniqueness", "product_id"), Rule("range", "cost", 0, 100_000)),
}
